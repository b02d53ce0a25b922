from __future__ import annotations

import random
from collections import Counter
from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from clickloom.operators.adclicks import (
    accumulated_counts,
    ad_minute_clicks,
    ad_trend_last_hour,
    ad_trend_sliding,
    blacklist_replay,
    blacklist_users,
    daily_user_ad_clicks,
    lookup_user_click_count,
    replayed_daily_clicks,
    without_blacklisted,
)

DAY = "2024-01-01"


def _rows(frame):
    return sorted(tuple(r) for r in frame.collect())


def test_day_counts(click_rows):
    clicks = click_rows(
        (f"{DAY} 00:00:00", 1, 7), (f"{DAY} 23:59:59", 1, 7), ("2024-01-02 00:00:00", 1, 7)
    )
    assert _rows(daily_user_ad_clicks(clicks)) == [(DAY, 1, 7, 2), ("2024-01-02", 1, 7, 1)]


def test_minute_counts(click_rows):
    clicks = click_rows(
        (f"{DAY} 05:06:00", 1, 7), (f"{DAY} 05:06:59", 2, 7), (f"{DAY} 05:07:00", 2, 7)
    )
    assert _rows(ad_minute_clicks(clicks)) == [
        (DAY, "05", "06", 7, 2),
        (DAY, "05", "07", 7, 1),
    ]


def test_threshold_is_inclusive(click_rows):
    many = [(f"{DAY} 01:00:00", user, 1) for user in (99, 100, 101) for _ in range(user)]
    counts = daily_user_ad_clicks(click_rows(*many))
    assert _rows(blacklist_users(counts)) == [(100,), (101,)]


def test_threshold_is_per_ad_and_day(click_rows):
    two_ads = [(f"{DAY} 01:00:00", 1, ad) for ad in (1, 2) for _ in range(60)]
    midnight = [(f"2024-01-0{d} 01:00:00", 2, 1) for d in (1, 2) for _ in range(60)]
    assert _rows(blacklist_users(daily_user_ad_clicks(click_rows(*two_ads, *midnight)))) == []


def test_without_blacklisted(spark, click_rows):
    clicks = click_rows((f"{DAY} 01:00:00", 1, 7), (f"{DAY} 01:00:00", 2, 7))
    listed = spark.createDataFrame([(2,), (2,), (3,)], "user_id long")
    assert [r.user_id for r in without_blacklisted(clicks, listed).collect()] == [1]


def test_accumulate_and_lookup(spark):
    schema = "date string, user_id long, ad_id long, click_count long"
    totals = spark.createDataFrame([(DAY, 1, 1, 60), (DAY, 3, 1, 5)], schema)
    batch = spark.createDataFrame([(DAY, 1, 1, 40), (DAY, 2, 1, 1)], schema)
    assert _rows(accumulated_counts(batch, totals)) == [(DAY, 1, 1, 100), (DAY, 2, 1, 1)]
    assert _rows(lookup_user_click_count(batch, totals)) == [(DAY, 1, 1, 60)]


def test_last_hour(click_rows):
    clicks = click_rows(
        (f"{DAY} 09:59:59", 1, 1),
        (f"{DAY} 10:00:00", 1, 1),
        (f"{DAY} 10:00:30", 1, 2),
        (f"{DAY} 10:59:30", 1, 1),
    )
    assert _rows(ad_trend_last_hour(clicks)) == [
        (DAY, "10", "00", 1, 1),
        (DAY, "10", "00", 2, 1),
        (DAY, "10", "59", 1, 1),
    ]
    assert len(_rows(ad_trend_last_hour(clicks, 1))) == 1
    assert _rows(ad_trend_last_hour(clicks.limit(0))) == []


@pytest.mark.parametrize("window, slide", [(60, 10), (3, 10), (10, 60), (10, 120), (5, 25), (2, 8)])
def test_sliding_windows_against_brute_force(click_rows, window, slide):
    draw = random.Random(slide)
    start = datetime(2024, 1, 1, 10, 0, tzinfo=UTC)
    clicks = [
        (start + timedelta(seconds=draw.randrange(0, 400)), draw.randrange(3)) for _ in range(120)
    ]
    expected: Counter = Counter()
    for at, ad in clicks:
        first = int(at.timestamp()) // slide * slide + slide
        for end in range(first, first + window * 60, slide):
            expected[end, at.strftime("%Y%m%d%H%M"), ad] += 1
    rows = click_rows(*[(at.strftime("%Y-%m-%d %H:%M:%S"), 1, ad) for at, ad in clicks])
    got = ad_trend_sliding(rows, window, slide).withColumn("end", F.unix_seconds("window_end"))
    assert {
        (r.end, r.minute_key, r.ad_id): r.click_count for r in got.collect()
    } == dict(expected)


def test_window_has_to_fit_the_slide(click_rows):
    with pytest.raises(ValueError):
        ad_trend_sliding(click_rows((f"{DAY} 01:00:00", 1, 1)), 1, 7)


def _simulate(clicks, threshold, seconds):
    """Batch by batch with a list that is read before and fed after each batch."""
    batches: dict = {}
    for at, user, ad in clicks:
        batches.setdefault(int(at.timestamp()) // seconds, []).append((at, user, ad))
    listed: dict = {}
    counts: Counter = Counter()
    for number in sorted(batches):
        for at, user, ad in batches[number]:
            if user not in listed:
                counts[at.strftime("%Y-%m-%d"), user, ad] += 1
        for (_, user, _), n in counts.items():
            if n >= threshold:
                listed.setdefault(user, number)
    return listed, counts


@pytest.mark.parametrize("threshold", [2, 5, 20])
@pytest.mark.parametrize("seconds", [5, 3600, 50000])
def test_replay_against_simulation(click_rows, threshold, seconds):
    draw = random.Random(threshold * seconds)
    start = datetime(2024, 1, 1, tzinfo=UTC)
    clicks = [
        (
            start + timedelta(seconds=draw.randrange(0, 3 * 86400)),
            min(draw.randrange(30), 9),
            draw.randrange(3),
        )
        for _ in range(600)
    ]
    listed, counts = _simulate(clicks, threshold, seconds)
    rows = click_rows(*[(at.strftime("%Y-%m-%d %H:%M:%S"), u, a) for at, u, a in clicks])
    batch = F.floor(F.unix_seconds("ts") / seconds)
    assert dict(_rows(blacklist_replay(rows, threshold, batch))) == listed
    got = replayed_daily_clicks(rows, threshold, batch).collect()
    assert {(r.date, r.user_id, r.ad_id): r.click_count for r in got} == dict(counts)

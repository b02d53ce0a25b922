from __future__ import annotations

import random
from datetime import UTC, datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from clickloom.operators.adclicks import (
    ad_minute_clicks,
    blacklist_replay,
    replayed_daily_clicks,
)
from clickloom.plans import AdMonitor, start_ad_monitor
from clickloom.plans.ad_monitoring import blacklist_store
from clickloom.schemas import AD_BLACKLIST
from clickloom.sources import parse_ad_log, read_file_lines, valid_clicks
from clickloom.streaming import (
    AVAILABLE_NOW,
    start_ad_trend,
    start_click_copy,
    start_daily_counts,
    start_filtered_clicks,
)

START = datetime(2024, 1, 1, tzinfo=UTC)


class Feed:
    """A folder of log lines that grows part by part, and the jobs that read it."""

    def __init__(self, spark, root):
        self.spark, self.root, self.parts = spark, str(root), 0
        self.monitor = AdMonitor(spark, f"{self.root}/monitor")

    def add(self, *lines: str, folder: str = "lines") -> None:
        folder = f"{self.root}/{folder}"
        rows = self.spark.createDataFrame([(v,) for v in lines], "value string")
        rows.coalesce(1).write.mode("append").text(folder)

    def clicks(self, folder: str = "lines"):
        return valid_clicks(parse_ad_log(read_file_lines(self.spark, f"{self.root}/{folder}")))

    def count(self, threshold=100, checkpoint="daily_counts", folder="lines", rewrite=2) -> None:
        start_daily_counts(
            self.clicks(folder),
            self.monitor.counts,
            self.monitor.listed,
            self.monitor.checkpoint(checkpoint),
            threshold,
            AVAILABLE_NOW,
            rewrite,
        ).awaitTermination()

    def counts(self) -> dict:
        rows = self.monitor.user_click_counts().collect()
        return {(r.date, r.user_id, r.ad_id): r.click_count for r in rows}

    def listed(self) -> list:
        return sorted(r.user_id for r in self.monitor.blacklist().collect())


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path)


def _line(at: datetime, user: int, ad: int) -> str:
    return f"{int(at.timestamp() * 1000)} p c {user} {ad}"


def _lines(n: int, user: int = 1, ad: int = 1, at: datetime = START) -> list[str]:
    return [_line(at, user, ad)] * n


def test_counts_build_up_and_listed_users_stop(feed):
    feed.add(*_lines(60), *_lines(99, user=2))
    feed.count()
    assert (feed.counts(), feed.listed()) == (
        {("2024-01-01", 1, 1): 60, ("2024-01-01", 2, 1): 99},
        [],
    )
    feed.add(*_lines(40))
    feed.count()
    assert (feed.counts()["2024-01-01", 1, 1], feed.listed()) == (100, [1])
    feed.add(*_lines(5), *_lines(5, ad=2), *_lines(1, user=2))
    feed.count()
    assert feed.counts() == {("2024-01-01", 1, 1): 100, ("2024-01-01", 2, 1): 100}
    assert feed.listed() == [1, 2]


def test_threshold_per_ad_and_day(feed):
    feed.add(*_lines(60), *_lines(60, ad=2))
    feed.count()
    feed.add(*_lines(60, at=START + timedelta(days=1)))
    feed.count()
    assert feed.listed() == []


def test_user_is_listed_once(spark, feed):
    feed.add(*_lines(3), *_lines(3, ad=2))
    feed.count(threshold=3)
    feed.add(*_lines(3, ad=3))
    feed.count(threshold=3)
    rows = feed.monitor.listed.read().collect()
    assert [r.user_id for r in rows] == [1]


def test_start_without_new_lines_changes_nothing(feed):
    feed.add(*_lines(3))
    feed.count(threshold=3)
    before = feed.counts(), feed.listed()
    feed.count(threshold=3)
    assert (feed.counts(), feed.listed()) == before


def test_malformed_lines_do_not_stop_the_job(feed):
    feed.add("x 1 1 2", *_lines(2), "")
    feed.count()
    assert feed.counts() == {("2024-01-01", 1, 1): 2}


def test_stream_equals_replay(spark, feed):
    draw = random.Random(11)
    batches = []
    for number in range(4):
        batches.append(
            [
                (
                    START + timedelta(seconds=draw.randrange(0, 2 * 86400)),
                    min(draw.randrange(20), 8),
                    draw.randrange(2),
                    number,
                )
                for _ in range(80)
            ]
        )
        feed.add(*[_line(at, user, ad) for at, user, ad, _ in batches[-1]])
        feed.count(threshold=6)
    clicks = spark.createDataFrame(
        [(at.timestamp(), u, a, b) for batch in batches for at, u, a, b in batch],
        "at double, user_id long, ad_id long, b long",
    ).selectExpr("timestamp_seconds(at) AS ts", "user_id", "ad_id", "b")
    expected = blacklist_replay(clicks, 6, F.col("b")).collect()
    assert feed.listed() == sorted(r.user_id for r in expected) != []
    assert min(r.listed_in for r in expected) < 3
    counts = replayed_daily_clicks(clicks, 6, F.col("b")).collect()
    assert feed.counts() == {(r.date, r.user_id, r.ad_id): r.click_count for r in counts}


def test_batch_that_runs_again_gives_the_same(spark, feed):
    """The last batch is taken out of the commit log, as after a crash before its commit."""
    feed.add(*_lines(60))
    feed.count()
    feed.add(*_lines(40), *_lines(2, user=2))
    feed.count()
    before = feed.counts(), feed.listed()
    commits = Path(feed.monitor.checkpoint("daily_counts")) / "commits"
    last = max(int(f.name) for f in commits.iterdir() if f.name.isdigit())
    for name in (f"{last}", f".{last}.crc"):
        (commits / name).unlink(missing_ok=True)
    feed.count()
    assert (feed.counts(), feed.listed()) == before
    feed.add(*_lines(5), *_lines(1, user=2))
    feed.count()
    assert feed.counts() == {("2024-01-01", 1, 1): 100, ("2024-01-01", 2, 1): 3}


def test_late_clicks_count_for_their_day(feed):
    feed.add(*_lines(2))
    feed.count()
    feed.add(*_lines(1, at=START + timedelta(days=300)))
    feed.count()
    feed.add(*_lines(1), *_lines(1, at=START - timedelta(days=300)))
    feed.count()
    assert feed.counts() == {
        ("2024-01-01", 1, 1): 3,
        ("2024-10-27", 1, 1): 1,
        ("2023-03-07", 1, 1): 1,
    }


@pytest.mark.parametrize("poison", ["7258118400000", "9223372036854775807", "-99999999999999999"])
def test_impossible_times_are_rejected_and_change_nothing(spark, feed, poison):
    for part in (_lines(5, user=7), [f"{poison} 1 1 7 1"], _lines(5, user=7)):
        feed.add(*part)
        for job in start_ad_monitor(
            read_file_lines(spark, f"{feed.root}/lines"), feed.monitor.root, trigger=AVAILABLE_NOW
        ):
            job.awaitTermination()
    assert feed.counts() == {("2024-01-01", 7, 1): 10}
    assert [r.click_count for r in feed.monitor.click_trend().collect()] == [10]
    rejected = spark.read.text(feed.monitor.rejected_path).collect()
    assert [r.value for r in rejected] == [f"{poison} 1 1 7 1"]


def test_bound_of_the_future_is_taken_from_the_arrival(spark):
    lines = spark.createDataFrame(
        [(_line(START, 1, 1), START - timedelta(hours=23)),
         (_line(START, 2, 1), START - timedelta(hours=25))],
        "value string, arrived timestamp",
    )
    users = lambda **more: [
        r.user_id for r in valid_clicks(parse_ad_log(lines, arrival="arrived", **more)).collect()
    ]
    assert users() == [1]
    assert users(ahead="2 DAYS") == [1, 2]


def test_a_new_checkpoint_goes_on(feed):
    feed.add(*_lines(5, user=7), *_lines(3, user=8))
    feed.count(threshold=5)
    assert feed.listed() == [7]
    feed.add(*_lines(1, user=7), *_lines(1, user=8), folder="more")
    feed.count(threshold=5, checkpoint="new", folder="more")
    assert feed.counts() == {("2024-01-01", 7, 1): 5, ("2024-01-01", 8, 1): 4}
    feed.add(*_lines(1, user=8), folder="more")
    feed.count(threshold=5, checkpoint="new", folder="more")
    assert feed.counts()["2024-01-01", 8, 1] == 5 and feed.listed() == [7, 8]


def test_no_batch_reads_stored_totals(spark, feed):
    """With the table out of the way the state store alone goes on."""
    feed.add(*_lines(60))
    feed.count()
    kept = Path(feed.monitor.counts.path)
    kept.rename(kept.with_name("elsewhere"))
    feed.add(*_lines(39), *_lines(2, user=2))
    feed.count()
    assert feed.counts() == {("2024-01-01", 1, 1): 99, ("2024-01-01", 2, 1): 2}
    assert feed.listed() == []


def test_crowded_dates_are_rewritten_between_batches(feed):
    for _ in range(6):
        feed.add(*_lines(1), *_lines(1, user=2))
        feed.count(rewrite=3)
    folder = Path(feed.monitor.counts.path) / "date=2024-01-01"
    assert len(list(folder.glob("*.parquet"))) < 6
    assert feed.counts() == {("2024-01-01", 1, 1): 6, ("2024-01-01", 2, 1): 6}


def test_filtered_clicks_see_the_list_of_each_batch(spark, feed):
    listed = blacklist_store(spark, f"{feed.root}/list")

    path = f"{feed.root}/clicks"

    def run(checkpoint="checkpoint"):
        start_filtered_clicks(
            feed.clicks(), listed, path, f"{feed.root}/{checkpoint}", AVAILABLE_NOW
        ).awaitTermination()
        return sorted((r.batch_id, r.user_id) for r in spark.read.parquet(path).collect())

    feed.add(*_lines(1, user=1), *_lines(1, user=2))
    assert run() == [(0, 1), (0, 2)]
    listed.add(spark.createDataFrame([(2,)], AD_BLACKLIST))
    feed.add(*_lines(1, user=1), *_lines(1, user=2))
    assert run() == [(0, 1), (0, 2), (1, 1)]
    # the batches of a new checkpoint do not replace those of the first
    assert run("new") == [(0, 1), (0, 1), (0, 1), (0, 2), (1, 1)]


def test_trend_equals_batch(spark, feed):
    draw = random.Random(5)
    everything = []
    for number in range(3):
        clicks = [
            (
                START + timedelta(minutes=20 * number, seconds=draw.randrange(0, 1500)),
                1,
                draw.randrange(3),
            )
            for _ in range(100)
        ]
        everything += clicks
        feed.add(*[_line(*c) for c in clicks])
        start_ad_trend(
            feed.clicks(),
            feed.monitor.trend,
            feed.monitor.checkpoint("ad_trend"),
            AVAILABLE_NOW,
            rewrite_every=1,
        ).awaitTermination()
    batch = spark.createDataFrame(
        [(at.timestamp(), u, a) for at, u, a in everything], "at double, user_id long, ad_id long"
    ).selectExpr("timestamp_seconds(at) AS ts", "user_id", "ad_id")
    expected = sorted(tuple(r) for r in ad_minute_clicks(batch).collect())
    assert sorted(tuple(r) for r in feed.monitor.click_trend().collect()) == expected


def test_monitor_runs_all_jobs(spark, feed):
    feed.add(*_lines(3), *_lines(1, user=2), "broken")
    jobs = start_ad_monitor(
        read_file_lines(spark, f"{feed.root}/lines"),
        feed.monitor.root,
        threshold=3,
        trigger=AVAILABLE_NOW,
    )
    for job in jobs:
        job.awaitTermination()
    assert feed.listed() == [1]
    assert [tuple(r) for r in feed.monitor.click_trend().collect()] == [
        ("2024-01-01", "00", "00", 1, 4)
    ]
    rejected = spark.read.text(feed.monitor.rejected_path)
    assert [r.value for r in rejected.collect()] == ["broken"]


def test_micro_batches_run_until_stopped(spark, feed):
    feed.add(*_lines(3))
    path = f"{feed.root}/copy"
    job = start_click_copy(feed.clicks(), path, f"{feed.root}/checkpoint")
    try:
        job.processAllAvailable()
        assert spark.read.parquet(path).count() == 3
        feed.add(*_lines(2))
        job.processAllAvailable()
        assert spark.read.parquet(path).count() == 5
        assert job.isActive
        assert [p["batchId"] for p in job.recentProgress if p["numInputRows"]] == [0, 1]
    finally:
        job.stop()


def test_days_have_to_be_utc_days(spark, feed):
    feed.add(*_lines(1))
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        with pytest.raises(ValueError):
            feed.count()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")

"""Ad click counts, blacklist and trend on bounded data.

A click has ``ts``, ``user_id`` and ``ad_id``.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from clickloom.functions import format_date, minute_key
from clickloom.operators.joins import keep_or_drop
from clickloom.schemas import (
    BATCH_SECONDS,
    BLACKLIST_THRESHOLD,
    TREND_SLIDE_SECONDS,
    TREND_WINDOW_MINUTES,
)

_DAY_KEY = ("date", "user_id", "ad_id")


def ad_day_key(clicks: DataFrame) -> DataFrame:
    """Day, user and ad of each click."""
    return clicks.select(format_date(F.col("ts")).alias("date"), "user_id", "ad_id")


def ad_minute_key(clicks: DataFrame) -> DataFrame:
    """Start of the minute and ad of each click."""
    return clicks.select(F.date_trunc("minute", "ts").alias("minute_ts"), "ad_id")


def trend_columns(counts: DataFrame) -> DataFrame:
    """``minute_ts`` split into date, hour and minute texts."""
    at = F.col("minute_ts")
    return counts.select(
        format_date(at).alias("date"),
        F.date_format(at, "HH").alias("hour"),
        F.date_format(at, "mm").alias("minute"),
        "ad_id",
        "click_count",
    )


def daily_user_ad_clicks(clicks: DataFrame) -> DataFrame:
    """Clicks per day, user and ad."""
    return ad_day_key(clicks).groupBy(*_DAY_KEY).agg(F.count(F.lit(1)).alias("click_count"))


def ad_minute_clicks(clicks: DataFrame) -> DataFrame:
    """Clicks per minute and ad."""
    counts = (
        ad_minute_key(clicks)
        .groupBy("minute_ts", "ad_id")
        .agg(F.count(F.lit(1)).alias("click_count"))
    )
    return trend_columns(counts)


def over_threshold(counts: DataFrame, threshold: int = BLACKLIST_THRESHOLD) -> DataFrame:
    """Day counts that reach the threshold."""
    return counts.where(F.col("click_count") >= threshold)


def blacklist_users(counts: DataFrame, threshold: int = BLACKLIST_THRESHOLD) -> DataFrame:
    """Distinct users with a day count that reaches the threshold."""
    return over_threshold(counts, threshold).select("user_id").distinct()


def without_blacklisted(
    clicks: DataFrame, blacklist: DataFrame, salts: int = 1
) -> DataFrame:
    """Clicks of users who are not on the list; a hot user is split."""
    return keep_or_drop(clicks, blacklist, "user_id", "left_anti", salts)


def accumulated_counts(
    batch_counts: DataFrame, totals: DataFrame, keys: Sequence[str] = _DAY_KEY
) -> DataFrame:
    """New totals of the keys of a batch: their stored total, if any, plus the batch count.

    One equi-join looks up all keys of the batch.
    """
    stored = totals.select(*keys, F.col("click_count").alias("_stored"))
    return batch_counts.join(stored, list(keys), "left").select(
        *keys,
        (F.col("click_count") + F.coalesce("_stored", F.lit(0).cast("bigint"))).alias(
            "click_count"
        ),
    )


def lookup_user_click_count(keys: DataFrame, totals: DataFrame) -> DataFrame:
    """Stored count of each key (date, user, ad); keys without one are left out."""
    return keys.select(*_DAY_KEY).join(
        totals.select(*_DAY_KEY, "click_count"), list(_DAY_KEY), "inner"
    )


def ad_trend_last_hour(clicks: DataFrame, minutes: int = TREND_WINDOW_MINUTES) -> DataFrame:
    """Clicks per ad and minute over the last ``minutes`` minutes up to the newest click.

    The newest time comes from a one-column scan; the second scan reads only row groups
    at or after the first minute. For that ``ts`` has to be a stored column, with or
    without a time zone, and no expression.
    """
    reach = F.make_dt_interval(mins=F.lit(minutes - 1))
    kind = clicks.schema["ts"].dataType
    first = clicks.agg((F.date_trunc("minute", F.max("ts")) - reach).cast(kind)).scalar()
    return ad_minute_clicks(clicks.where(F.col("ts") >= first))


def ad_trend_sliding(
    clicks: DataFrame,
    window_minutes: int = TREND_WINDOW_MINUTES,
    slide_seconds: int = TREND_SLIDE_SECONDS,
) -> DataFrame:
    """Clicks per ad and minute inside every position of a sliding window.

    A window ends at each multiple of the slide and reaches back ``window_minutes``;
    its end is exclusive. Only clicks counted by (minute, ad, slide step in the minute)
    are shuffled; all window positions of a minute are then computed within its row from
    running sums of the steps.
    """
    span = window_minutes * 60
    if span % slide_seconds:
        raise ValueError("the window has to be a multiple of the slide")
    steps = ceil(60 / slide_seconds) + (60 % slide_seconds > 0 and slide_seconds % 60 > 0)
    reach = span // slide_seconds

    def step_of(epoch: Column) -> Column:
        return F.call_function("div", epoch, F.lit(slide_seconds).cast("bigint"))

    minute_ts = F.date_trunc("minute", "ts")
    placed = clicks.select(
        minute_ts.alias("minute_ts"),
        "ad_id",
        (step_of(F.unix_seconds("ts")) - step_of(F.unix_seconds(minute_ts))).alias("_step"),
    )
    counted = placed.groupBy("minute_ts", "ad_id").agg(
        *[F.count_if(F.col("_step") == i).alias(f"_n{i}") for i in range(steps)]
    )
    running = [F.lit(0).cast("bigint")]
    for i in range(steps):
        running.append(running[-1] + F.col(f"_n{i}"))
    position = F.col("_position")
    inside = F.get("_running", F.least(position, F.lit(steps))) - F.get(
        "_running", F.greatest(position - reach, F.lit(0))
    )
    end = (step_of(F.unix_seconds("minute_ts")) + position) * slide_seconds
    return (
        counted.select("minute_ts", "ad_id", F.array(*running).alias("_running"))
        .withColumn("minute_key", minute_key(F.col("minute_ts")))
        .withColumn("_position", F.explode(F.sequence(F.lit(1), F.lit(steps - 1 + reach))))
        .select(
            F.timestamp_seconds(end).alias("window_end"),
            "minute_key",
            "ad_id",
            inside.alias("click_count"),
        )
        .where("click_count > 0")
    )


def batch_number(seconds: int = BATCH_SECONDS) -> Column:
    """Number of the micro-batch a click falls into when it arrives at its own time."""
    return F.call_function("div", F.unix_seconds("ts"), F.lit(seconds).cast("bigint"))


def _counts_by_batch(clicks: DataFrame, batch: Column) -> DataFrame:
    return (
        clicks.select(
            format_date(F.col("ts")).alias("date"), "user_id", "ad_id", batch.alias("batch")
        )
        .groupBy(*_DAY_KEY, "batch")
        .agg(F.count(F.lit(1)).alias("click_count"))
    )


def _listed_since(counts: DataFrame, threshold: int) -> DataFrame:
    # at most one row per batch and day in a window, however many clicks the key has
    so_far = F.sum("click_count").over(W.partitionBy(*_DAY_KEY).orderBy("batch"))
    return (
        counts.withColumn("_so_far", so_far)
        .where(F.col("_so_far") >= threshold)
        .groupBy("user_id")
        .agg(F.min("batch").alias("listed_in"))
    )


def blacklist_replay(
    clicks: DataFrame, threshold: int = BLACKLIST_THRESHOLD, batch: Column | None = None
) -> DataFrame:
    """The users a stream over the same clicks puts on the blacklist, with the batch.

    A user is listed in the first batch in which one of their (day, ad) counts reaches
    the threshold. Clicks dropped later cannot change that, so the counts need no
    feedback from the list.
    """
    counts = _counts_by_batch(clicks, batch_number() if batch is None else batch)
    return _listed_since(counts, threshold)


def replayed_daily_clicks(
    clicks: DataFrame, threshold: int = BLACKLIST_THRESHOLD, batch: Column | None = None
) -> DataFrame:
    """Day counts the stream ends with: clicks up to and including the listing batch."""
    counts = _counts_by_batch(clicks, batch_number() if batch is None else batch)
    listed = _listed_since(counts, threshold).withColumnRenamed("user_id", "_listed_user")
    # the null-safe equality adds no null filter to one side only, so both sides stay the
    # same aggregation and share one scan and one exchange
    return (
        counts.join(listed, F.col("user_id").eqNullSafe(F.col("_listed_user")), "left")
        .where(F.col("listed_in").isNull() | (F.col("batch") <= F.col("listed_in")))
        .groupBy(*_DAY_KEY)
        .agg(F.sum("click_count").alias("click_count"))
    )

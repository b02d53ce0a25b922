"""Random sample of sessions, stratified by day and start hour."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.functions import format_date, format_time
from clickloom.operators.joins import keep_or_drop
from clickloom.operators.sessions import session_texts
from clickloom.schemas import SAMPLE_TOTAL, SESSION_DETAIL_COLUMNS

# Hash ranges an hour's sessions are counted in.
RANK_BUCKETS = 256


def _start_hour() -> Column:
    """Hour of the session start on the clock of the session time zone, as one number.

    Cheaper to group and sort by than the two texts it stands for.
    """
    return F.date_trunc("hour", "start_ts").cast("timestamp_ntz")


def _date_and_hour(at: str) -> list[Column]:
    return [format_date(F.col(at)).alias("date"), F.date_format(at, "HH").alias("hour")]


def session_hour_key(sessions: DataFrame) -> DataFrame:
    """Adds the ``date`` and ``hour`` of the session start.

    Sessions without any readable action time have no start and are left out.
    """
    return sessions.where(F.col("start_ts").isNotNull()).select("*", *_date_and_hour("start_ts"))


def sessions_per_hour(sessions: DataFrame) -> DataFrame:
    """Sessions by date and hour of their start."""
    counts = (
        sessions.where(F.col("start_ts").isNotNull())
        .groupBy(_start_hour().alias("_hour"))
        .agg(F.count(F.lit(1)).alias("session_count"))
    )
    return counts.select(*_date_and_hour("_hour"), "session_count")


def sessions_per_day(per_hour: DataFrame) -> DataFrame:
    """Adds ``day_count``, the day's sum over its at most 24 hours."""
    hours = F.collect_list(F.struct(*[c for c in per_hour.columns if c != "date"]))
    days = per_hour.groupBy("date").agg(
        F.sum("session_count").alias("day_count"), hours.alias("_hours")
    )
    return days.select("date", "day_count", F.inline("_hours")).select(
        *per_hour.columns, "day_count"
    )


def _with_quota(per_hour: DataFrame, total: int) -> DataFrame:
    # counting the days through session_count (never 0) keeps this subquery the same
    # aggregation as the main branch, so its exchange is reused
    days = F.count_distinct(F.when(F.col("session_count") > 0, F.col("date")))
    day_quota = per_hour.agg(
        F.call_function(
            "div", F.lit(total).cast("bigint"), F.nullif(days, F.lit(0).cast("bigint"))
        )
    ).scalar()
    share = F.col("session_count").cast("double") / F.col("day_count") * day_quota
    return sessions_per_day(per_hour).withColumn(
        "quota", F.least("session_count", F.floor(share).cast("bigint"))
    )


def sample_quota(per_hour: DataFrame, total: int = SAMPLE_TOTAL) -> DataFrame:
    """Sessions to draw per hour.

    ``total`` is spread evenly over the days, a day's share over its hours by their
    sessions; both are cut to whole numbers, so thin hours get none.
    """
    return _with_quota(per_hour, total).select(
        "date", "hour", "session_count", "day_count", "quota"
    )


def _last_range(ranges: Column, quota: Column) -> Column:
    """The range in which the counts of (range, count) in order reach the quota."""
    return F.aggregate(
        ranges,
        F.struct(F.lit(0).cast("bigint").alias("sum"), F.lit(-1).cast("bigint").alias("last")),
        lambda so_far, x: F.struct(
            (so_far["sum"] + x["n"]).alias("sum"),
            F.when(so_far["sum"] < quota, x["range"]).otherwise(so_far["last"]).alias("last"),
        ),
        lambda so_far: so_far["last"],
    )


def sample_sessions(
    sessions: DataFrame,
    total: int = SAMPLE_TOTAL,
    seed: int = 0,
    buckets: int = RANK_BUCKETS,
) -> DataFrame:
    """Draws each hour's quota of sessions without replacement, reproducibly.

    The sample of an hour are its sessions with the smallest ``md5(seed, session id)``. They
    are first counted by hour and range of that hash, which also gives the hours' quotas and
    the range in which each quota is reached. Sessions beyond it are dropped where they are
    read; what is shuffled and sorted are the quotas and one range of each hour, a 256th of
    it, whatever the number of sessions. No row is ranked by a window.
    """
    key = F.md5(F.concat(F.lit(str(seed)), F.coalesce("session_id", F.lit(""))))
    keyed = sessions.where(F.col("start_ts").isNotNull()).select(
        "session_id", "start_ts", _start_hour().alias("_hour"), key.alias("_key")
    )
    # the first 32 bits of the hash order like the whole
    high = F.conv(F.substring("_key", 1, 8), 16, 10).cast("bigint")
    keyed = keyed.withColumn("_range", F.shiftright(high * buckets, 32))
    counts = keyed.groupBy("_hour", "_range").agg(F.count(F.lit(1)).alias("n"))
    ranges = F.sort_array(F.collect_list(F.struct(F.col("_range").alias("range"), "n")))
    per_hour = (
        counts.groupBy("_hour")
        .agg(F.sum("n").alias("session_count"), ranges.alias("_ranges"))
        .select(*_date_and_hour("_hour"), "_hour", "session_count", "_ranges")
    )
    quotas = (
        _with_quota(per_hour, total)
        .where("quota > 0")
        .select("_hour", "quota", _last_range(F.col("_ranges"), F.col("quota")).alias("_last"))
    )
    found = keyed.join(quotas, "_hour").where(F.col("_range") <= F.col("_last"))
    drawn = found.groupBy("_hour").agg(
        F.min("quota").cast("int").alias("_quota"),
        F.sort_array(F.collect_list(F.struct("_key", "session_id", "start_ts"))).alias("_rows"),
    )
    return drawn.select("_hour", F.inline(F.slice("_rows", F.lit(1), F.col("_quota")))).select(
        "session_id", "start_ts", *_date_and_hour("_hour")
    )


def sampled_actions(actions: DataFrame, sample: DataFrame) -> DataFrame:
    """The actions of the sampled sessions; a hot session is split.

    The ids are broadcast when the optimizer knows them to be few, as it does for a sample
    that was written and read back.
    """
    return keep_or_drop(actions, sample, "session_id", "left_semi")


def random_extract_sessions(
    actions: DataFrame, sample: DataFrame, task_id: int
) -> DataFrame:
    """The sampled sessions with their keywords and clicked categories.

    The texts are built for sampled sessions only.
    """
    texts = session_texts(sampled_actions(actions, sample))
    return sample.join(texts, "session_id", "left").select(
        F.lit(task_id).cast("bigint").alias("task_id"),
        "session_id",
        format_time(F.col("start_ts")).alias("start_time"),
        "click_category_ids",
        "search_keywords",
    )


def session_detail(actions: DataFrame, task_id: int) -> DataFrame:
    """Actions in the column order of the detail table."""
    at = F.col("action_time")
    if not isinstance(actions.schema["action_time"].dataType, T.StringType):
        at = format_time(at)
    return actions.withColumn("action_time", at).select(
        F.lit(task_id).cast("bigint").alias("task_id"), *SESSION_DETAIL_COLUMNS
    )


def extracted_session_detail(
    actions: DataFrame, sample: DataFrame, task_id: int
) -> DataFrame:
    """All actions of the sampled sessions."""
    return session_detail(sampled_actions(actions, sample), task_id)

"""Streaming queries.

Each derives log lines from the given events, feeds them to a file stream in parts, and
returns the table the stream has written. A part is one micro-batch: the stream runs
until it has read what is there, and is started again from its checkpoint for the next.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clickloom.operators.adclicks import blacklist_users, daily_user_ad_clicks
from clickloom.plans.ad_monitoring import AdMonitor, blacklist_store
from clickloom.queries import model
from clickloom.queries.ads import BASE_SQL, MINUTELY_SQL, THRESHOLD, replay_sql
from clickloom.queries.model import CLICKS_SQL, EVENTS_SQL, LINES_SQL, with_sql
from clickloom.queries.registry import query
from clickloom.session import new_work_dir
from clickloom.sources import parse_ad_log, read_file_lines, rejected_lines, valid_clicks
from clickloom.streaming import (
    AVAILABLE_NOW,
    start_ad_trend,
    start_click_copy,
    start_daily_counts,
    start_filtered_clicks,
    start_rejected_copy,
    start_window_trend,
)

PARTS = 3


def by_hours() -> Column:
    """Night, day and evening: every day's counts build up over all parts."""
    return F.floor(F.hour("ts") / 8)


def by_days() -> Column:
    """The three thirds of a month, in order of time."""
    return F.least(F.floor((F.dayofmonth("ts") - 1) / 10), F.lit(PARTS - 1))


def _run_parts(
    spark: SparkSession,
    folder: str,
    work: str,
    part: Column,
    start: Callable[[DataFrame], StreamingQuery],
    apart: bool = False,
) -> None:
    """Feed the parts one after the other; ``apart`` from folders of their own."""
    lines = model.log_lines(spark, folder)
    for number in range(PARTS):
        place = f"{work}/lines{number if apart else ''}"
        lines.where(part == number).select("value").write.mode("append").text(place)
        start(read_file_lines(spark, place)).awaitTermination()


_CLICK = (
    "SELECT epoch_us(ts) // 1000 AS at_millis, CAST(province AS VARCHAR) AS province,"
    " CAST(city AS VARCHAR) AS city, user_id, ad_id FROM ad_click"
)
_CLICKS = with_sql(EVENTS_SQL, CLICKS_SQL)


def _with_millis(clicks: DataFrame) -> DataFrame:
    return clicks.withColumn("at_millis", F.unix_millis("ts")).drop("ts")


@query("stream_ad_clicks", _CLICKS + _CLICK)
def stream_ad_clicks(spark: SparkSession, folder: str) -> DataFrame:
    work = new_work_dir(spark, "stream_ad_clicks")

    def start(lines: DataFrame) -> StreamingQuery:
        clicks = valid_clicks(parse_ad_log(lines))
        return start_click_copy(clicks, f"{work}/clicks", f"{work}/checkpoint", AVAILABLE_NOW)

    _run_parts(spark, folder, work, by_days(), start)
    return _with_millis(spark.read.parquet(f"{work}/clicks"))


@query(
    "stream_rejected_lines",
    with_sql(EVENTS_SQL, LINES_SQL) + "SELECT value AS line FROM ad_log WHERE event_type = 'error'",
)
def stream_rejected_lines(spark: SparkSession, folder: str) -> DataFrame:
    work = new_work_dir(spark, "stream_rejected_lines")

    def start(lines: DataFrame) -> StreamingQuery:
        rejected = rejected_lines(parse_ad_log(lines))
        return start_rejected_copy(
            rejected, f"{work}/rejected", f"{work}/checkpoint", AVAILABLE_NOW
        )

    _run_parts(spark, folder, work, by_days(), start)
    return spark.read.text(f"{work}/rejected").withColumnRenamed("value", "line")


def _filtered_clicks(
    spark: SparkSession, folder: str, part: Column, listed: DataFrame | None
) -> DataFrame:
    work = new_work_dir(spark, "stream_filtered_clicks")
    blacklist = blacklist_store(spark, f"{work}/blacklist")
    if listed is not None:
        blacklist.add(listed)

    def start(lines: DataFrame) -> StreamingQuery:
        clicks = valid_clicks(parse_ad_log(lines))
        return start_filtered_clicks(
            clicks, blacklist, f"{work}/clicks", f"{work}/checkpoint", AVAILABLE_NOW
        )

    _run_parts(spark, folder, work, part, start)
    return spark.read.parquet(f"{work}/clicks").withColumn("batch_id", F.col("batch_id").cast("long"))


@query(
    "stream_micro_batch",
    _CLICKS
    + "SELECT least((day(ts) - 1) // 10, 2) AS batch_id, count(*) AS click_count"
    " FROM ad_click GROUP BY ALL",
)
def stream_micro_batch(spark: SparkSession, folder: str) -> DataFrame:
    """Clicks per micro-batch."""
    rows = _filtered_clicks(spark, folder, by_days(), None)
    return rows.groupBy("batch_id").agg(F.count(F.lit(1)).alias("click_count"))


@query(
    "stream_blacklist_filter",
    BASE_SQL + _CLICK + " WHERE user_id NOT IN (SELECT user_id FROM listed)",
)
def stream_blacklist_filter(spark: SparkSession, folder: str) -> DataFrame:
    listed = blacklist_users(daily_user_ad_clicks(model.clicks(spark, folder)), THRESHOLD)
    rows = _filtered_clicks(spark, folder, by_days(), listed)
    return _with_millis(rows).drop("run", "batch_id")


def _monitored(
    spark: SparkSession,
    folder: str,
    part: Column,
    threshold: int = THRESHOLD,
    restart: bool = False,
) -> AdMonitor:
    """Day counts over the parts; with ``restart`` each part has a new checkpoint."""
    work = new_work_dir(spark, "stream_daily_counts")
    monitor = AdMonitor(spark, work)
    starts = []

    def start(lines: DataFrame) -> StreamingQuery:
        starts.append(f"daily_counts_{len(starts)}" if restart else "daily_counts")
        return start_daily_counts(
            valid_clicks(parse_ad_log(lines)),
            monitor.counts,
            monitor.listed,
            monitor.checkpoint(starts[-1]),
            threshold,
            AVAILABLE_NOW,
            rewrite_every=2,
        )

    _run_parts(spark, folder, work, part, start, apart=restart)
    return monitor


_REPLAY = replay_sql("hour(ts) // 8")


@query("stream_daily_clicks", _REPLAY + "SELECT * FROM remaining")
def stream_daily_clicks(spark: SparkSession, folder: str) -> DataFrame:
    return _monitored(spark, folder, by_hours()).user_click_counts()


@query("stream_generate_blacklist", _REPLAY + "SELECT user_id FROM listed")
def stream_generate_blacklist(spark: SparkSession, folder: str) -> DataFrame:
    return _monitored(spark, folder, by_hours()).blacklist()


@query("restarted_daily_clicks", _REPLAY + "SELECT * FROM remaining")
def restarted_daily_clicks(spark: SparkSession, folder: str) -> DataFrame:
    """The same tables go on when every part is read by a query with a new checkpoint."""
    return _monitored(spark, folder, by_hours(), restart=True).user_click_counts()


@query("stream_late_clicks", BASE_SQL + "SELECT date, user_id, ad_id, click_count FROM daily")
def stream_late_clicks(spark: SparkSession, folder: str) -> DataFrame:
    """The end of the month comes first; clicks of weeks ago still count."""
    late_first = (PARTS - 1 - by_days()).cast("int")
    return _monitored(spark, folder, late_first, threshold=2**31).user_click_counts()


@query("stream_ad_trend", BASE_SQL + MINUTELY_SQL)
def stream_ad_trend(spark: SparkSession, folder: str) -> DataFrame:
    work = new_work_dir(spark, "stream_ad_trend")
    monitor = AdMonitor(spark, work)

    def start(lines: DataFrame) -> StreamingQuery:
        return start_ad_trend(
            valid_clicks(parse_ad_log(lines)),
            monitor.trend,
            monitor.checkpoint("ad_trend"),
            AVAILABLE_NOW,
            rewrite_every=2,
        )

    _run_parts(spark, folder, work, by_days(), start)
    return monitor.click_trend()


_WINDOW_SQL = _CLICKS + """,
step_clicks AS (
  SELECT ad_id, date_trunc('day', ts) AS began, epoch_us(ts) // 10000000 AS step, count(*) AS n
  FROM ad_click GROUP BY ALL
),
ends AS (
  SELECT ad_id, began,
         least(max(step) + 359, (SELECT max(step) FROM step_clicks)) AS last_window
  FROM step_clicks GROUP BY ad_id, began
)
SELECT strftime(began, '%Y-%m-%d') AS date, strftime(began, '%H') AS hour,
       strftime(began, '%M') AS minute, ad_id, CAST(sum(n) AS BIGINT) AS click_count
FROM step_clicks JOIN ends USING (ad_id, began)
WHERE step > last_window - 360
GROUP BY ALL"""


@query("stream_ad_trend_window", _WINDOW_SQL)
def stream_ad_trend_window(spark: SparkSession, folder: str) -> DataFrame:
    """Clicks that bear the first minute of their day and arrive when they happened.

    A minute's count rises and falls through the day; its last window with a click stays.
    """
    work = new_work_dir(spark, "stream_ad_trend_window")
    monitor = AdMonitor(spark, work)
    began = F.unix_millis(F.date_trunc("day", "ts"))
    lines = model.clicks(spark, folder).select(
        F.concat_ws(" ", began, "province", "city", "user_id", "ad_id").alias("value"),
        F.col("ts").alias("timestamp"),
        by_days().alias("part"),
    )
    for number in range(PARTS):
        lines.where(F.col("part") == number).write.mode("append").parquet(f"{work}/lines")
        arriving = spark.readStream.schema(lines.schema).parquet(f"{work}/lines")
        parsed = parse_ad_log(arriving, arrival="timestamp", keep=["timestamp"])
        start_window_trend(
            valid_clicks(parsed),
            monitor.window_trend,
            monitor.checkpoint("window_trend"),
            trigger=AVAILABLE_NOW,
            rewrite_every=2,
        ).awaitTermination()
    return monitor.click_window_trend()

"""Ad click queries on bounded data, and the tables written per batch.

The given clicks reach two per user, ad and day at most a few times, so that is the
threshold here.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.operators import adclicks as ops
from clickloom.plans.ad_monitoring import blacklist_store, click_count_store, trend_store
from clickloom.queries import model
from clickloom.queries.model import CLICKS_SQL, EVENTS_SQL, LINES_SQL, with_sql
from clickloom.queries.registry import query
from clickloom.session import new_work_dir
from clickloom.sinks import TotalsTable
from clickloom.sources import format_ad_log, parse_ad_log, rejected_lines, valid_clicks

THRESHOLD = 2

BASE_SQL = with_sql(
    EVENTS_SQL,
    CLICKS_SQL,
    """
daily AS (
  SELECT strftime(ts, '%Y-%m-%d') AS date, user_id, ad_id, count(*) AS click_count
  FROM ad_click GROUP BY ALL
)""",
    f"""
listed AS (SELECT DISTINCT user_id FROM daily WHERE click_count >= {THRESHOLD})""",
    """
minutely AS (
  SELECT strftime(ts, '%Y-%m-%d') AS date, strftime(ts, '%H') AS hour,
         strftime(ts, '%M') AS minute, ad_id, count(*) AS click_count
  FROM ad_click GROUP BY ALL
)""",
)

_DAILY = "SELECT date, user_id, ad_id, click_count FROM daily"
MINUTELY_SQL = "SELECT date, hour, minute, ad_id, click_count FROM minutely"
_CLICK = "epoch_us(ts) // 1000 AS at_millis, province, city, user_id, ad_id"


def _with_millis(clicks: DataFrame) -> DataFrame:
    return clicks.withColumn("at_millis", F.unix_millis("ts")).drop("ts")


def replay_sql(batch: str) -> str:
    """Listing batch per user and remaining counts; ``batch`` is a batch number over ``ts``."""
    return with_sql(
        EVENTS_SQL,
        CLICKS_SQL,
        f"""
per_batch AS (
  SELECT strftime(ts, '%Y-%m-%d') AS date, user_id, ad_id, {batch} AS batch,
         count(*) AS n
  FROM ad_click GROUP BY ALL
),
so_far AS (
  SELECT *, sum(n) OVER (PARTITION BY date, user_id, ad_id ORDER BY batch) AS total
  FROM per_batch
),
listed AS (
  SELECT user_id, min(batch) AS listed_in FROM so_far WHERE total >= {THRESHOLD}
  GROUP BY user_id
),
remaining AS (
  SELECT date, p.user_id, ad_id, CAST(sum(n) AS BIGINT) AS click_count
  FROM per_batch p LEFT JOIN listed l ON p.user_id = l.user_id
  WHERE l.listed_in IS NULL OR p.batch <= l.listed_in
  GROUP BY ALL
)""",
    )


# ---- log lines ----


@query(
    "parse_ad_log",
    with_sql(EVENTS_SQL, CLICKS_SQL)
    + "SELECT epoch_us(ts) // 1000 AS at_millis, CAST(province AS VARCHAR) AS province,"
    " CAST(city AS VARCHAR) AS city, user_id, ad_id FROM ad_click",
)
def parse_ad_log_query(spark: SparkSession, folder: str) -> DataFrame:
    return _with_millis(valid_clicks(parse_ad_log(model.log_lines(spark, folder))))


@query(
    "rejected_ad_log",
    with_sql(EVENTS_SQL, LINES_SQL) + "SELECT value AS line FROM ad_log WHERE event_type = 'error'",
)
def rejected_ad_log(spark: SparkSession, folder: str) -> DataFrame:
    return rejected_lines(parse_ad_log(model.log_lines(spark, folder)))


@query(
    "format_ad_log",
    with_sql(EVENTS_SQL, LINES_SQL) + "SELECT value FROM ad_log WHERE event_type = 'click'",
)
def format_ad_log_query(spark: SparkSession, folder: str) -> DataFrame:
    return format_ad_log(model.clicks(spark, folder))


# ---- keys ----


@query(
    "ad_day_key",
    BASE_SQL + "SELECT strftime(ts, '%Y-%m-%d') AS date, user_id, ad_id FROM ad_click",
)
def ad_day_key(spark: SparkSession, folder: str) -> DataFrame:
    return ops.ad_day_key(model.clicks(spark, folder))


@query(
    "ad_minute_key",
    BASE_SQL + "SELECT strftime(ts, '%Y%m%d%H%M') AS minute_key, ad_id FROM ad_click",
)
def ad_minute_key(spark: SparkSession, folder: str) -> DataFrame:
    return ops.ad_minute_key(model.clicks(spark, folder)).select(
        F.date_format("minute_ts", "yyyyMMddHHmm").alias("minute_key"), "ad_id"
    )


@query(
    "trend_key_split",
    BASE_SQL + "SELECT strftime(ts, '%Y-%m-%d') AS date, strftime(ts, '%H') AS hour,"
    " strftime(ts, '%M') AS minute, ad_id FROM ad_click",
)
def trend_key_split(spark: SparkSession, folder: str) -> DataFrame:
    keys = ops.ad_minute_key(model.clicks(spark, folder))
    return ops.trend_columns(keys.withColumn("click_count", F.lit(1))).drop("click_count")


# ---- counts and blacklist ----


@query("daily_user_ad_clicks", BASE_SQL + _DAILY)
def daily_user_ad_clicks(spark: SparkSession, folder: str) -> DataFrame:
    return ops.daily_user_ad_clicks(model.clicks(spark, folder))


@query("ad_minute_clicks", BASE_SQL + MINUTELY_SQL)
def ad_minute_clicks(spark: SparkSession, folder: str) -> DataFrame:
    return ops.ad_minute_clicks(model.clicks(spark, folder))


@query("blacklist_threshold", BASE_SQL + _DAILY + f" WHERE click_count >= {THRESHOLD}")
def blacklist_threshold(spark: SparkSession, folder: str) -> DataFrame:
    return ops.over_threshold(daily_user_ad_clicks(spark, folder), THRESHOLD)


@query("distinct_blacklist_users", BASE_SQL + "SELECT user_id FROM listed")
def distinct_blacklist_users(spark: SparkSession, folder: str) -> DataFrame:
    return ops.blacklist_users(daily_user_ad_clicks(spark, folder), THRESHOLD)


@query(
    "blacklist_filter",
    BASE_SQL + f"SELECT {_CLICK} FROM ad_click WHERE user_id NOT IN (SELECT user_id FROM listed)",
)
def blacklist_filter(spark: SparkSession, folder: str) -> DataFrame:
    listed = distinct_blacklist_users(spark, folder)
    return _with_millis(ops.without_blacklisted(model.clicks(spark, folder), listed))


@query("blacklist_snapshot", BASE_SQL + "SELECT user_id FROM listed")
def blacklist_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    """The list as written by one batch and read by the next."""
    listed = blacklist_store(spark, new_work_dir(spark, "ad_blacklist"))
    listed.add(distinct_blacklist_users(spark, folder))
    return listed.table()


@query("append_blacklist", BASE_SQL + "SELECT user_id FROM listed")
def append_blacklist(spark: SparkSession, folder: str) -> DataFrame:
    """Two batches: the users of the mornings' clicks, then those not yet listed of all."""
    listed = blacklist_store(spark, new_work_dir(spark, "ad_blacklist"))
    clicks = model.clicks(spark, folder)
    mornings = ops.daily_user_ad_clicks(clicks.where(F.hour("ts") < 12))
    listed.add(ops.blacklist_users(mornings, THRESHOLD))
    everyone = ops.blacklist_users(ops.daily_user_ad_clicks(clicks), THRESHOLD)
    listed.add(ops.without_blacklisted(everyone, listed.table()))
    return listed.read()


# ---- keyed tables ----


def _upsert(table: TotalsTable, counts: DataFrame) -> None:
    """Add counts to the totals of their keys, looked up by one join over their dates only."""
    dates = sorted(r.date for r in counts.select("date").distinct().collect())
    stored = table.table(dates=dates)
    table.add(ops.accumulated_counts(counts, stored, table.keys))


def _half_day_counts(
    spark: SparkSession, folder: str, between: Callable[[TotalsTable], None] | None = None
) -> TotalsTable:
    """Day counts added by two batches, the mornings' clicks and the rest."""
    counts = click_count_store(spark, new_work_dir(spark, "ad_user_click_count"))
    clicks = model.clicks(spark, folder)
    for part in (F.hour("ts") < 12, F.hour("ts") >= 12):
        _upsert(counts, ops.daily_user_ad_clicks(clicks.where(part)))
        if between is not None:
            between(counts)
    return counts


@query("upsert_user_click_count", BASE_SQL + _DAILY)
def upsert_user_click_count(spark: SparkSession, folder: str) -> DataFrame:
    return _half_day_counts(spark, folder).table()


@query("folded_user_click_count", BASE_SQL + _DAILY)
def folded_user_click_count(spark: SparkSession, folder: str) -> DataFrame:
    """Every date is rewritten with one row per key after either batch."""

    def rewrite(counts: TotalsTable) -> None:
        counts.rewrite(counts.crowded_dates(files=1))

    return _half_day_counts(spark, folder, rewrite).read()


@query(
    "lookup_user_click_count",
    BASE_SQL + _DAILY + " WHERE (date, user_id, ad_id) IN (SELECT strftime(ts, '%Y-%m-%d'),"
    " user_id, ad_id FROM ad_click WHERE hour(ts) >= 12)",
)
def lookup_user_click_count(spark: SparkSession, folder: str) -> DataFrame:
    """Stored counts of the keys the afternoons' clicks touch; only their days are opened."""
    counts = _half_day_counts(spark, folder)
    clicks = model.clicks(spark, folder)
    keys = ops.ad_day_key(clicks.where(F.hour("ts") >= 12)).distinct()
    dates = sorted(r.date for r in keys.select("date").distinct().collect())
    return ops.lookup_user_click_count(keys, counts.table(dates=dates))


@query("upsert_ad_click_trend", BASE_SQL + MINUTELY_SQL)
def upsert_ad_click_trend(spark: SparkSession, folder: str) -> DataFrame:
    """Minutes whose clicks come in two batches."""
    trend = trend_store(spark, new_work_dir(spark, "ad_click_trend"))
    clicks = model.clicks(spark, folder)
    for part in (F.second("ts") < 30, F.second("ts") >= 30):
        _upsert(trend, ops.ad_minute_clicks(clicks.where(part)))
    return trend.table()


# ---- trend ----


@query(
    "ad_trend_last_hour",
    BASE_SQL
    + MINUTELY_SQL
    + " WHERE CAST(date || ' ' || hour || ':' || minute || ':00' AS TIMESTAMP) >"
    " (SELECT max(ts) FROM ad_click) - INTERVAL 60 MINUTE",
)
def ad_trend_last_hour(spark: SparkSession, folder: str) -> DataFrame:
    return ops.ad_trend_last_hour(model.clicks(spark, folder, stored_time=True))


@query(
    "ad_trend_sliding",
    BASE_SQL
    + """
SELECT window_end, minute_key, ad_id, count(*) AS click_count
FROM (
  SELECT unnest(generate_series((step + 1) * 10, step * 10 + 3600, 10)) AS window_end,
         minute_key, ad_id
  FROM (SELECT epoch_us(ts) // 10000000 AS step, strftime(ts, '%Y%m%d%H%M') AS minute_key,
               ad_id FROM ad_click)
)
GROUP BY ALL""",
)
def ad_trend_sliding(spark: SparkSession, folder: str) -> DataFrame:
    rows = ops.ad_trend_sliding(model.clicks(spark, folder))
    return rows.withColumn("window_end", F.unix_seconds("window_end"))


# ---- replay ----

_REPLAY = replay_sql("epoch_us(ts) // 1000 // 5000")


@query("blacklist_replay", _REPLAY + "SELECT user_id, listed_in FROM listed")
def blacklist_replay(spark: SparkSession, folder: str) -> DataFrame:
    return ops.blacklist_replay(model.clicks(spark, folder), THRESHOLD)


@query("replayed_daily_clicks", _REPLAY + "SELECT * FROM remaining")
def replayed_daily_clicks(spark: SparkSession, folder: str) -> DataFrame:
    return ops.replayed_daily_clicks(model.clicks(spark, folder), THRESHOLD)

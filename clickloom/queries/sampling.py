"""Sampling queries.

The quota of a thin hour is cut to zero, so the total is set to suit 30 days of data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clickloom.operators import sampling as ops
from clickloom.operators.sessions import session_metrics, with_user
from clickloom.queries import model
from clickloom.queries.model import (
    ACTIONS_SQL,
    EVENTS_SQL,
    FULL_SQL,
    USERS_SQL,
    sessions_sql,
    with_sql,
)
from clickloom.queries.registry import query
from clickloom.session import new_work_dir
from clickloom.sinks import append_table

TOTAL = 3000
SEED = 7
TASK_ID = 1

_SAMPLE = with_sql(
    EVENTS_SQL,
    ACTIONS_SQL,
    USERS_SQL,
    sessions_sql(),
    FULL_SQL,
    f"""
keyed AS (
  SELECT *, strftime(start_ts, '%Y-%m-%d') AS date, strftime(start_ts, '%H') AS hour
  FROM full_sessions
),
per_hour AS (SELECT date, hour, count(*) AS session_count FROM keyed GROUP BY date, hour),
per_day AS (
  SELECT *, CAST(sum(session_count) OVER (PARTITION BY date) AS BIGINT) AS day_count
  FROM per_hour
),
quotas AS (
  SELECT *, least(session_count,
    CAST(floor(CAST(session_count AS DOUBLE) / day_count
               * ({TOTAL} // (SELECT count(DISTINCT date) FROM per_hour))) AS BIGINT)) AS quota
  FROM per_day
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY date, hour
                               ORDER BY md5('{SEED}' || session_id), session_id) AS rn
  FROM keyed
),
sample AS (
  SELECT r.* FROM ranked r JOIN quotas q ON r.date = q.date AND r.hour = q.hour
  WHERE r.rn <= q.quota
)""",
)

_EXTRACT = (
    f"SELECT CAST({TASK_ID} AS BIGINT) AS task_id, session_id, start_time,"
    " click_category_ids, search_keywords FROM sample"
)
_DETAIL = (
    f"SELECT CAST({TASK_ID} AS BIGINT) AS task_id, user_id, session_id, page_id,"
    " strftime(action_time, '%Y-%m-%d %H:%M:%S') AS action_time, search_keyword,"
    " click_category_id, click_product_id, order_category_ids, order_product_ids,"
    " pay_category_ids, pay_product_ids FROM user_visit_action"
    " WHERE session_id IN (SELECT session_id FROM sample)"
)


def _sessions(spark: SparkSession, folder: str) -> DataFrame:
    return with_user(session_metrics(model.actions(spark, folder)), model.users(spark, folder))


def _sample(spark: SparkSession, folder: str) -> DataFrame:
    """The sample, drawn once: written and read back."""
    path = new_work_dir(spark, "sample")
    ops.sample_sessions(_sessions(spark, folder), TOTAL, SEED).write.parquet(path)
    return spark.read.parquet(path)


@query("session_hour_key", _SAMPLE + "SELECT session_id, date, hour FROM keyed")
def session_hour_key(spark: SparkSession, folder: str) -> DataFrame:
    return ops.session_hour_key(_sessions(spark, folder)).select("session_id", "date", "hour")


@query("sessions_per_hour", _SAMPLE + "SELECT date, hour, session_count FROM per_hour")
def sessions_per_hour(spark: SparkSession, folder: str) -> DataFrame:
    return ops.sessions_per_hour(_sessions(spark, folder))


@query("sessions_per_day", _SAMPLE + "SELECT date, hour, session_count, day_count FROM per_day")
def sessions_per_day(spark: SparkSession, folder: str) -> DataFrame:
    return ops.sessions_per_day(ops.sessions_per_hour(_sessions(spark, folder)))


@query(
    "sample_quota", _SAMPLE + "SELECT date, hour, session_count, day_count, quota FROM quotas"
)
def sample_quota(spark: SparkSession, folder: str) -> DataFrame:
    return ops.sample_quota(ops.sessions_per_hour(_sessions(spark, folder)), TOTAL)


@query("random_extract_sessions", _SAMPLE + _EXTRACT)
def random_extract_sessions(spark: SparkSession, folder: str) -> DataFrame:
    return ops.random_extract_sessions(
        model.actions(spark, folder), _sample(spark, folder), TASK_ID
    )


@query("random_extract_detail", _SAMPLE + _DETAIL)
def random_extract_detail(spark: SparkSession, folder: str) -> DataFrame:
    return ops.extracted_session_detail(
        model.actions(spark, folder), _sample(spark, folder), TASK_ID
    )


@query("extracted_session_detail", _SAMPLE + _DETAIL)
def extracted_session_detail(spark: SparkSession, folder: str) -> DataFrame:
    """The detail join against a sample that is not written: one plan from the events on."""
    sample = ops.sample_sessions(_sessions(spark, folder), TOTAL, SEED)
    return ops.extracted_session_detail(model.actions(spark, folder), sample, TASK_ID)


@query(
    "session_detail",
    with_sql(EVENTS_SQL, ACTIONS_SQL)
    + _DETAIL.replace(" WHERE session_id IN (SELECT session_id FROM sample)", ""),
)
def session_detail(spark: SparkSession, folder: str) -> DataFrame:
    return ops.session_detail(model.actions(spark, folder), TASK_ID)


@query("sink_random_extract", _SAMPLE + _EXTRACT)
def sink_random_extract(spark: SparkSession, folder: str) -> DataFrame:
    path = new_work_dir(spark, "session_random_extract")
    append_table(random_extract_sessions(spark, folder), path)
    return spark.read.parquet(path)


@query("sink_session_detail", _SAMPLE + _DETAIL)
def sink_session_detail(spark: SparkSession, folder: str) -> DataFrame:
    path = new_work_dir(spark, "session_detail")
    append_table(random_extract_detail(spark, folder), path)
    return spark.read.parquet(path)

"""Scans, session roll-up, filters, statistics and their sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.operators import filters
from clickloom.operators.sampling import session_detail
from clickloom.operators.sessions import (
    session_aggregate,
    session_click_categories,
    session_keywords,
    session_metrics,
    session_start_time,
    with_user,
)
from clickloom.operators.stats import (
    merge_session_stats,
    session_stats_counts,
    session_stats_ratios,
)
from clickloom.plans.session_analysis import analysed_sessions, session_statistics
from clickloom.queries import model
from clickloom.queries.model import (
    ACTIONS_SQL,
    EVENTS_SQL,
    FULL_SQL,
    FULL_TASK,
    HOURLY_ACTIONS_SQL,
    TASK,
    TASKS_SQL,
    USERS_SQL,
    condition_sql,
    sessions_sql,
    task_sql,
    with_sql,
)
from clickloom.queries.registry import query
from clickloom.params import TaskParams
from clickloom.schemas import (
    STEP_LENGTH_BINS,
    VISIT_LENGTH_BINS,
)
from clickloom.session import new_work_dir
from clickloom.sinks import append_table
from clickloom.sources import parse_task_params, scan_actions, scan_products, scan_users

_BASE = with_sql(EVENTS_SQL, ACTIONS_SQL)
_SESSIONS = with_sql(EVENTS_SQL, ACTIONS_SQL, sessions_sql())
_FULL = with_sql(EVENTS_SQL, ACTIONS_SQL, USERS_SQL, sessions_sql(), FULL_SQL)
_HOURLY = with_sql(EVENTS_SQL, HOURLY_ACTIONS_SQL, sessions_sql())

_ACTION_COLUMNS = """session_id, user_id, page_id,
  strftime(action_time, '%Y-%m-%d %H:%M:%S') AS action_time, search_keyword,
  click_category_id, click_product_id, order_category_ids, order_product_ids,
  pay_category_ids, pay_product_ids"""

_SESSION_COLUMNS = """session_id, user_id, start_time, visit_length, step_length,
  search_keywords, click_category_ids"""


def counts_sql(source: str) -> str:
    """Session count and bins over ``source``."""
    parts = ["count(*) AS session_count"]
    for column, bins in (("visit_length", VISIT_LENGTH_BINS), ("step_length", STEP_LENGTH_BINS)):
        for name, low, high in bins:
            upper = "" if high is None else f" AND {column} <= {high}"
            parts.append(
                f"count(*) FILTER (WHERE {column} >= {low}{upper}) AS {column}_{name}"
            )
    return f"SELECT {', '.join(parts)} FROM {source}"


def ratios_sql(source: str, task_id: int) -> str:
    """Ratios half up to two decimals, from the counts in ``source``."""
    parts = []
    for column, bins in (("visit_length", VISIT_LENGTH_BINS), ("step_length", STEP_LENGTH_BINS)):
        for name, _, _ in bins:
            n = f"{column}_{name}"
            parts.append(
                f"CASE WHEN session_count > 0 THEN"
                f" ((200 * {n} + session_count) // (2 * session_count)) / 100.0 END"
                f" AS {n}_ratio"
            )
    return (
        f"SELECT CAST({task_id} AS BIGINT) AS task_id, session_count, {', '.join(parts)}"
        f" FROM ({source})"
    )


def _rows(actions: DataFrame) -> DataFrame:
    return session_detail(actions, 0).drop("task_id")


# ---- scans ----


@query(
    "scan_actions_by_date",
    _BASE
    + f"SELECT date, {_ACTION_COLUMNS} FROM user_visit_action"
    f" WHERE date >= '{TASK.start_date}' AND date <= '{TASK.end_date}'",
)
def scan_actions_by_date(spark: SparkSession, folder: str) -> DataFrame:
    rows = scan_actions(model.actions(spark, folder, params=TASK), TASK.start_date, TASK.end_date)
    return _rows(rows).withColumn("date", F.substring("action_time", 1, 10))


@query(
    "scan_users",
    with_sql(USERS_SQL) + "SELECT user_id, age, professional, city, sex FROM user_info",
)
def scan_users_query(spark: SparkSession, folder: str) -> DataFrame:
    return scan_users(model.users(spark, folder))


@query(
    "scan_products",
    "SELECT p_partkey AS product_id, p_name AS product_name,"
    " CAST(p_partkey % 2 AS INTEGER) AS product_status FROM part",
)
def scan_products_query(spark: SparkSession, folder: str) -> DataFrame:
    return scan_products(model.products(spark, folder))


_TASK_COLUMNS = ", ".join(
    f"json_extract_string(task_param, '$.{key}[0]') AS {name}"
    for key, name in (
        ("startDate", "start_date"),
        ("endDate", "end_date"),
        ("startAge", "start_age"),
        ("endAge", "end_age"),
        ("professionals", "professionals"),
        ("cities", "cities"),
        ("sex", "sex"),
        ("keywords", "keywords"),
        ("categoryIds", "category_ids"),
    )
)


@query("task_params", with_sql(TASKS_SQL) + f"SELECT task_id, {_TASK_COLUMNS} FROM task")
def task_params(spark: SparkSession, folder: str) -> DataFrame:
    return parse_task_params(model.tasks(spark, folder)).drop("malformed")


# ---- roll-up ----


@query("session_actions", _BASE + f"SELECT {_ACTION_COLUMNS} FROM user_visit_action")
def session_actions(spark: SparkSession, folder: str) -> DataFrame:
    return _rows(model.actions(spark, folder))


@query("session_aggregate", _SESSIONS + f"SELECT {_SESSION_COLUMNS} FROM sessions")
def session_aggregate_query(spark: SparkSession, folder: str) -> DataFrame:
    return session_start_time(session_aggregate(model.actions(spark, folder)))


@query(
    "session_metrics",
    _SESSIONS + "SELECT session_id, user_id, start_time, visit_length, step_length FROM sessions",
)
def session_metrics_query(spark: SparkSession, folder: str) -> DataFrame:
    return session_start_time(session_metrics(model.actions(spark, folder)))


@query("session_keywords", _SESSIONS + "SELECT session_id, search_keywords FROM sessions")
def session_keywords_query(spark: SparkSession, folder: str) -> DataFrame:
    return session_keywords(model.actions(spark, folder))


@query(
    "session_click_categories",
    _SESSIONS + "SELECT session_id, click_category_ids FROM sessions",
)
def session_click_categories_query(spark: SparkSession, folder: str) -> DataFrame:
    return session_click_categories(model.actions(spark, folder))


@query("session_visit_length", _HOURLY + "SELECT session_id, visit_length FROM sessions")
def session_visit_length(spark: SparkSession, folder: str) -> DataFrame:
    return session_metrics(model.actions(spark, folder, hourly=True)).select(
        "session_id", "visit_length"
    )


@query("session_step_length", _SESSIONS + "SELECT session_id, step_length FROM sessions")
def session_step_length(spark: SparkSession, folder: str) -> DataFrame:
    return session_metrics(model.actions(spark, folder)).select("session_id", "step_length")


def _full(spark: SparkSession, folder: str) -> DataFrame:
    return with_user(session_aggregate(model.actions(spark, folder)), model.users(spark, folder))


_FULL_COLUMNS = _SESSION_COLUMNS + ", age, professional, city, sex"


@query("session_with_user", _FULL + f"SELECT {_FULL_COLUMNS} FROM full_sessions")
def session_with_user(spark: SparkSession, folder: str) -> DataFrame:
    return session_start_time(_full(spark, folder))


# ---- filters, each over all sessions ----


def _filtered_sql(params: TaskParams) -> str:
    return _FULL + f"SELECT {_FULL_COLUMNS} FROM full_sessions WHERE {condition_sql(params)}"


@query("filter_age", _filtered_sql(TaskParams(start_age=10, end_age=40)))
def filter_age(spark: SparkSession, folder: str) -> DataFrame:
    return session_start_time(filters.filter_age(_full(spark, folder), 10, 40))


@query("filter_professional", _filtered_sql(TaskParams(professionals=TASK.professionals)))
def filter_professional(spark: SparkSession, folder: str) -> DataFrame:
    return session_start_time(
        filters.filter_professional(_full(spark, folder), TASK.professionals)
    )


@query("filter_city", _filtered_sql(TaskParams(cities=FULL_TASK.cities)))
def filter_city(spark: SparkSession, folder: str) -> DataFrame:
    return session_start_time(filters.filter_city(_full(spark, folder), FULL_TASK.cities))


@query("filter_sex", _filtered_sql(TaskParams(sex="female")))
def filter_sex(spark: SparkSession, folder: str) -> DataFrame:
    return session_start_time(filters.filter_sex(_full(spark, folder), "female"))


@query("filter_keywords", _filtered_sql(TaskParams(keywords=("kw1", "kw5"))))
def filter_keywords(spark: SparkSession, folder: str) -> DataFrame:
    return session_start_time(filters.filter_keywords(_full(spark, folder), ("kw1", "kw5")))


@query("filter_click_categories", _filtered_sql(TaskParams(category_ids=("1", "12", "58"))))
def filter_click_categories(spark: SparkSession, folder: str) -> DataFrame:
    return session_start_time(
        filters.filter_click_categories(_full(spark, folder), ("1", "12", "58"))
    )


@query(
    "filter_sessions",
    task_sql(FULL_TASK)
    + "SELECT session_id, user_id, start_time, visit_length, step_length,"
    " age, professional, city, sex FROM filtered",
)
def filter_sessions(spark: SparkSession, folder: str) -> DataFrame:
    sessions = analysed_sessions(
        model.actions(spark, folder, params=FULL_TASK), model.users(spark, folder), FULL_TASK
    )
    kept = filters.filter_sessions(sessions, FULL_TASK)
    return session_start_time(kept).drop("keyword_match", "category_match")


# ---- statistics ----


def _filtered(spark: SparkSession, folder: str, params: TaskParams) -> DataFrame:
    sessions = analysed_sessions(
        model.actions(spark, folder, params=params), model.users(spark, folder), params
    )
    return filters.filter_sessions(sessions, params)


@query("session_stats_counts", task_sql(TASK) + counts_sql("filtered"))
def session_stats_counts_query(spark: SparkSession, folder: str) -> DataFrame:
    return session_stats_counts(_filtered(spark, folder, TASK))


@query("session_stats_counts_hourly", _HOURLY + counts_sql("sessions"))
def session_stats_counts_hourly(spark: SparkSession, folder: str) -> DataFrame:
    """Sessions of one hour: fills the bins of short visits."""
    return session_stats_counts(session_metrics(model.actions(spark, folder, hourly=True)))


@query("session_stats_ratios", task_sql(TASK) + ratios_sql(counts_sql("filtered"), 1))
def session_stats_ratios_query(spark: SparkSession, folder: str) -> DataFrame:
    actions = model.actions(spark, folder, params=TASK)
    return session_statistics(actions, model.users(spark, folder), TASK)


@query(
    "session_stats_ratios_all_criteria",
    task_sql(FULL_TASK) + ratios_sql(counts_sql("filtered"), 2),
)
def session_stats_ratios_all_criteria(spark: SparkSession, folder: str) -> DataFrame:
    actions = model.actions(spark, folder, params=FULL_TASK)
    return session_statistics(actions, model.users(spark, folder), FULL_TASK)


@query("session_stats_ratios_hourly", _HOURLY + ratios_sql(counts_sql("sessions"), 3))
def session_stats_ratios_hourly(spark: SparkSession, folder: str) -> DataFrame:
    return session_stats_ratios(session_stats_counts_hourly(spark, folder), 3)


@query("merge_session_stats", _HOURLY + counts_sql("sessions"))
def merge_session_stats_query(spark: SparkSession, folder: str) -> DataFrame:
    """Statistics per start date, added up."""
    sessions = session_metrics(model.actions(spark, folder, hourly=True))
    dated = sessions.withColumn("date", F.to_date("start_ts"))
    return merge_session_stats(session_stats_counts(dated, "date"))


@query("sink_session_stats", task_sql(TASK) + ratios_sql(counts_sql("filtered"), 1))
def sink_session_stats(spark: SparkSession, folder: str) -> DataFrame:
    path = new_work_dir(spark, "session_aggr_stat")
    append_table(session_stats_ratios_query(spark, folder), path)
    return spark.read.parquet(path)

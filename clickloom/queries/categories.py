"""Category queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clickloom.operators import categories as ops
from clickloom.operators.filters import filter_sessions
from clickloom.operators.sampling import session_detail
from clickloom.plans.session_analysis import analysed_sessions, top_categories_of_task
from clickloom.queries import model
from clickloom.queries.model import ACTIONS_SQL, EVENTS_SQL, TASK, task_sql, with_sql
from clickloom.queries.registry import query
from clickloom.session import new_work_dir
from clickloom.sinks import append_table
from clickloom.sources import scan_actions


def touches_sql(name: str, source: str) -> str:
    return f"""
{name} AS (
  SELECT session_id, 'click' AS kind, click_category_id AS category_id
  FROM {source} WHERE click_category_id <> ''
  UNION ALL
  SELECT session_id, 'order', unnest(string_split(order_category_ids, ',')) FROM {source}
  WHERE order_category_ids IS NOT NULL
  UNION ALL
  SELECT session_id, 'pay', unnest(string_split(pay_category_ids, ',')) FROM {source}
  WHERE pay_category_ids IS NOT NULL
)"""


_BASE = with_sql(EVENTS_SQL, ACTIONS_SQL, touches_sql("touches", "user_visit_action"))

_SCANNED = f"""
scanned AS (SELECT * FROM user_visit_action
            WHERE date >= '{TASK.start_date}' AND date <= '{TASK.end_date}'),
own AS (SELECT * FROM scanned WHERE session_id IN (SELECT session_id FROM filtered))"""

_TASK = (
    task_sql(TASK).rstrip()
    + ","
    + _SCANNED
    + ","
    + touches_sql("all_touches", "scanned")
    + ","
    + touches_sql("own_touches", "own")
    + "\n"
)

_KINDS = ", ".join(
    f"count(*) FILTER (WHERE kind = '{kind}') AS {kind}_count" for kind in ("click", "order", "pay")
)


def _counts_sql(source: str) -> str:
    return (
        f"SELECT category_id, {_KINDS} FROM {source}"
        " WHERE category_id IN (SELECT category_id FROM own_touches) GROUP BY category_id"
    )


def _top_sql(source: str) -> str:
    return (
        "SELECT CAST(1 AS BIGINT) AS task_id, CAST(category_id AS BIGINT) AS category_id,"
        f" click_count, order_count, pay_count FROM ({_counts_sql(source)})"
        " ORDER BY click_count DESC, order_count DESC, pay_count DESC,"
        " CAST(category_id AS BIGINT) LIMIT 10"
    )


def _task(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    actions = model.actions(spark, folder, params=TASK)
    sessions = analysed_sessions(actions, model.users(spark, folder), TASK)
    return (
        scan_actions(actions, TASK.start_date, TASK.end_date),
        filter_sessions(sessions, TASK),
    )


@query(
    "actions_with_category",
    with_sql(EVENTS_SQL, ACTIONS_SQL)
    + "SELECT session_id, click_category_id, order_category_ids, pay_category_ids"
    " FROM user_visit_action WHERE click_category_id IS NOT NULL"
    " OR order_category_ids IS NOT NULL OR pay_category_ids IS NOT NULL",
)
def actions_with_category(spark: SparkSession, folder: str) -> DataFrame:
    return ops.actions_with_category(model.actions(spark, folder)).select(
        "session_id", "click_category_id", "order_category_ids", "pay_category_ids"
    )


@query("category_touches", _BASE + "SELECT session_id, kind, category_id FROM touches")
def category_touches(spark: SparkSession, folder: str) -> DataFrame:
    return ops.category_touches(model.actions(spark, folder), "session_id")


def _kind_sql(kind: str) -> str:
    return (
        f"SELECT category_id, count(*) AS {kind}_count FROM touches"
        f" WHERE kind = '{kind}' GROUP BY category_id"
    )


@query("click_count_by_category", _BASE + _kind_sql("click"))
def click_count_by_category(spark: SparkSession, folder: str) -> DataFrame:
    return ops.click_count_by_category(model.actions(spark, folder))


@query("order_count_by_category", _BASE + _kind_sql("order"))
def order_count_by_category(spark: SparkSession, folder: str) -> DataFrame:
    return ops.order_count_by_category(model.actions(spark, folder))


@query("pay_count_by_category", _BASE + _kind_sql("pay"))
def pay_count_by_category(spark: SparkSession, folder: str) -> DataFrame:
    return ops.pay_count_by_category(model.actions(spark, folder))


@query(
    "filtered_session_actions",
    _TASK
    + "SELECT user_id, session_id, page_id,"
    " strftime(action_time, '%Y-%m-%d %H:%M:%S') AS action_time, search_keyword,"
    " click_category_id, click_product_id, order_category_ids, order_product_ids,"
    " pay_category_ids, pay_product_ids FROM own",
)
def filtered_session_actions(spark: SparkSession, folder: str) -> DataFrame:
    actions, sessions = _task(spark, folder)
    return session_detail(ops.filtered_session_actions(actions, sessions), 0).drop("task_id")


@query("distinct_categories", _TASK + "SELECT DISTINCT category_id FROM own_touches")
def distinct_categories(spark: SparkSession, folder: str) -> DataFrame:
    return ops.distinct_categories(*_task(spark, folder))


@query("category_counts", _TASK + _counts_sql("all_touches"))
def category_counts(spark: SparkSession, folder: str) -> DataFrame:
    return ops.category_counts(*_task(spark, folder))


@query(
    "category_sort",
    _TASK
    + "SELECT CAST(category_id AS BIGINT) AS category_id, click_count, order_count, pay_count"
    f" FROM ({_counts_sql('all_touches')})"
    " ORDER BY click_count DESC, order_count DESC, pay_count DESC, CAST(category_id AS BIGINT)",
)
def category_sort(spark: SparkSession, folder: str) -> DataFrame:
    return ops.category_sort(category_counts(spark, folder))


@query("top10_categories", _TASK + _top_sql("all_touches"))
def top10_categories(spark: SparkSession, folder: str) -> DataFrame:
    actions = model.actions(spark, folder, params=TASK)
    return top_categories_of_task(actions, model.users(spark, folder), TASK)


@query("top10_categories_filtered", _TASK + _top_sql("own_touches"))
def top10_categories_filtered(spark: SparkSession, folder: str) -> DataFrame:
    actions = model.actions(spark, folder, params=TASK)
    users = model.users(spark, folder)
    return top_categories_of_task(actions, users, TASK, count_scope="filtered")


@query("sink_top10", _TASK + _top_sql("all_touches"))
def sink_top10(spark: SparkSession, folder: str) -> DataFrame:
    path = new_work_dir(spark, "top10_category")
    append_table(top10_categories(spark, folder), path)
    return spark.read.parquet(path)

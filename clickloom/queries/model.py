"""The model tables as views of the given ones, as DataFrames and as SQL.

``k`` is the number 0-99 in the JSON of an event. Views search, clicks click, signups
order, purchases pay. A session is one user's day; the finer form is one user's hour.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.functions import day_key
from clickloom.params import TaskParams


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    # days and hours are those of UTC
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{folder}/{name}.parquet")


def events(
    spark: SparkSession,
    folder: str,
    start: str | None = None,
    end: str | None = None,
    stored_time: bool = False,
) -> DataFrame:
    """The events with ``k``, optionally of the days from ``start`` to ``end``.

    With ``stored_time`` the time stays the stored column, so conditions on it reach the scan.
    """
    rows = table(spark, folder, "events")
    if start is not None:
        rows = rows.where(F.col("ts") >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        day_after = F.date_add(F.lit(end).cast("date"), 1)
        rows = rows.where(F.col("ts") < day_after.cast("timestamp_ntz"))
    return rows.select(
        "event_id",
        "ts" if stored_time else F.col("ts").cast("timestamp").alias("ts"),
        "user_id",
        "event_type",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
    )


def actions(
    spark: SparkSession,
    folder: str,
    hourly: bool = False,
    params: TaskParams | None = None,
) -> DataFrame:
    """``user_visit_action``.

    With ``params`` its dates are also put on the stored time: ``date`` is computed here,
    so that is what lets the scan skip row groups. A stored table partitioned by ``date``
    needs no such help.
    """
    dates = (params.start_date, params.end_date) if params else ()
    k = F.col("k")
    text = k.cast("string")
    product = (F.col("event_id") % 100).cast("string")

    def on(event_type: str, value):
        return F.when(F.col("event_type") == event_type, value)

    def pair(other):
        return F.concat(text, F.lit(","), other.cast("string"))

    session_part = F.date_format("ts", "yyyyMMddHH") if hourly else day_key(F.col("ts"))
    return events(spark, folder, *dates).select(
        F.date_format("ts", "yyyy-MM-dd").alias("date"),
        "user_id",
        F.concat_ws("_", F.col("user_id").cast("string"), session_part).alias("session_id"),
        (k % 10).cast("bigint").alias("page_id"),
        F.date_trunc("second", "ts").alias("action_time"),
        on("view", F.concat(F.lit("kw"), (k % 10).cast("string"))).alias("search_keyword"),
        on("click", text).alias("click_category_id"),
        on("click", product).alias("click_product_id"),
        on("signup", pair((k * 7 + 1) % 100)).alias("order_category_ids"),
        on("signup", product).alias("order_product_ids"),
        on("purchase", pair((k * 3 + 2) % 100)).alias("pay_category_ids"),
        on("purchase", product).alias("pay_product_ids"),
        (F.col("user_id") % 10).alias("city_id"),
    )


def users(spark: SparkSession, folder: str) -> DataFrame:
    """``user_info``."""
    customer = table(spark, folder, "customer")
    nation = table(spark, folder, "nation")
    return customer.join(nation, customer.c_nationkey == nation.n_nationkey).select(
        F.col("c_custkey").alias("user_id"),
        F.col("c_name").alias("username"),
        F.col("c_name").alias("name"),
        (F.col("c_custkey") % 60).cast("int").alias("age"),
        F.col("c_mktsegment").alias("professional"),
        F.col("n_name").alias("city"),
        F.when(F.col("c_custkey") % 2 == 0, "male").otherwise("female").alias("sex"),
    )


def products(spark: SparkSession, folder: str) -> DataFrame:
    """``product_info``."""
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.concat(
            F.lit('{"product_status": '), (F.col("p_partkey") % 2).cast("string"), F.lit("}")
        ).alias("extend_info"),
    )


def tasks(spark: SparkSession, folder: str) -> DataFrame:
    """``task``: one per customer, with parameters made from the customer's columns."""
    key = F.col("c_custkey")
    age = key % 60
    param = F.concat(
        F.lit('{"startDate":["2024-01-'),
        F.lpad((key % 9 + 1).cast("string"), 2, "0"),
        F.lit('"],"endDate":["2024-01-'),
        F.lpad((key % 9 + 20).cast("string"), 2, "0"),
        F.lit('"],"startAge":["'),
        age.cast("string"),
        F.lit('"],"endAge":['),
        F.when(key % 4 == 0, F.lit("")).otherwise(
            F.concat(F.lit('"'), (age + 10).cast("string"), F.lit('"'))
        ),
        F.lit('],"professionals":["'),
        F.col("c_mktsegment"),
        F.lit(',MACHINERY","ignored"],"cities":[]'),
        F.when(key % 3 == 0, F.lit(',"sex":["male"]')).otherwise(F.lit("")),
        F.lit(',"keywords":["kw'),
        (key % 10).cast("string"),
        F.lit('"]}'),
    )
    return table(spark, folder, "customer").select(
        key.alias("task_id"),
        F.col("c_name").alias("task_name"),
        F.lit(None).cast("string").alias("create_time"),
        F.lit(None).cast("string").alias("start_time"),
        F.lit(None).cast("string").alias("finish_time"),
        F.lit("session").alias("task_type"),
        F.lit("created").alias("task_status"),
        param.alias("task_param"),
    )


def clicks(
    spark: SparkSession,
    folder: str,
    start: str | None = None,
    end: str | None = None,
    stored_time: bool = False,
) -> DataFrame:
    """Ad clicks, optionally of the days from ``start`` to ``end``; see :func:`events`."""
    return (
        events(spark, folder, start, end, stored_time)
        .where(F.col("event_type") == "click")
        .select(
            "ts",
            (F.col("user_id") % 5).alias("province"),
            (F.col("user_id") % 25).alias("city"),
            "user_id",
            (F.col("k") % 10).cast("bigint").alias("ad_id"),
        )
    )


def log_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Ad click log lines (``value``) with the time they were made.

    Events that are errors give lines without a usable time: no number, one that no
    calendar has, or one in the year 2200.
    """
    broken = (
        F.when(F.col("event_id") % 3 == 0, "9223372036854775807")
        .when(F.col("event_id") % 3 == 1, "7258118400000")
        .otherwise(F.concat(F.lit("x"), F.col("event_id").cast("string")))
    )
    made = F.unix_millis("ts").cast("string")
    first = F.when(F.col("event_type") == "click", made).otherwise(broken)
    user = F.col("user_id")
    return (
        events(spark, folder)
        .where(F.col("event_type").isin("click", "error"))
        .select(
            "ts",
            F.concat_ws(
                " ",
                first,
                (user % 5).cast("string"),
                (user % 25).cast("string"),
                user.cast("string"),
                (F.col("k") % 10).cast("string"),
            ).alias("value")
        )
    )


# The task the queries below analyse.
TASK = TaskParams(
    task_id=1,
    start_date="2024-01-03",
    end_date="2024-01-27",
    start_age=10,
    end_age=40,
    professionals=("BUILDING", "MACHINERY"),
)

# A task that uses every criterion.
FULL_TASK = TaskParams(
    task_id=2,
    start_date="2024-01-02",
    end_date="2024-01-29",
    start_age=5,
    end_age=55,
    professionals=("BUILDING", "MACHINERY", "HOUSEHOLD"),
    cities=tuple(f"NATION_{i}" for i in range(0, 20)),
    sex="female",
    keywords=("kw1", "kw3", "kw5", "kw7", "kw9"),
    category_ids=tuple(str(i) for i in range(0, 60)),
)

EVENTS_SQL = """
ev AS (
  SELECT event_id, ts, user_id, event_type,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
  FROM events
)"""


def _actions_sql(session_format: str) -> str:
    return f"""
user_visit_action AS (
  SELECT strftime(ts, '%Y-%m-%d') AS date,
         user_id,
         user_id || '_' || strftime(ts, '{session_format}') AS session_id,
         CAST(k % 10 AS BIGINT) AS page_id,
         date_trunc('second', ts) AS action_time,
         CASE WHEN event_type = 'view' THEN 'kw' || (k % 10) END AS search_keyword,
         CASE WHEN event_type = 'click' THEN CAST(k AS VARCHAR) END AS click_category_id,
         CASE WHEN event_type = 'click' THEN CAST(event_id % 100 AS VARCHAR) END
           AS click_product_id,
         CASE WHEN event_type = 'signup' THEN k || ',' || ((k * 7 + 1) % 100) END
           AS order_category_ids,
         CASE WHEN event_type = 'signup' THEN CAST(event_id % 100 AS VARCHAR) END
           AS order_product_ids,
         CASE WHEN event_type = 'purchase' THEN k || ',' || ((k * 3 + 2) % 100) END
           AS pay_category_ids,
         CASE WHEN event_type = 'purchase' THEN CAST(event_id % 100 AS VARCHAR) END
           AS pay_product_ids,
         user_id % 10 AS city_id
  FROM ev
)"""


ACTIONS_SQL = _actions_sql("%Y%m%d")
HOURLY_ACTIONS_SQL = _actions_sql("%Y%m%d%H")

USERS_SQL = """
user_info AS (
  SELECT c_custkey AS user_id, c_name AS username, c_name AS name,
         CAST(c_custkey % 60 AS INTEGER) AS age, c_mktsegment AS professional,
         n_name AS city, CASE WHEN c_custkey % 2 = 0 THEN 'male' ELSE 'female' END AS sex
  FROM customer JOIN nation ON c_nationkey = n_nationkey
)"""

CLICKS_SQL = """
ad_click AS (
  SELECT ts, user_id % 5 AS province, user_id % 25 AS city, user_id,
         CAST(k % 10 AS BIGINT) AS ad_id
  FROM ev WHERE event_type = 'click'
)"""

LINES_SQL = """
ad_log AS (
  SELECT CASE WHEN event_type = 'click' THEN CAST(epoch_us(ts) // 1000 AS VARCHAR)
              WHEN event_id % 3 = 0 THEN '9223372036854775807'
              WHEN event_id % 3 = 1 THEN '7258118400000'
              ELSE 'x' || event_id END
         || ' ' || (user_id % 5) || ' ' || (user_id % 25) || ' ' || user_id
         || ' ' || (k % 10) AS value, ts, event_type
  FROM ev WHERE event_type IN ('click', 'error')
)"""

TASKS_SQL = """
task AS (
  SELECT c_custkey AS task_id,
         '{"startDate":["2024-01-' || lpad(CAST(c_custkey % 9 + 1 AS VARCHAR), 2, '0')
         || '"],"endDate":["2024-01-' || lpad(CAST(c_custkey % 9 + 20 AS VARCHAR), 2, '0')
         || '"],"startAge":["' || (c_custkey % 60) || '"],"endAge":['
         || CASE WHEN c_custkey % 4 = 0 THEN ''
                 ELSE '"' || (c_custkey % 60 + 10) || '"' END
         || '],"professionals":["' || c_mktsegment || ',MACHINERY","ignored"],"cities":[]'
         || CASE WHEN c_custkey % 3 = 0 THEN ',"sex":["male"]' ELSE '' END
         || ',"keywords":["kw' || (c_custkey % 10) || '"]}' AS task_param
  FROM customer
)"""


def sessions_sql(params: TaskParams | None = None, name: str = "sessions") -> str:
    """Sessions of ``user_visit_action``, of the dates of ``params`` when given."""
    dates = ""
    if params is not None:
        dates = f"WHERE date >= '{params.start_date}' AND date <= '{params.end_date}'"
    return f"""
{name} AS (
  SELECT session_id,
         min(user_id) AS user_id,
         min(action_time) AS start_ts,
         strftime(min(action_time), '%Y-%m-%d %H:%M:%S') AS start_time,
         date_diff('second', min(action_time), max(action_time)) AS visit_length,
         count(*) AS step_length,
         string_agg(DISTINCT search_keyword, ',' ORDER BY search_keyword)
           FILTER (WHERE search_keyword <> '') AS search_keywords,
         string_agg(DISTINCT click_category_id, ',' ORDER BY click_category_id)
           FILTER (WHERE click_category_id <> '') AS click_category_ids
  FROM user_visit_action {dates}
  GROUP BY session_id
)"""


FULL_SQL = """
full_sessions AS (
  SELECT s.*, u.age, u.professional, u.city, u.sex
  FROM sessions s JOIN user_info u ON s.user_id = u.user_id
)"""


def condition_sql(params: TaskParams) -> str:
    """The session filter of ``params``."""
    parts = []
    if params.start_age is not None and params.end_age is not None:
        parts.append(f"age BETWEEN {params.start_age} AND {params.end_age}")
    for column, wanted in (
        ("professional", params.professionals),
        ("city", params.cities),
        ("search_keywords", params.keywords),
        ("click_category_ids", params.category_ids),
    ):
        if wanted is not None:
            listed = ", ".join(f"'{w}'" for w in wanted)
            parts.append(f"list_has_any(string_split({column}, ','), [{listed}])")
    if params.sex is not None:
        parts.append(f"sex = '{params.sex}'")
    return " AND ".join(parts) or "true"


def filtered_sql(params: TaskParams) -> str:
    return f"""
filtered AS (SELECT * FROM full_sessions WHERE {condition_sql(params)})"""


def with_sql(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


def task_sql(params: TaskParams) -> str:
    """Everything up to the filtered sessions of a task."""
    return with_sql(
        EVENTS_SQL, ACTIONS_SQL, USERS_SQL, sessions_sql(params), FULL_SQL, filtered_sql(params)
    )

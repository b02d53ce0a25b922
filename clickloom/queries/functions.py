"""Scalar expressions, each projected over all events (or tasks)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom import functions as fn
from clickloom.queries import model
from clickloom.queries.model import EVENTS_SQL, TASKS_SQL, with_sql
from clickloom.queries.registry import query
from clickloom.sources import parse_task_params

_EV = with_sql(EVENTS_SQL)


def _events(spark: SparkSession, folder: str) -> DataFrame:
    return model.events(spark, folder)


def _k() -> Column:
    return F.col("k").cast("string")


@query(
    "fn_is_empty",
    _EV + "SELECT event_id, k % 3 <> 2 AS empty, k % 3 = 2 AS not_empty FROM ev",
)
def fn_is_empty(spark: SparkSession, folder: str) -> DataFrame:
    text = F.when(F.col("k") % 3 == 1, "").when(F.col("k") % 3 == 2, _k())
    return _events(spark, folder).select(
        "event_id", fn.is_empty(text).alias("empty"), fn.is_not_empty(text).alias("not_empty")
    )


@query(
    "fn_trim_comma",
    _EV
    + "SELECT event_id, regexp_replace(regexp_replace(t, '^,', ''), ',$', '') AS trimmed"
    " FROM (SELECT event_id, CASE k % 4 WHEN 0 THEN ',' || k || ',' WHEN 1 THEN k || ',,'"
    " WHEN 2 THEN ',,' || k ELSE k || ',' || k END AS t FROM ev)",
)
def fn_trim_comma(spark: SparkSession, folder: str) -> DataFrame:
    form = F.col("k") % 4
    comma = F.lit(",")
    text = (
        F.when(form == 0, F.concat(comma, _k(), comma))
        .when(form == 1, F.concat(_k(), F.lit(",,")))
        .when(form == 2, F.concat(F.lit(",,"), _k()))
        .otherwise(F.concat(_k(), comma, _k()))
    )
    return _events(spark, folder).select("event_id", fn.trim_comma(text).alias("trimmed"))


@query(
    "fn_pad_two",
    _EV
    + "SELECT event_id, CASE WHEN event_id % 1000 BETWEEN 10 AND 99"
    " THEN CAST(event_id % 1000 AS VARCHAR) ELSE '0' || (event_id % 1000) END AS padded FROM ev",
)
def fn_pad_two(spark: SparkSession, folder: str) -> DataFrame:
    text = (F.col("event_id") % 1000).cast("string")
    return _events(spark, folder).select("event_id", fn.pad_two(text).alias("padded"))


def _record() -> Column:
    keywords = F.when(F.col("k") % 3 == 0, "").otherwise(F.concat(F.lit("kw"), _k()))
    return F.concat(
        F.lit("sessionid="),
        F.col("user_id").cast("string"),
        F.lit("|searchKeywords="),
        keywords,
        F.lit("|clickCategoryIds="),
        _k(),
        F.lit(",7|broken=a=b|tail="),
        _k(),
        F.lit("="),
    )


@query(
    "fn_packed_get",
    _EV
    + "SELECT event_id, CAST(user_id AS VARCHAR) AS session,"
    " CASE WHEN k % 3 <> 0 THEN 'kw' || k END AS keywords, k || ',7' AS categories,"
    " CAST(NULL AS VARCHAR) AS broken, CAST(k AS VARCHAR) AS tail FROM ev",
)
def fn_packed_get(spark: SparkSession, folder: str) -> DataFrame:
    names = {
        "session": "sessionid",
        "keywords": "searchKeywords",
        "categories": "clickCategoryIds",
        "broken": "broken",
        "tail": "tail",
    }
    return _events(spark, folder).select(
        "event_id", *[fn.packed_get(_record(), field).alias(n) for n, field in names.items()]
    )


@query(
    "fn_packed_set",
    _EV
    + "SELECT event_id, 'sessionid=' || user_id || '|searchKeywords='"
    " || CASE WHEN k % 3 = 0 THEN '' ELSE 'kw' || k END"
    " || '|clickCategoryIds=new' || k || '|broken=a=b|tail=' || k || '=' AS record FROM ev",
)
def fn_packed_set(spark: SparkSession, folder: str) -> DataFrame:
    changed = fn.packed_set(_record(), "clickCategoryIds", F.concat(F.lit("new"), _k()))
    return _events(spark, folder).select("event_id", changed.alias("record"))


@query(
    "fn_split_list",
    _EV
    + "SELECT event_id, array_to_string(l, ';') AS elements, CAST(len(l) AS INTEGER) AS n"
    " FROM (SELECT event_id, list_filter(string_split(k || ',,' || (k + 1) || ',', ','),"
    " lambda x : x <> '') AS l FROM ev)",
)
def fn_split_list(spark: SparkSession, folder: str) -> DataFrame:
    next_k = (F.col("k") + 1).cast("string")
    elements = fn.split_list(F.concat(_k(), F.lit(",,"), next_k, F.lit(",")))
    return _events(spark, folder).select(
        "event_id", F.array_join(elements, ";").alias("elements"), F.size(elements).alias("n")
    )


def _time_text(at: Column) -> Column:
    """Time text with an unpadded hour; unreadable for every tenth k."""
    return F.when(F.col("k") % 10 == 0, "unknown").otherwise(
        F.date_format(at, "yyyy-MM-dd H:mm:ss")
    )


@query(
    "fn_parse_time",
    _EV
    + "SELECT event_id, CASE WHEN k % 10 <> 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END"
    " AS at FROM ev",
)
def fn_parse_time(spark: SparkSession, folder: str) -> DataFrame:
    parsed = fn.format_time(fn.parse_time(_time_text(F.col("ts"))))
    return _events(spark, folder).select("event_id", parsed.alias("at"))


@query("fn_format_date", _EV + "SELECT event_id, strftime(ts, '%Y-%m-%d') AS date FROM ev")
def fn_format_date(spark: SparkSession, folder: str) -> DataFrame:
    return _events(spark, folder).select("event_id", fn.format_date(F.col("ts")).alias("date"))


@query(
    "fn_day_key",
    _EV + "SELECT event_id, strftime(ts, '%Y%m%d') AS day_key,"
    " strftime(ts, '%Y-%m-%d') AS date FROM ev",
)
def fn_day_key(spark: SparkSession, folder: str) -> DataFrame:
    """Day key and the date read back from it."""
    key = fn.day_key(F.col("ts"))
    return _events(spark, folder).select(
        "event_id", key.alias("day_key"), fn.format_date(fn.parse_day_key(key)).alias("date")
    )


@query(
    "fn_minute_key", _EV + "SELECT event_id, strftime(ts, '%Y%m%d%H%M') AS minute_key FROM ev"
)
def fn_minute_key(spark: SparkSession, folder: str) -> DataFrame:
    return _events(spark, folder).select("event_id", fn.minute_key(F.col("ts")).alias("minute_key"))


@query(
    "fn_split_minute_key",
    _EV + "SELECT event_id, strftime(ts, '%Y-%m-%d') AS date, strftime(ts, '%H') AS hour,"
    " strftime(ts, '%M') AS minute FROM ev",
)
def fn_split_minute_key(spark: SparkSession, folder: str) -> DataFrame:
    date, hour, minute = fn.split_minute_key(fn.minute_key(F.col("ts")))
    return _events(spark, folder).select(
        "event_id", date.alias("date"), hour.alias("hour"), minute.alias("minute")
    )


@query(
    "fn_date_hour", _EV + "SELECT event_id, strftime(ts, '%Y-%m-%d_%H') AS date_hour FROM ev"
)
def fn_date_hour(spark: SparkSession, folder: str) -> DataFrame:
    return _events(spark, folder).select("event_id", fn.date_hour(F.col("ts")).alias("date_hour"))


def _other() -> Column:
    return F.timestamp_seconds(F.unix_seconds("ts") + F.col("k") - 50)


@query(
    "fn_before_after",
    _EV + "SELECT event_id, k % 10 <> 0 AND k > 50 AS before, k % 10 <> 0 AND k < 50 AS after"
    " FROM ev",
)
def fn_before_after(spark: SparkSession, folder: str) -> DataFrame:
    a, b = _time_text(F.col("ts")), _time_text(_other())
    return _events(spark, folder).select(
        "event_id", fn.is_before(a, b).alias("before"), fn.is_after(a, b).alias("after")
    )


@query(
    "fn_seconds_between",
    _EV + "SELECT event_id, CAST(CASE WHEN k % 10 = 0 THEN 0 ELSE 50 - k END AS BIGINT)"
    " AS seconds FROM ev",
)
def fn_seconds_between(spark: SparkSession, folder: str) -> DataFrame:
    seconds = fn.seconds_between(_time_text(F.col("ts")), _time_text(_other()))
    return _events(spark, folder).select("event_id", seconds.alias("seconds"))


@query(
    "fn_today_yesterday",
    _EV + "SELECT event_id, strftime(ts, '%Y-%m-%d') < strftime(current_date, '%Y-%m-%d')"
    " AS before_today, strftime(ts, '%Y-%m-%d') <"
    " strftime(current_date - INTERVAL 1 DAY, '%Y-%m-%d') AS before_yesterday FROM ev",
)
def fn_today_yesterday(spark: SparkSession, folder: str) -> DataFrame:
    date = fn.format_date(F.col("ts"))
    return _events(spark, folder).select(
        "event_id",
        (date < fn.today()).alias("before_today"),
        (date < fn.yesterday()).alias("before_yesterday"),
    )


@query(
    "fn_ratio_half_up",
    _EV + "SELECT event_id, ((200 * k + 200) // 400) / 100.0 AS ratio FROM ev",
)
def fn_ratio_half_up(spark: SparkSession, folder: str) -> DataFrame:
    ratio = fn.ratio_half_up(F.col("k"), F.lit(200).cast("bigint"))
    return _events(spark, folder).select("event_id", ratio.alias("ratio"))


@query(
    "fn_round_half_up",
    "SELECT event_id,"
    " CAST(round(CAST(printf('%.30f', value) AS DECIMAL(38, 30)), 1) AS DOUBLE) AS tenths,"
    " CAST(round(CAST(printf('%.30f', (event_id % 1000) / 200.0) AS DECIMAL(38, 30)), 2)"
    " AS DOUBLE) AS hundredths FROM events",
)
def fn_round_half_up(spark: SparkSession, folder: str) -> DataFrame:
    halves = (F.col("event_id") % 1000) / F.lit(200.0)
    return model.table(spark, folder, "events").select(
        "event_id",
        fn.round_half_up(F.col("value"), 1).alias("tenths"),
        fn.round_half_up(halves, 2).alias("hundredths"),
    )


@query(
    "fn_json_first",
    with_sql(TASKS_SQL)
    + "SELECT task_id, CASE WHEN task_id % 4 <> 0 THEN CAST(task_id % 60 + 10 AS VARCHAR) END"
    " AS end_age, CAST(NULL AS VARCHAR) AS cities,"
    " CASE WHEN task_id % 3 = 0 THEN 'male' END AS sex FROM task",
)
def fn_json_first(spark: SparkSession, folder: str) -> DataFrame:
    """First element of an array that may be empty, is empty, or may be missing."""
    return parse_task_params(model.tasks(spark, folder)).select(
        "task_id", "end_age", "cities", "sex"
    )

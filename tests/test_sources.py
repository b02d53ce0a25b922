from __future__ import annotations

from clickloom.schemas import PRODUCT_INFO
from clickloom.sources import (
    format_ad_log,
    jdbc_options,
    parse_ad_log,
    register_views,
    rejected_lines,
    scan_actions,
    scan_products,
    scan_users,
    valid_clicks,
)
from clickloom.sources.adlog import kafka_options


def test_date_bounds(action_rows):
    days = [f"2024-01-0{d}" for d in range(1, 6)]
    actions = action_rows(*[{"session_id": d, "action_time": d + " 1:00:00"} for d in days])

    def scanned(start, end):
        return sorted(r.date[-1] for r in scan_actions(actions, start, end).collect())

    assert scanned("2024-01-02", "2024-01-04") == ["2", "3", "4"]
    assert scanned("2024-01-04", None) == ["4", "5"]
    assert scanned(None, "2024-01-01") == ["1"]
    assert len(scanned(None, None)) == 5


def test_products(spark):
    rows = [
        (1, "a", '{"product_status": 1}'),
        (2, "b", '{"product_status": 0}'),
        (3, "c", "{}"),
        (4, "d", None),
        (5, "e", '{"product_status": "x"}'),
    ]
    products = scan_products(spark.createDataFrame(rows, PRODUCT_INFO))
    assert [r.product_status for r in products.orderBy("product_id").collect()] == [
        1,
        0,
        None,
        None,
        None,
    ]


def test_views(spark, action_rows, one_user):
    actions = action_rows({"session_id": "s", "action_time": "2024-01-01 1:00:00"})
    products = spark.createDataFrame([(1, "a", "{}")], PRODUCT_INFO)
    register_views(actions, one_user, products)
    joined = spark.sql(
        "SELECT session_id, age FROM user_visit_action JOIN user_info USING (user_id)"
    )
    assert [tuple(r) for r in joined.collect()] == [("s", 30)]
    assert spark.table("product_info").count() == 1
    assert scan_users(one_user).columns == ["user_id", "age", "professional", "city", "sex"]


def test_log_lines(spark):
    good = ["1521763200123 1 1.1 523 7", "1521763200123 1 1.1 523 8 more"]
    bad = ["x 1 1 2 3", "1521763200123 1 1 2", "1521763200123 1 1 y 3", "", "1  2 3"]
    lines = spark.createDataFrame([(v,) for v in [*good, *bad, None]], "value string")
    parsed = parse_ad_log(lines)
    clicks = valid_clicks(parsed).selectExpr(
        "date_format(ts, 'yyyy-MM-dd HH:mm') AS at", "province", "city", "user_id", "ad_id"
    )
    assert sorted(tuple(r) for r in clicks.collect()) == [
        ("2018-03-23 00:00", "1", "1.1", 523, 7),
        ("2018-03-23 00:00", "1", "1.1", 523, 8),
    ]
    rejected = [r.line for r in rejected_lines(parsed).collect()]
    assert sorted(v or "" for v in rejected) == sorted(["", *bad])
    assert rejected.count(None) == 1


def test_log_round_trip(spark):
    lines = spark.createDataFrame([("1521763200123 1 1.1 523 7",)], "value string")
    back = format_ad_log(valid_clicks(parse_ad_log(lines)))
    assert [r.value for r in back.collect()] == ["1521763200123 1 1.1 523 7"]


def test_connection_options():
    assert kafka_options("a:1,b:1", ["x", "y"], startingOffsets="earliest") == {
        "kafka.bootstrap.servers": "a:1,b:1",
        "subscribe": "x,y",
        "startingOffsets": "earliest",
    }
    assert kafka_options("a:1", "x,y")["subscribe"] == "x,y"
    assert jdbc_options("jdbc:mysql://h/d", "task", user="u") == {
        "url": "jdbc:mysql://h/d",
        "dbtable": "task",
        "user": "u",
    }

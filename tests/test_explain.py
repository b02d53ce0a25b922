"""What the plans have to look like."""

from __future__ import annotations

import contextlib

import pytest

from clickloom.operators.adclicks import (
    ad_trend_last_hour,
    ad_trend_sliding,
    replayed_daily_clicks,
    without_blacklisted,
)
from clickloom.operators.categories import (
    category_counts,
    filtered_session_actions,
    session_category_counts,
)
from clickloom.operators.filters import filter_sessions
from clickloom.operators.sampling import sample_quota, sample_sessions, sessions_per_hour
from clickloom.operators.sessions import session_metrics, with_user
from clickloom.params import TaskParams
from clickloom.plans import session_statistics, top_categories_of_task
from clickloom.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def _plan(frame) -> str:
    """The physical plan as run."""
    frame.collect()
    text = frame._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


@contextlib.contextmanager
def _settings(spark, settings):
    old = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in old.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Actions partitioned by date, users and clicks as Parquet; user 1 has a third of all."""
    root = tmp_path_factory.mktemp("tables")
    n = 60_000
    user = "CASE WHEN id % 3 = 0 THEN 1L ELSE id % 5000 + 2 END"
    spark.range(n).selectExpr(
        "date_format(timestamp_seconds(1704067200 + id * 14 % 864000), 'yyyy-MM-dd') AS date",
        f"{user} AS user_id",
        f"concat({user}, '_', id % 20000) AS session_id",
        "id % 10 AS page_id",
        "timestamp_seconds(1704067200 + id * 14 % 864000) AS action_time",
        "CASE WHEN id % 4 = 0 THEN concat('w', id % 9) END AS search_keyword",
        "CASE WHEN id % 4 = 1 THEN cast(id % 50 AS string) END AS click_category_id",
        "CASE WHEN id % 4 = 1 THEN cast(id % 70 AS string) END AS click_product_id",
        "CASE WHEN id % 4 = 2 THEN concat(id % 50, ',', id % 31) END AS order_category_ids",
        "cast(NULL AS string) AS order_product_ids",
        "CASE WHEN id % 4 = 3 THEN cast(id % 50 AS string) END AS pay_category_ids",
        "cast(NULL AS string) AS pay_product_ids",
        "id % 7 AS city_id",
    ).repartition(4).write.partitionBy("date").parquet(f"{root}/actions")
    spark.range(5002).selectExpr(
        "id AS user_id",
        "concat('u', id) AS username",
        "concat('n', id) AS name",
        "cast(id % 60 AS int) AS age",
        "concat('p', id % 5) AS professional",
        "concat('c', id % 9) AS city",
        "CASE WHEN id % 2 = 0 THEN 'male' ELSE 'female' END AS sex",
    ).write.parquet(f"{root}/users")
    spark.range(n).selectExpr(
        "timestamp_seconds(1704067200 + id) AS ts",
        f"{user} AS user_id",
        "id % 10 AS ad_id",
    ).repartitionByRange(8, "ts").write.parquet(f"{root}/clicks")
    return {name: spark.read.parquet(f"{root}/{name}") for name in ("actions", "users", "clicks")}


PARAMS = TaskParams(
    task_id=1,
    start_date="2024-01-02",
    end_date="2024-01-04",
    start_age=1,
    end_age=40,
    keywords=("w1",),
)


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith(("stream", "sink"))])
def test_no_python_in_any_plan(spark, name):
    plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    for word in ("Python", "Pandas", "CartesianProduct", "NestedLoopJoin", "ExistingRDD"):
        assert word not in plan


def test_dates_prune_partitions_and_columns(stored):
    plan = _plan(session_statistics(stored["actions"], stored["users"], PARAMS))
    scan = next(line for line in plan.splitlines() if "FileScan" in line and "session_id" in line)
    assert "PartitionFilters: [isnotnull(date" in scan and ">= 2024-01-02" in scan
    assert "ReadSchema: struct<user_id:bigint,session_id:string,action_time:timestamp," \
        "search_keyword:string>" in scan


def test_user_filters_reach_the_user_scan(stored):
    plan = _plan(session_statistics(stored["actions"], stored["users"], PARAMS))
    scan = next(line for line in plan.splitlines() if "FileScan" in line and "age" in line)
    assert "age" in scan.split("DataFilters:")[1].split("Format:")[0]
    assert "ReadSchema: struct<user_id:bigint,age:int>" in scan


def test_roll_up_is_a_partial_hash_aggregate(stored):
    plan = _plan(session_metrics(stored["actions"], ["w1"], ["2"]))
    assert plan.count("HashAggregate") == 2 and "ObjectHashAggregate" not in plan
    assert "SortAggregate" not in plan and "partial_count" in plan


def test_top_list_takes_without_sorting_all(stored):
    plan = _plan(top_categories_of_task(stored["actions"], stored["users"], PARAMS))
    assert "TakeOrderedAndProject" in plan
    # one scan for the roll-up, one for the counts
    assert sum("FileScan" in line and "date=" in line or "session_id" in line and "FileScan" in line
               for line in plan.splitlines()) == 2


def test_sample_is_cut_before_the_shuffle(stored):
    plan = _plan(sample_sessions(session_metrics(stored["actions"]), 1000))
    assert "Window" not in plan
    # the quota is joined, and what is beyond it dropped, below the shuffle of the sample
    join = next(line for line in plan.splitlines() if "Join [_hour" in line)
    assert "_range" in join and "<=" in join
    assert plan.index("collect_list(struct(_key") < plan.index(join)


@pytest.mark.parametrize("name", ["random_extract_sessions", "random_extract_detail"])
def test_registered_samples_are_drawn_once_and_joined_without_a_shuffle(spark, name):
    plan = _plan(QUERIES[name](spark, FOLDER))
    assert "LeftSemi" in plan and "BroadcastHashJoin" in plan
    # the events are read for the actions only, the sample is a table of its own
    assert plan.count("events.parquet") == 1 and "row_number" not in plan


def test_day_count_shares_the_hour_exchange(stored):
    plan = _plan(sample_quota(sessions_per_hour(session_metrics(stored["actions"]))))
    assert "ReusedExchange" in plan


def test_replay_scans_once(spark, stored):
    with _settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        plan = _plan(replayed_daily_clicks(stored["clicks"], 3))
    assert plan.count("FileScan") == 1 and "ReusedExchange" in plan


def _formatted(frame) -> str:
    frame.collect()
    modes = frame.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode
    return frame._jdf.queryExecution().explainString(modes.fromString("formatted"))


def test_trend_boundary_is_pushed_down(spark, stored):
    text = _formatted(ad_trend_last_hour(stored["clicks"]))
    assert "GreaterThanOrEqual(ts,ScalarSubquery" in text
    text = _formatted(QUERIES["ad_trend_last_hour"](spark, FOLDER))
    assert "GreaterThanOrEqual(ts,ScalarSubquery" in text


def test_sliding_windows_shuffle_once(stored):
    plan = _plan(ad_trend_sliding(stored["clicks"], 60, 60))
    assert plan.count("Exchange hashpartitioning") == 1
    # positions are made after the exchange: above it in the plan text
    assert plan.index("Generate explode") < plan.index("Exchange hashpartitioning")


HOT = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.files.maxPartitionBytes": "100k",
    "spark.sql.files.openCostInBytes": "1k",
    "spark.sql.shuffle.partitions": "16",
}


def test_hot_user_is_split_in_the_user_join(spark, stored):
    sessions = session_metrics(stored["actions"])
    expected = with_user(sessions, stored["users"]).count()
    with _settings(spark, HOT):
        joined = with_user(sessions, stored["users"])
        rows = joined.collect()
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    assert len(rows) == expected


def test_hot_user_is_split_in_the_blacklist_join(spark, stored):
    # a list that is already partitioned by user
    listed = spark.range(100, 9000).selectExpr("id % 4000 AS user_id").distinct()
    expected = without_blacklisted(stored["clicks"], listed, salts=3).count()
    with _settings(spark, HOT):
        kept = without_blacklisted(stored["clicks"], listed)
        rows = kept.collect()
        assert "skew=true" in kept._jdf.queryExecution().executedPlan().toString()
    assert len(rows) == expected
    assert rows[0].asDict().keys() == {"ts", "user_id", "ad_id"}


@pytest.fixture
def hot_session(stored):
    """Actions of which a third are one session's."""
    return stored["actions"].selectExpr(
        "* except (session_id)",
        "CASE WHEN user_id = 1 THEN 'hot' ELSE session_id END AS session_id",
    )


def _filtered(actions, users):
    params = TaskParams(task_id=1, start_age=1, end_age=30)
    return filter_sessions(with_user(session_metrics(actions), users), params)


def test_hot_session_is_split_in_the_action_join(spark, stored, hot_session):
    expected = hot_session.join(
        _filtered(hot_session, stored["users"]).select("session_id"), "session_id", "left_semi"
    ).count()
    with _settings(spark, HOT):
        # users by broadcast: the sessions stay partitioned by session
        sessions = _filtered(hot_session, stored["users"].hint("broadcast"))
        kept = filtered_session_actions(hot_session, sessions)
        rows = kept.collect()
        assert "skew=true" in kept._jdf.queryExecution().executedPlan().toString()
    assert len(rows) == expected
    assert sum(r.session_id == "hot" for r in rows) == 20_000


def test_hot_session_is_counted_before_the_category_join(spark, stored, hot_session):
    expected = sorted(
        map(tuple, category_counts(hot_session, _filtered(hot_session, stored["users"])).collect())
    )
    with _settings(spark, HOT):
        frame = category_counts(hot_session, _filtered(hot_session, stored["users"]))
        assert sorted(map(tuple, frame.collect())) == expected
        plan = frame._jdf.queryExecution().executedPlan().toString()
    below_join = plan[plan.index("LeftOuter") :]
    assert "partial_count" in below_join
    assert "Exchange hashpartitioning(session_id" in below_join
    per_session = session_category_counts(hot_session).where("session_id = 'hot'")
    assert per_session.count() == 50

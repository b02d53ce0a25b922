"""Actions stored by session: same rows, no exchange of actions, hot sessions apart."""

from __future__ import annotations

import pytest

from clickloom.operators.categories import filtered_session_actions
from clickloom.operators.sessions import session_aggregate, session_metrics
from clickloom.sinks import store_by_session, stored_actions


@pytest.fixture(scope="module")
def actions(spark, tmp_path_factory):
    """Session ``s0`` has a third of all rows, as many have no session, the rest are small."""
    place = f"{tmp_path_factory.mktemp('actions')}/t"
    spark.range(3000).selectExpr(
        "concat('2024-01-0', id % 5 + 1) AS date",
        "id % 40 AS user_id",
        "CASE id % 3 WHEN 0 THEN 's0' WHEN 1 THEN concat('s', id % 200 + 1) END AS session_id",
        "id % 10 AS page_id",
        "timestamp_seconds(1704067200 + id % 5 * 86400 + id) AS action_time",
        "CASE WHEN id % 4 = 0 THEN concat('w', id % 9) END AS search_keyword",
        "CASE WHEN id % 4 = 1 THEN cast(id % 50 AS string) END AS click_category_id",
    ).write.parquet(place)
    return spark.read.parquet(place)


@pytest.fixture(scope="module")
def stored(spark, actions, tmp_path_factory):
    place = str(tmp_path_factory.mktemp("stored"))
    return store_by_session(actions, "layout_test", place, buckets=4, most=100)


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def _plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def test_every_action_once_and_hot_ones_apart(actions, stored):
    names = actions.columns
    both = stored.regular.select(names).unionByName(stored.hot.select(names))
    assert _rows(both) == _rows(actions)
    assert {r.session_id for r in stored.hot.collect()} == {"s0", None}
    assert stored.regular.where("session_id = 's0' OR session_id IS NULL").count() == 0


def test_one_file_for_each_bucket_and_date(stored):
    assert len(stored.regular.inputFiles()) <= 4 * 5


@pytest.mark.parametrize("operator", [session_metrics, session_aggregate])
def test_roll_up_without_exchange(actions, stored, operator):
    assert _rows(stored.per_session(operator)) == _rows(operator(actions))
    assert "Exchange" in _plan(operator(actions))
    assert "Exchange" not in _plan(operator(stored.regular))


def test_actions_of_sessions_without_exchange_of_actions(actions, stored, no_broadcast):
    wanted = session_metrics(actions).where("step_length < 7 OR session_id = 's0'")
    names = actions.columns
    got = stored.of_sessions(wanted).select(names)
    assert _rows(got) == _rows(filtered_session_actions(actions, wanted).select(names))
    # the roll-up is by bucket itself, so neither side is exchanged
    rolled_up = session_metrics(stored.regular).where("step_length < 7")
    joined = stored.regular.join(rolled_up.select("session_id"), "session_id", "left_semi")
    assert "SortMergeJoin" in _plan(joined) and "Exchange" not in _plan(joined)
    # any other list of ids is exchanged to the buckets, the actions are not
    ids = wanted.sparkSession.createDataFrame([("s4",), ("s7",)], "session_id string")
    joined = stored.regular.join(ids, "session_id", "left_semi")
    assert _plan(joined).count("Exchange") == 1


def test_dates_are_pruned_in_both(actions, stored):
    days = stored.scan("2024-01-02", "2024-01-03")
    names = actions.columns
    want = actions.where("date >= '2024-01-02' AND date <= '2024-01-03'")
    got = days.regular.select(names).unionByName(days.hot.select(names))
    assert _rows(got) == _rows(want)
    for part in (days.regular, days.hot):
        assert "2024-01-02" in _plan(part).split("PartitionFilters", 1)[1].split("]")[0]


def test_stored_again_and_empty(spark, actions, stored, tmp_path):
    again = stored_actions(spark, "layout_test")
    assert again.regular.count() == stored.regular.count()
    none = store_by_session(actions.limit(0), "layout_none", str(tmp_path / "a"), buckets=2)
    assert none.per_session(session_metrics).count() == 0
    few = store_by_session(actions.limit(5), "layout_none", str(tmp_path / "a"), buckets=2)
    assert few.regular.count() + few.hot.count() == 5

from __future__ import annotations

import dataclasses
import random
from pathlib import Path

import pytest

from clickloom.operators.filters import filter_sessions
from clickloom.params import TaskParams
from clickloom.__main__ import main
from clickloom.plans import (
    AdMonitor,
    analysed_sessions,
    run_session_analysis,
    session_statistics,
    top_categories_of_task,
)
from clickloom.schemas import TASK, VISIT_COLUMNS
from clickloom.sinks import parquet_results


@pytest.fixture
def actions(action_rows):
    draw = random.Random(1)
    rows = []
    for number in range(600):
        session = draw.randrange(80)
        kind = draw.choice(["search", "click", "order", "pay"])
        rows.append(
            {
                "session_id": f"s{session}",
                "user_id": session % 12,
                "action_time": f"2024-01-0{session % 4 + 1} {session % 3 + 8}:00:{number % 60:02d}",
                "search_keyword": f"w{draw.randrange(5)}" if kind == "search" else None,
                "click_category_id": str(draw.randrange(20)) if kind == "click" else None,
                "order_category_ids": f"{draw.randrange(20)},{draw.randrange(20)}"
                if kind == "order"
                else None,
                "pay_category_ids": str(draw.randrange(20)) if kind == "pay" else None,
            }
        )
    return action_rows(*rows)


@pytest.fixture
def users(user_rows):
    # user 11 is not known
    return user_rows(
        *[(u, 20 + u, "IT,Law" if u % 2 else "Art", "Rome", "male") for u in range(11)]
    )


PARAMS = TaskParams(
    task_id=4,
    start_date="2024-01-01",
    end_date="2024-01-03",
    start_age=22,
    end_age=30,
    professionals=("Law",),
    keywords=("w1", "w2"),
)


def _rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def test_whole_task(spark, tmp_path, actions, users):
    out = str(tmp_path / "out")
    run_session_analysis(
        actions, users, PARAMS, parquet_results(out), sample_total=30, seed=2
    )
    stats = spark.read.parquet(f"{out}/session_aggr_stat")
    want = session_statistics(actions, users, PARAMS)
    assert _rows(stats.select(want.columns)) == _rows(want)
    top = spark.read.parquet(f"{out}/top10_category")
    want = top_categories_of_task(actions, users, PARAMS)
    assert _rows(top.select(want.columns)) == _rows(want)
    assert top.count() == 10
    sample = spark.read.parquet(f"{out}/session_random_extract")
    detail = spark.read.parquet(f"{out}/session_detail")
    drawn = {r.session_id for r in sample.collect()}
    assert 20 < len(drawn) <= 30
    assert {r.session_id for r in detail.collect()} == drawn
    assert {r.task_id for r in sample.collect()} == {4}
    # the sample comes from all sessions of known users within the dates, not from the filtered
    sessions = {r.session_id for r in analysed_sessions(actions, users, PARAMS).collect()}
    assert drawn <= sessions and not any(int(s[1:]) % 12 == 11 for s in sessions)
    in_range = actions.where("date <= '2024-01-03'")
    expected = [r for r in in_range.collect() if r.session_id in drawn]
    assert detail.count() == len(expected)


RESULTS = ("session_aggr_stat", "session_random_extract", "session_detail", "top10_category")


def test_a_task_that_runs_again_replaces_its_results(spark, tmp_path, actions, users):
    out, root = str(tmp_path / "out"), Path(spark.conf.get("spark.checkpoint.dir"))
    write = parquet_results(out)

    def failing(rows, table, task_id):
        if table == "session_detail":
            raise OSError("full")
        write(rows, table, task_id)

    with pytest.raises(OSError):
        run_session_analysis(actions, users, PARAMS, failing, sample_total=30)
    seen = []
    for _ in range(2):
        run_session_analysis(actions, users, PARAMS, write, sample_total=30)
        seen.append({name: _rows(spark.read.parquet(f"{out}/{name}")) for name in RESULTS})
    assert seen[0] == seen[1] and all(seen[0].values())
    assert not list(root.glob("session-analysis-*"))
    other = dataclasses.replace(PARAMS, task_id=5)
    run_session_analysis(actions, users, other, write, sample_total=30)
    tasks = spark.read.parquet(f"{out}/session_aggr_stat")
    assert sorted(r.task_id for r in tasks.collect()) == [4, 5]


def _stats_written(actions, users, params):
    seen = []

    def write(rows, table, task_id):
        if table == "session_aggr_stat":
            seen.append((_rows(rows), rows._jdf.queryExecution().executedPlan().toString()))

    run_session_analysis(actions, users, params, write, sample_total=30)
    return seen[0]


@pytest.mark.parametrize("criteria", [{}, {"sex": "nobody"}, {"start_age": None, "keywords": None}])
def test_the_statistic_is_counted_by_the_write_of_the_roll_up(actions, users, criteria):
    params = dataclasses.replace(PARAMS, **criteria)
    rows, plan = _stats_written(actions, users, params)
    assert rows == _rows(session_statistics(actions, users, params))
    assert "FileScan" not in plan and "HashAggregate" not in plan


def test_the_statistic_of_nothing(actions, users):
    rows, _ = _stats_written(actions.limit(0), users, PARAMS)
    assert rows == _rows(session_statistics(actions.limit(0), users, PARAMS))


def test_statistics_by_hand(actions, users):
    """The same numbers from plain Python over the rows."""
    sessions: dict = {}
    for r in actions.where("date <= '2024-01-03'").collect():
        sessions.setdefault(r.session_id, []).append(r)
    ages = {u: 20 + u for u in range(11)}
    kept = [
        rows
        for rows in sessions.values()
        if 22 <= ages.get(rows[0].user_id, 0) <= 30
        and rows[0].user_id % 2
        and {r.search_keyword for r in rows} & {"w1", "w2"}
    ]
    row = session_statistics(actions, users, PARAMS).first()
    assert row.session_count == len(kept) > 3
    seconds = [
        [int(r.action_time[-2:]) for r in rows] for rows in kept
    ]
    long_visits = sum(31 <= max(s) - min(s) <= 60 for s in seconds)
    assert row[f"{VISIT_COLUMNS[4]}_ratio"] == pytest.approx(long_visits / len(kept), abs=0.00501)


def test_no_match(actions, users):
    params = TaskParams(task_id=1, sex="none")
    row = session_statistics(actions, users, params).first()
    assert (row.session_count, row.visit_length_30m_ratio) == (0, None)
    assert top_categories_of_task(actions, users, params).count() == 0
    assert filter_sessions(analysed_sessions(actions, users, params), params).count() == 0


def test_command_line(spark, tmp_path, actions, users):
    tables = {}
    for name, rows in (("actions", actions), ("users", users)):
        tables[name] = f"{tmp_path}/{name}"
        rows.write.parquet(tables[name])
    spark.createDataFrame(
        [(4, "t", None, None, None, "session", "new", '{"startAge":["22"],"endAge":["30"]}')], TASK
    ).write.parquet(f"{tmp_path}/tasks")
    main(
        [
            "session",
            "--task-id=4",
            f"--tasks={tmp_path}/tasks",
            f"--actions={tables['actions']}",
            f"--users={tables['users']}",
            f"--output={tmp_path}/out",
        ],
        spark,
    )
    stats = spark.read.parquet(f"{tmp_path}/out/session_aggr_stat")
    expected = session_statistics(actions, users, TaskParams(4, start_age=22, end_age=30))
    assert stats.select(expected.columns).collect() == expected.collect()


def test_command_line_monitor(spark, tmp_path):
    rows = [(f"1704067200000 p c {u} 1",) for u in (1, 1, 2)]
    lines = spark.createDataFrame(rows, "value string")
    lines.write.text(f"{tmp_path}/lines")
    main(
        [
            "monitor",
            f"--lines={tmp_path}/lines",
            f"--root={tmp_path}/monitor",
            "--threshold=2",
            "--available-now",
        ],
        spark,
    )
    assert [r.user_id for r in AdMonitor(spark, f"{tmp_path}/monitor").blacklist().collect()] == [1]

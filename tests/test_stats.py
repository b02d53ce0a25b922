from __future__ import annotations

from clickloom.operators.sessions import session_metrics
from clickloom.operators.stats import (
    merge_session_stats,
    session_stats_counts,
    session_stats_ratios,
)
from clickloom.schemas import STAT_COLUMNS, STEP_COLUMNS, VISIT_COLUMNS

VISITS = (0, 1, 3, 4, 6, 7, 9, 10, 30, 31, 60, 61, 180, 181, 600, 601, 1800, 1801)
STEPS = (1, 3, 4, 6, 7, 9, 10, 30, 31, 60, 61)


def _sessions(spark, visits, steps):
    rows = [(v, 0) for v in visits] + [(0, s) for s in steps]
    return spark.createDataFrame(rows, "visit_length long, step_length long")


def test_visit_bin_edges(spark):
    row = session_stats_counts(_sessions(spark, VISITS, ())).first()
    assert row.session_count == 18
    assert [row[name] for name in VISIT_COLUMNS] == [2, 2, 2, 2, 2, 2, 2, 1]


def test_step_bin_edges(spark):
    row = session_stats_counts(_sessions(spark, (), STEPS)).first()
    assert [row[name] for name in STEP_COLUMNS] == [2, 2, 2, 2, 2, 1]


def test_visit_edges_from_actions(action_rows):
    rows = []
    for length in VISITS:
        end = f"2024-01-01 {length // 3600}:{length // 60 % 60:02d}:{length % 60:02d}"
        rows += [
            {"session_id": str(length), "action_time": "2024-01-01 0:00:00"},
            {"session_id": str(length), "action_time": end},
        ]
    row = session_stats_counts(session_metrics(action_rows(*rows))).first()
    assert row.session_count == 18
    assert [row[name] for name in VISIT_COLUMNS] == [2, 2, 2, 2, 2, 2, 2, 1]


def test_ratios(spark):
    counts = session_stats_counts(_sessions(spark, [2] * 57 + [5] * 143, ()))
    row = session_stats_ratios(counts, 9).first()
    assert (row.task_id, row.session_count) == (9, 200)
    assert (row.visit_length_1s_3s_ratio, row.visit_length_4s_6s_ratio) == (0.29, 0.72)
    assert row.visit_length_30m_ratio == 0.0


def test_no_sessions(spark):
    row = session_stats_ratios(session_stats_counts(_sessions(spark, (), ())), 1).first()
    assert row.session_count == 0
    assert {v for k, v in row.asDict().items() if k.endswith("_ratio")} == {None}


def test_merge(spark):
    sessions = _sessions(spark, VISITS, STEPS)
    split = session_stats_counts(sessions.selectExpr("*", "visit_length % 5 AS g"), "g")
    whole = session_stats_counts(sessions)
    assert merge_session_stats(split).first() == whole.first()
    assert set(merge_session_stats(split.limit(0)).first()) == {0}
    assert whole.columns == list(STAT_COLUMNS)

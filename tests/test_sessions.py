from __future__ import annotations

from clickloom.operators.sessions import (
    session_aggregate,
    session_metrics,
    session_start_time,
    with_user,
)


def test_roll_up(action_rows):
    actions = action_rows(
        {"session_id": "s", "action_time": "2024-01-01 9:00:05", "search_keyword": "b"},
        {"session_id": "s", "action_time": "2024-01-01 9:00:01", "search_keyword": "a"},
        {"session_id": "s", "action_time": "2024-01-01 10:00:00", "search_keyword": ""},
        {"session_id": "t", "action_time": "2024-01-01 23:59:59", "user_id": 2},
    )
    rows = {r.session_id: r for r in session_start_time(session_aggregate(actions)).collect()}
    s, t = rows["s"], rows["t"]
    assert (s.user_id, s.start_time, s.visit_length, s.step_length) == (
        1,
        "2024-01-01 09:00:01",
        3599,
        3,
    )
    assert (s.search_keywords, s.click_category_ids) == ("a,b", None)
    assert (t.user_id, t.visit_length, t.step_length) == (2, 0, 1)


def test_values_contained_in_others_are_kept(action_rows):
    at = "2024-01-01 1:00:00"
    actions = action_rows(
        *[{"session_id": "s", "action_time": at, "search_keyword": w} for w in ("158", "58")],
        *[{"session_id": "s", "action_time": at, "click_category_id": c} for c in ("12", "1")],
        {"session_id": "s", "action_time": at, "click_category_id": "12"},
    )
    row = session_aggregate(actions).first()
    assert (row.search_keywords, row.click_category_ids) == ("158,58", "1,12")


def test_stored_timestamps_and_milliseconds(spark):
    actions = spark.sql(
        """SELECT 's' AS session_id, 1L AS user_id,
                  timestamp'2024-01-01 00:00:00.900' AS action_time
           UNION ALL SELECT 's', 1L, timestamp'2024-01-01 00:00:03.100'"""
    )
    assert session_metrics(actions).first().visit_length == 2


def test_unreadable_times(action_rows):
    actions = action_rows(
        {"session_id": "s", "action_time": "soon"},
        {"session_id": "s", "action_time": "2024-01-01 1:00:00"},
        {"session_id": "t", "action_time": None},
    )
    rows = {r.session_id: r for r in session_metrics(actions).collect()}
    assert (rows["s"].visit_length, rows["s"].step_length) == (0, 2)
    assert (rows["t"].visit_length, rows["t"].start_ts, rows["t"].step_length) == (None, None, 1)


def test_null_session_ids_are_one_session(action_rows):
    at = "2024-01-01 1:00:00"
    actions = action_rows({"action_time": at}, {"action_time": at})
    rows = session_metrics(actions).collect()
    assert [(r.session_id, r.step_length) for r in rows] == [(None, 2)]


def test_join_with_users(action_rows, user_rows):
    at = "2024-01-01 1:00:00"
    sessions = session_metrics(
        action_rows(*[{"session_id": f"s{u}", "user_id": u, "action_time": at} for u in (1, 2, 3)])
    )
    users = user_rows(
        (1, 30, "IT", "Rome", "male"), (2, 20, "IT", "Oslo", "male"), (2, 21, "IT", "Oslo", "male")
    )
    joined = with_user(sessions, users)
    assert sorted((r.session_id, r.age) for r in joined.collect()) == [
        ("s1", 30),
        ("s2", 20),
        ("s2", 21),
    ]


def test_match_flags(action_rows):
    at = "2024-01-01 1:00:00"
    actions = action_rows(
        {"session_id": "s", "action_time": at, "search_keyword": "b"},
        {"session_id": "s", "action_time": at, "click_category_id": "12"},
        {"session_id": "t", "action_time": at},
    )
    rows = session_metrics(actions, ["a", "b"], ["1"]).collect()
    assert {r.session_id: (r.keyword_match, r.category_match) for r in rows} == {
        "s": (True, False),
        "t": (False, False),
    }

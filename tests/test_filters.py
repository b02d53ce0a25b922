from __future__ import annotations

import pytest

from clickloom.operators.filters import (
    filter_age,
    filter_city,
    filter_click_categories,
    filter_keywords,
    filter_professional,
    filter_sessions,
    filter_sex,
)
from clickloom.operators.sessions import session_aggregate, session_metrics, with_user
from clickloom.params import TaskParams


@pytest.fixture
def sessions(spark):
    return spark.createDataFrame(
        [
            ("a", 20, "IT", "Rome", "male", "b,c", "1,12"),
            ("b", 30, "IT,Law", "Oslo", "female", None, "2"),
            ("c", None, None, None, None, "a", None),
            ("d", 40, "Law", "Rome", "male", "ab", "112"),
        ],
        "session_id string, age int, professional string, city string, sex string,"
        " search_keywords string, click_category_ids string",
    )


def _ids(rows):
    return "".join(sorted(r.session_id for r in rows.collect()))


def test_age(sessions):
    assert _ids(filter_age(sessions, 20, 30)) == "ab"
    assert _ids(filter_age(sessions, 20, None)) == "abcd"
    assert _ids(filter_age(sessions, None, 30)) == "abcd"


def test_lists(sessions):
    assert _ids(filter_professional(sessions, ("Law", "x"))) == "bd"
    assert _ids(filter_city(sessions, ("Rome",))) == "ad"
    assert _ids(filter_keywords(sessions, ("a", "b"))) == "ac"
    assert _ids(filter_click_categories(sessions, ("12", "2"))) == "ab"
    assert _ids(filter_keywords(sessions, ())) == ""
    assert _ids(filter_keywords(sessions, None)) == "abcd"


def test_sex(sessions):
    assert _ids(filter_sex(sessions, "male")) == "ad"
    assert _ids(filter_sex(sessions, "Male")) == ""
    assert _ids(filter_sex(sessions, None)) == "abcd"


def test_all_together(sessions):
    assert _ids(filter_sessions(sessions, TaskParams())) == "abcd"
    params = TaskParams(start_age=10, end_age=40, cities=("Rome",), category_ids=("1", "112"))
    assert _ids(filter_sessions(sessions, params)) == "ad"


def test_flags_agree_with_texts(action_rows, one_user):
    at = "2024-01-01 1:00:00"
    actions = action_rows(
        *[
            {
                "session_id": f"s{i % 40}",
                "action_time": at,
                "search_keyword": f"w{i % 7}" if i % 2 else None,
                "click_category_id": str(i % 11) if i % 3 else "",
            }
            for i in range(200)
        ]
    )
    params = TaskParams(keywords=("w1", "w3"), category_ids=("2", "5"))
    by_text = filter_sessions(with_user(session_aggregate(actions), one_user), params)
    by_flag = filter_sessions(
        with_user(session_metrics(actions, params.keywords, params.category_ids), one_user),
        params,
    )
    assert _ids(by_text) == _ids(by_flag) != ""

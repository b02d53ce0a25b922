from __future__ import annotations

import pytest

from clickloom.operators.categories import (
    category_counts,
    category_sort,
    category_touches,
    click_count_by_category,
    distinct_categories,
    order_count_by_category,
    pay_count_by_category,
    top_categories,
)

AT = "2024-01-01 1:00:00"


@pytest.fixture
def actions(action_rows):
    rows = [
        {"session_id": "a", "click_category_id": "1"},
        {"session_id": "a", "order_category_ids": "1,2,"},
        {"session_id": "a", "pay_category_ids": ",1"},
        {"session_id": "b", "click_category_id": "1"},
        {"session_id": "b", "click_category_id": ""},
        {"session_id": "b", "order_category_ids": "3,3"},
        {"session_id": "b", "click_category_id": "4", "pay_category_ids": "1"},
        {"session_id": None, "click_category_id": "5"},
        {"session_id": "c"},
    ]
    return action_rows(*[{"action_time": AT, **r} for r in rows])


@pytest.fixture
def only_a(spark):
    # the join with duplicate users may repeat a session
    return spark.createDataFrame([("a",), ("a",), (None,)], "session_id string")


def _counts(rows):
    return {r.category_id: tuple(r)[1:] for r in rows.collect()}


def test_touches(actions):
    rows = sorted((r.kind, r.category_id) for r in category_touches(actions).collect())
    assert rows == [
        ("click", "1"),
        ("click", "1"),
        ("click", "4"),
        ("click", "5"),
        ("order", "1"),
        ("order", "2"),
        ("order", "3"),
        ("order", "3"),
        ("pay", "1"),
        ("pay", "1"),
    ]


def test_counts_per_kind(actions):
    assert _counts(click_count_by_category(actions)) == {"1": (2,), "4": (1,), "5": (1,)}
    assert _counts(order_count_by_category(actions)) == {"1": (1,), "2": (1,), "3": (2,)}
    assert _counts(pay_count_by_category(actions)) == {"1": (2,)}


def test_categories_of_sessions(actions, only_a):
    rows = distinct_categories(actions, only_a).collect()
    assert sorted(r.category_id for r in rows) == ["1", "2"]


def test_count_scope(actions, only_a):
    assert _counts(category_counts(actions, only_a)) == {"1": (2, 1, 2), "2": (0, 1, 0)}
    assert _counts(category_counts(actions, only_a, "filtered")) == {
        "1": (1, 1, 1),
        "2": (0, 1, 0),
    }
    with pytest.raises(ValueError):
        category_counts(actions, only_a, "some")


def test_click_with_comma_is_one_category(action_rows):
    actions = action_rows({"session_id": "a", "action_time": AT, "click_category_id": "1,2"})
    assert [r.category_id for r in category_touches(actions).collect()] == ["1,2"]


def test_order_and_ties(spark):
    counts = spark.createDataFrame(
        [
            ("10", 5, 1, 1),
            ("9", 5, 1, 1),
            ("1", 5, 1, 0),
            ("2", 5, 2, 0),
            ("3", 2**40, 0, 0),
            ("4", 1, 0, 0),
        ],
        "category_id string, click_count long, order_count long, pay_count long",
    )
    assert [r.category_id for r in category_sort(counts).collect()] == [3, 2, 9, 10, 1, 4]
    top = top_categories(counts, 8, 3).collect()
    assert [tuple(r) for r in top] == [(8, 3, 2**40, 0, 0), (8, 2, 5, 2, 0), (8, 9, 5, 1, 1)]
    assert top_categories(counts, 8).count() == 6


def test_equal_numbers_are_one_category(action_rows, spark):
    clicked = [{"session_id": "a", "action_time": AT, "click_category_id": c} for c in ("007", "7")]
    listed = {"session_id": "a", "action_time": AT, "order_category_ids": "07,7,8"}
    actions = action_rows(*clicked, listed)
    sessions = spark.createDataFrame([("a",)], "session_id string")
    counts = category_counts(actions, sessions)
    assert _counts(counts) == {"7": (2, 2, 0), "8": (0, 1, 0)}
    assert _counts(click_count_by_category(actions)) == {"7": (2,)}
    top = top_categories(counts, 1).collect()
    assert [tuple(r) for r in top] == [(1, 7, 2, 2, 0), (1, 8, 0, 1, 0)]


def test_category_that_is_no_number_is_an_error(action_rows, spark):
    rows = [{"session_id": "a", "action_time": AT, "click_category_id": c} for c in ("abc", "7")]
    sessions = spark.createDataFrame([("a",)], "session_id string")
    counts = category_counts(action_rows(*rows), sessions)
    assert _counts(counts) == {"7": (1, 0, 0), "abc": (1, 0, 0)}
    with pytest.raises(Exception, match="no number: abc"):
        top_categories(counts, 1).collect()

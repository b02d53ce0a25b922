"""Session filters. Each is skipped when its parameter is absent; a null value fails."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.functions import lists_overlap
from clickloom.params import TaskParams


def _holds(predicate: Column) -> Column:
    return F.coalesce(predicate, F.lit(False))


def filter_age(sessions: DataFrame, start: int | None, end: int | None) -> DataFrame:
    """Inclusive age range; applies only when both bounds are given."""
    return _keep(sessions, _age(start, end))


def filter_professional(sessions: DataFrame, wanted: Sequence[str] | None) -> DataFrame:
    """Any of the listed professions; the column may itself be a comma list."""
    return _keep(sessions, _any_of("professional", wanted))


def filter_city(sessions: DataFrame, wanted: Sequence[str] | None) -> DataFrame:
    """Any of the listed cities."""
    return _keep(sessions, _any_of("city", wanted))


def filter_sex(sessions: DataFrame, wanted: str | None) -> DataFrame:
    """Exact equality."""
    return _keep(sessions, _sex(wanted))


def filter_keywords(sessions: DataFrame, wanted: Sequence[str] | None) -> DataFrame:
    """Any keyword of the session is one of the listed."""
    return _keep(sessions, _match(sessions, "keyword_match", "search_keywords", wanted))


def filter_click_categories(sessions: DataFrame, wanted: Sequence[str] | None) -> DataFrame:
    """Any clicked category of the session is one of the listed."""
    return _keep(sessions, _match(sessions, "category_match", "click_category_ids", wanted))


def session_condition(sessions: DataFrame, params: TaskParams) -> Column | None:
    """All filters of a task as one condition, never null; none if the task has no filter."""
    present = [
        p
        for p in (
            _age(params.start_age, params.end_age),
            _any_of("professional", params.professionals),
            _any_of("city", params.cities),
            _sex(params.sex),
            _match(sessions, "keyword_match", "search_keywords", params.keywords),
            _match(sessions, "category_match", "click_category_ids", params.category_ids),
        )
        if p is not None
    ]
    return reduce(Column.__and__, present) if present else None


def filter_sessions(sessions: DataFrame, params: TaskParams) -> DataFrame:
    """All filters of a task. Those on user columns reach the user scan through the join."""
    return _keep(sessions, session_condition(sessions, params))


def _keep(sessions: DataFrame, predicate: Column | None) -> DataFrame:
    return sessions if predicate is None else sessions.where(predicate)


def _age(start: int | None, end: int | None) -> Column | None:
    if start is None or end is None:
        return None
    return _holds(F.col("age").between(start, end))


def _any_of(column: str, wanted: Sequence[str] | None) -> Column | None:
    return None if wanted is None else lists_overlap(F.col(column), wanted)


def _sex(wanted: str | None) -> Column | None:
    return None if wanted is None else _holds(F.col("sex") == wanted)


def _match(
    sessions: DataFrame, flag: str, text: str, wanted: Sequence[str] | None
) -> Column | None:
    """The flag computed during the roll-up when it is there, else the text."""
    if wanted is None:
        return None
    return _holds(F.col(flag)) if flag in sessions.columns else lists_overlap(F.col(text), wanted)

"""Actions rolled up to sessions, and sessions joined with users.

Two forms of the roll-up. :func:`session_metrics` keeps fixed-width values only and
runs as a code-generated hash aggregate with partial aggregation, so a session that
holds a large share of all rows reaches its reducer as one row per map task.
:func:`session_aggregate` adds the keyword and category texts for reports that show
them; their sets are merged map-side as well.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.functions import as_timestamp, format_time, is_not_empty, lists_overlap
from clickloom.sources.tables import scan_users


def _base_metrics() -> list[Column]:
    return [
        F.min("user_id").alias("user_id"),
        F.min("_at").alias("start_ts"),
        # difference of the milliseconds, floored to seconds
        F.call_function(
            "div",
            F.unix_millis(F.max("_at")) - F.unix_millis(F.min("_at")),
            F.lit(1000).cast("bigint"),
        ).alias("visit_length"),
        F.count(F.lit(1)).alias("step_length"),
    ]


def _timed(actions: DataFrame) -> DataFrame:
    return actions.withColumn("_at", as_timestamp(actions, "action_time"))


def session_metrics(
    actions: DataFrame,
    keywords: Sequence[str] | None = None,
    category_ids: Sequence[str] | None = None,
) -> DataFrame:
    """One row per session: user, start, visit length in seconds, number of actions.

    With ``keywords`` / ``category_ids`` it also tells whether any action of the session
    searched / clicked one of them (``keyword_match``, ``category_match``), which is all
    the session filter needs.
    """
    metrics = _base_metrics()
    if keywords is not None:
        metrics.append(
            F.bool_or(lists_overlap(F.col("search_keyword"), keywords)).alias("keyword_match")
        )
    if category_ids is not None:
        metrics.append(
            F.bool_or(lists_overlap(F.col("click_category_id"), category_ids)).alias(
                "category_match"
            )
        )
    return _timed(actions).groupBy("session_id").agg(*metrics)


def _distinct_text(name: str) -> Column:
    """Distinct non-empty values, sorted and comma-joined; null when there are none."""
    values = F.collect_set(F.when(is_not_empty(F.col(name)), F.col(name)))
    return F.nullif(F.array_join(F.array_sort(values), ","), F.lit(""))


def session_keywords(actions: DataFrame) -> DataFrame:
    """Distinct search keywords of each session."""
    return actions.groupBy("session_id").agg(
        _distinct_text("search_keyword").alias("search_keywords")
    )


def session_click_categories(actions: DataFrame) -> DataFrame:
    """Distinct clicked categories of each session."""
    return actions.groupBy("session_id").agg(
        _distinct_text("click_category_id").alias("click_category_ids")
    )


def session_texts(actions: DataFrame) -> DataFrame:
    """Keywords and clicked categories of each session.

    Actions without a session are left out: their texts belong to no session, and would be
    one group of any size.
    """
    return actions.where(F.col("session_id").isNotNull()).groupBy("session_id").agg(
        _distinct_text("search_keyword").alias("search_keywords"),
        _distinct_text("click_category_id").alias("click_category_ids"),
    )


def session_aggregate(actions: DataFrame) -> DataFrame:
    """:func:`session_metrics` plus keyword and category texts, in one shuffle."""
    return (
        _timed(actions)
        .groupBy("session_id")
        .agg(
            *_base_metrics(),
            _distinct_text("search_keyword").alias("search_keywords"),
            _distinct_text("click_category_id").alias("click_category_ids"),
        )
    )


def session_start_time(sessions: DataFrame) -> DataFrame:
    """Replaces the start timestamp by its ``yyyy-MM-dd HH:mm:ss`` text."""
    return sessions.withColumn("start_time", format_time(F.col("start_ts"))).drop("start_ts")


def with_user(sessions: DataFrame, users: DataFrame) -> DataFrame:
    """Inner join with the user attributes; sessions of unknown users drop out.

    No broadcast hint: the optimizer broadcasts the users only when their size is known
    to be below ``spark.sql.autoBroadcastJoinThreshold``. Beyond that the join shuffles by
    user and the adaptive skew join splits the sessions of a hot user over several tasks.
    """
    return sessions.join(scan_users(users), "user_id", "inner")

"""Distribution of visit length and step length over sessions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.functions import ratio_half_up
from clickloom.schemas import (
    STAT_COLUMNS,
    STEP_COLUMNS,
    STEP_LENGTH_BINS,
    VISIT_COLUMNS,
    VISIT_LENGTH_BINS,
)


def _in_bin(column: str, low: int, high: int | None) -> Column:
    value = F.col(column)
    return value >= low if high is None else value.between(low, high)


def stat_columns(kept: Column | None = None) -> list[Column]:
    """Session count and sessions per bin as aggregates, of the sessions ``kept`` if given.

    They count, so they can also be observed while sessions are written.
    """
    every = F.lit(True) if kept is None else kept
    counts = [F.count_if(every).alias("session_count")]
    for column, names, bins in (
        ("visit_length", VISIT_COLUMNS, VISIT_LENGTH_BINS),
        ("step_length", STEP_COLUMNS, STEP_LENGTH_BINS),
    ):
        counts += [
            F.count_if(every & _in_bin(column, low, high)).alias(name)
            for name, (_, low, high) in zip(names, bins, strict=True)
        ]
    return counts


def session_stats_counts(sessions: DataFrame, *by: str) -> DataFrame:
    """Session count and sessions per bin; one row, or one per group of ``by``."""
    return sessions.groupBy(*by).agg(*stat_columns())


def merge_session_stats(partials: DataFrame) -> DataFrame:
    """Counts of several partial statistics added up; zeros when there are none."""
    return partials.agg(
        *[F.coalesce(F.sum(name), F.lit(0).cast("bigint")).alias(name) for name in STAT_COLUMNS]
    )


def session_stats_ratios(counts: DataFrame, task_id: int) -> DataFrame:
    """Share of each bin in the session count, two decimals; null without sessions."""
    total = F.col("session_count")
    return counts.select(
        F.lit(task_id).cast("bigint").alias("task_id"),
        "session_count",
        *[
            ratio_half_up(F.col(name), total).alias(f"{name}_ratio")
            for name in (*VISIT_COLUMNS, *STEP_COLUMNS)
        ],
    )

"""The session analysis of one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from clickloom.operators.categories import category_counts, top_categories
from clickloom.operators.filters import filter_sessions, session_condition
from clickloom.operators.sampling import (
    random_extract_sessions,
    sample_sessions,
    sampled_actions,
    session_detail,
)
from clickloom.operators.sessions import session_metrics, with_user
from clickloom.operators.stats import session_stats_counts, session_stats_ratios, stat_columns
from clickloom.params import TaskParams
from clickloom.schemas import SAMPLE_TOTAL, STAT_COLUMNS, TOP_CATEGORIES
from clickloom.session import new_work_dir
from clickloom.sinks import ResultWriter
from clickloom.sinks.files import remove
from clickloom.sources.tables import scan_actions


def analysed_sessions(actions: DataFrame, users: DataFrame, params: TaskParams) -> DataFrame:
    """Sessions of the task's dates with user attributes and the flags its filter needs."""
    scanned = scan_actions(actions, params.start_date, params.end_date)
    return with_user(session_metrics(scanned, params.keywords, params.category_ids), users)


def session_statistics(actions: DataFrame, users: DataFrame, params: TaskParams) -> DataFrame:
    """Bin ratios of the task's filtered sessions, one row."""
    sessions = filter_sessions(analysed_sessions(actions, users, params), params)
    return session_stats_ratios(session_stats_counts(sessions), params.task_id)


def top_categories_of_task(
    actions: DataFrame,
    users: DataFrame,
    params: TaskParams,
    n: int = TOP_CATEGORIES,
    count_scope: str = "all",
) -> DataFrame:
    """Top categories among those the task's filtered sessions touch."""
    scanned = scan_actions(actions, params.start_date, params.end_date)
    sessions = filter_sessions(analysed_sessions(actions, users, params), params)
    return top_categories(category_counts(scanned, sessions, count_scope), params.task_id, n)


def _observed_counts(spark: SparkSession, observed: Observation) -> DataFrame:
    """The counts observed while rows were written, one row; zeros where there were none."""
    found = observed.get
    return spark.range(1).select(
        *[F.lit(found.get(name) or 0).cast("bigint").alias(name) for name in STAT_COLUMNS]
    )


def run_session_analysis(
    actions: DataFrame,
    users: DataFrame,
    params: TaskParams,
    write: ResultWriter,
    sample_total: int = SAMPLE_TOTAL,
    seed: int = 0,
    count_scope: str = "all",
) -> None:
    """Run a task and write its four results.

    ``session_aggr_stat``, ``session_random_extract``, ``session_detail`` and
    ``top10_category``. The roll-up is by far the largest shuffle and feeds all four, so
    it is written once to the shared work folder and read from there: the later steps
    read only the columns they need and do not depend on the executors that wrote it.
    The statistic is counted by the tasks that write the roll-up, which is not read for it.
    A task that runs again after a loss counts once, as only the stage of the write counts.
    The sample and its actions are written likewise because two results are made of
    them. The work folder goes when the job ends, also with an error.
    """
    spark = actions.sparkSession
    work = new_work_dir(spark, "session-analysis")
    task_id = params.task_id

    def stored(rows: DataFrame, name: str) -> DataFrame:
        rows.write.parquet(f"{work}/{name}")
        return spark.read.schema(rows.schema).parquet(f"{work}/{name}")

    try:
        scanned = scan_actions(actions, params.start_date, params.end_date)
        rolled_up, observed = analysed_sessions(actions, users, params), Observation()
        kept = session_condition(rolled_up, params)
        sessions = stored(rolled_up.observe(observed, *stat_columns(kept)), "sessions")
        filtered = filter_sessions(sessions, params)
        stats = session_stats_ratios(_observed_counts(spark, observed), task_id)
        write(stats, "session_aggr_stat", task_id)

        sample = stored(sample_sessions(sessions, sample_total, seed), "sample")
        drawn = stored(sampled_actions(scanned, sample), "actions")
        write(random_extract_sessions(drawn, sample, task_id), "session_random_extract", task_id)
        write(session_detail(drawn, task_id), "session_detail", task_id)

        counts = category_counts(scanned, filtered, count_scope)
        write(top_categories(counts, task_id), "top10_category", task_id)
    finally:
        remove(spark, work)

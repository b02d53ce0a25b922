"""Roll-up and actions of filtered sessions over actions stored by session."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from clickloom.operators.filters import filter_sessions
from clickloom.operators.sampling import session_detail
from clickloom.operators.sessions import session_aggregate, session_start_time
from clickloom.plans.session_analysis import analysed_sessions
from clickloom.queries import model
from clickloom.queries.model import TASK
from clickloom.queries.registry import SQL, query
from clickloom.queries import categories, sessions  # noqa: F401 - their SQL is used here
from clickloom.session import new_work_dir
from clickloom.sinks import StoredActions, store_by_session


def _stored(spark: SparkSession, folder: str) -> StoredActions:
    """A copy of all actions by session, with as many buckets as a shuffle has partitions."""
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"actions_{uuid.uuid4().hex}"
    place = new_work_dir(spark, "stored-actions")
    return store_by_session(model.actions(spark, folder), name, place, buckets)


@query("stored_session_aggregate", SQL["session_aggregate"])
def stored_session_aggregate(spark: SparkSession, folder: str) -> DataFrame:
    return session_start_time(_stored(spark, folder).per_session(session_aggregate))


@query("stored_session_actions", SQL["filtered_session_actions"])
def stored_session_actions(spark: SparkSession, folder: str) -> DataFrame:
    stored = _stored(spark, folder).scan(TASK.start_date, TASK.end_date)
    users = model.users(spark, folder)
    rolled_up = stored.per_session(lambda actions: analysed_sessions(actions, users, TASK))
    own = stored.of_sessions(filter_sessions(rolled_up, TASK))
    return session_detail(own, 0).drop("task_id")

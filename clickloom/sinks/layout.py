"""Actions stored by session, so that work per session needs no shuffle of actions.

A table bucketed by session gives every task whole sessions. One session with a large share
of all rows would be one bucket, though, read by one task on any cluster. Sessions of very
many actions therefore lie in a table of their own that is not bucketed, where partial
aggregation and split joins deal with them. No session is in both tables: what is computed
per session is computed on each, and the results are put together without another step.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.operators.joins import keep_or_drop
from clickloom.sources.tables import scan_actions

# actions of a session that a task reads whole, at most
MOST_ACTIONS = 1_000_000


@dataclass(frozen=True)
class StoredActions:
    """``regular`` is bucketed and sorted by session; ``hot`` has the sessions too large for it."""

    regular: DataFrame
    hot: DataFrame

    def scan(self, start_date: str | None = None, end_date: str | None = None) -> StoredActions:
        """The actions of some dates; the bounds prune partitions of both tables."""
        return StoredActions(
            scan_actions(self.regular, start_date, end_date),
            scan_actions(self.hot, start_date, end_date),
        )

    def per_session(self, operator: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """Rows of ``operator``, which makes each of its rows of the actions of one session.

        Its grouping by session has no exchange over ``regular``.
        """
        return operator(self.regular).unionByName(operator(self.hot))

    def of_sessions(self, sessions: DataFrame) -> DataFrame:
        """Actions of the given sessions. Of ``regular`` only the list of ids is exchanged."""
        ids = sessions.select("session_id")
        regular = self.regular.join(ids, "session_id", "left_semi")
        hot = keep_or_drop(self.hot, ids, "session_id", "left_semi")
        return regular.select(self.hot.columns).unionByName(hot)


def store_by_session(
    actions: DataFrame, name: str, folder: str, buckets: int, most: int = MOST_ACTIONS
) -> StoredActions:
    """Write ``actions`` as tables ``<name>_regular`` and ``<name>_hot`` below ``folder``.

    Both are partitioned by ``date``. A bucket holds one file per date, and a read over many
    dates has one task per bucket: choose ``buckets`` like the partitions of a shuffle of all
    of them. Sessions of more than ``most`` actions are hot, as are actions without a session.
    Which sessions are hot is decided over all ``actions``, so the tables are written
    together and replace earlier ones of that name. An empty ``date`` reads back as null.
    """
    spark = actions.sparkSession
    counted = actions.where("session_id IS NOT NULL").groupBy("session_id").count()
    large = counted.where(F.col("count") > most).select("session_id")
    large.write.mode("overwrite").parquet(f"{folder}/large")
    large = spark.read.schema(large.schema).parquet(f"{folder}/large")

    known = actions.where("session_id IS NOT NULL")
    regular = keep_or_drop(known, large, "session_id", "left_anti").select(actions.columns)
    hot = keep_or_drop(known, large, "session_id", "left_semi").select(actions.columns)
    hot = hot.unionByName(actions.where("session_id IS NULL"))
    (
        # bucket numbers are those of this partitioning, so a task writes one bucket
        regular.repartition(buckets, "session_id")
        .write.partitionBy("date")
        .bucketBy(buckets, "session_id")
        .sortBy("session_id")
        .mode("overwrite")
        .option("path", f"{folder}/regular")
        .saveAsTable(f"{name}_regular")
    )
    (
        hot.write.partitionBy("date")
        .mode("overwrite")
        .option("path", f"{folder}/hot")
        .saveAsTable(f"{name}_hot")
    )
    return stored_actions(spark, name)


def stored_actions(spark: SparkSession, name: str) -> StoredActions:
    """The tables :func:`store_by_session` wrote under ``name``."""
    return StoredActions(spark.table(f"{name}_regular"), spark.table(f"{name}_hot"))

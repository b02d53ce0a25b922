"""The streaming jobs: clicks in, tables out.

Running totals are keyed state: a streaming aggregation without a watermark, whose state store
holds the total of every key, so no click is too late and no batch reads a stored total. The
totals a batch touched are appended to their table. A query with a new checkpoint has an empty
state store; it begins with the totals of the table, read as a second stream in its first batch.
Clicks are partially counted before they are shuffled, so a hot user or ad is one row per task.
"""

from __future__ import annotations

from threading import Event

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter

from clickloom.operators.adclicks import (
    ad_day_key,
    ad_minute_key,
    blacklist_users,
    trend_columns,
    without_blacklisted,
)
from clickloom.schemas import BATCH_SECONDS, BLACKLIST_THRESHOLD
from clickloom.sinks import CROWDED, TotalsTable
from clickloom.sinks.files import exists

EVERY_BATCH = {"processingTime": f"{BATCH_SECONDS} seconds"}
AVAILABLE_NOW = {"availableNow": True}


def _writer(rows: DataFrame, checkpoint: str, trigger: dict | None) -> DataStreamWriter:
    return rows.writeStream.option("checkpointLocation", checkpoint).trigger(
        **(EVERY_BATCH if trigger is None else trigger)
    )


def _running_totals(counted: DataFrame, table: TotalsTable, checkpoint: str) -> DataFrame:
    """Totals of the keys of ``counted`` and of the table, as one stream.

    What the table holds when a checkpoint is new lies beside the checkpoint from then on.
    """
    spark, seed = counted.sparkSession, f"{checkpoint}-seed"
    if not exists(spark, f"{checkpoint}/offsets"):
        table.table().select(*table.schema.names).write.mode("overwrite").parquet(seed)
    seeds = spark.readStream.schema(table.schema).parquet(seed)
    both = counted.select(*table.schema.names).unionByName(seeds)
    return both.groupBy(*table.keys).agg(F.sum(table.value).alias(table.value))


def start_click_copy(
    clicks: DataFrame, path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Append the clicks of every micro-batch to a Parquet table."""
    return _writer(clicks, checkpoint, trigger).format("parquet").start(path)


def start_rejected_copy(
    rejected: DataFrame, path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Append the lines that could not be read to a text table."""
    return _writer(rejected, checkpoint, trigger).format("text").start(path)


def start_filtered_clicks(
    clicks: DataFrame,
    blacklist: TotalsTable,
    path: str,
    checkpoint: str,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Write the clicks of users who are not listed, against the list as it is at each batch.

    The table at ``path`` is partitioned by ``run``, the id of the query, and ``batch_id``. A
    batch that runs again replaces what its first attempt wrote.
    """
    started, query = Event(), []

    def keep_unlisted(batch: DataFrame, batch_id: int) -> None:
        started.wait()
        kept = without_blacklisted(batch, blacklist.table())
        kept = kept.withColumns({"run": F.lit(query[0].id), "batch_id": F.lit(batch_id)})
        kept.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            "run", "batch_id"
        ).parquet(path)

    query.append(_writer(clicks, checkpoint, trigger).foreachBatch(keep_unlisted).start())
    started.set()
    return query[0]


def start_daily_counts(
    clicks: DataFrame,
    counts: TotalsTable,
    blacklist: TotalsTable,
    checkpoint: str,
    threshold: int = BLACKLIST_THRESHOLD,
    trigger: dict | None = None,
    rewrite_every: int = CROWDED,
) -> StreamingQuery:
    """Keep clicks per day, user and ad, and the blacklist fed by them.

    Each micro-batch, in this order: leaves out the totals of users listed by earlier batches;
    appends the others to the count table; lists users one of whose totals reached the
    threshold. So the totals of a listed user stay as they were in the batch that listed the
    user, and nobody is ever taken off the list.

    A batch that runs again has the same totals. Users its first attempt listed are left out,
    but their totals were appended before they were listed. Every click counts for its own
    day, however late it comes.
    """
    one = ad_day_key(clicks).withColumn("click_count", F.lit(1).cast("bigint"))

    def apply_batch(batch: DataFrame, batch_id: int) -> None:
        if batch_id % rewrite_every == rewrite_every - 1:
            counts.rewrite(counts.crowded_dates(rewrite_every))
        fresh = without_blacklisted(batch, blacklist.table()).persist()
        try:
            counts.add(fresh)
            found = blacklist_users(fresh, threshold)
            # most batches list nobody; they add no file to be read by every later batch
            if not found.isEmpty():
                blacklist.add(found)
        finally:
            fresh.unpersist()

    _require_utc(clicks)
    totals = _running_totals(one, counts, checkpoint)
    return _writer(totals, checkpoint, trigger).outputMode("update").foreachBatch(apply_batch).start()


def start_ad_trend(
    clicks: DataFrame,
    trend: TotalsTable,
    checkpoint: str,
    trigger: dict | None = None,
    rewrite_every: int = CROWDED,
) -> StreamingQuery:
    """Keep clicks per minute and ad; each micro-batch appends the totals it touched."""
    one = ad_minute_key(clicks).withColumn("click_count", F.lit(1).cast("bigint"))

    def add_minutes(batch: DataFrame, batch_id: int) -> None:
        if batch_id % rewrite_every == rewrite_every - 1:
            trend.rewrite(trend.crowded_dates(rewrite_every))
        trend.add(batch)

    _require_utc(clicks)
    totals = _running_totals(trend_columns(one), trend, checkpoint)
    return _writer(totals, checkpoint, trigger).outputMode("update").foreachBatch(add_minutes).start()


def _require_utc(clicks: DataFrame) -> None:
    """Days are UTC days; another time zone would file clicks under other dates."""
    zone = clicks.sparkSession.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "Z", "GMT"):
        raise ValueError(f"set spark.sql.session.timeZone to UTC, it is {zone}")

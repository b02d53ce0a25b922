"""The click trend by arrival: clicks per minute and ad that arrived within the last hour.

The window ends with the current step of ten seconds. As steps leave it, the count of a minute
falls and replaces the stored one; the last count above zero stays. The state of an ad is its
ring, the clicks per (minute, step of arrival) of one hour. It changes when clicks come and when
a timer says that its oldest step has left. Clicks are counted per step before the shuffle, so a
hot ad is some rows per task, and its ring has as many entries as an hour has steps and minutes.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from clickloom.operators.adclicks import trend_columns
from clickloom.schemas import TREND_SLIDE_SECONDS, TREND_WINDOW_MINUTES
from clickloom.sinks import CROWDED, TotalsTable
from clickloom.streaming.jobs import _require_utc, _writer

STEP_MILLIS = TREND_SLIDE_SECONDS * 1000
STEPS = TREND_WINDOW_MINUTES * 60 // TREND_SLIDE_SECONDS

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

_COUNTS = "ad_id long, minute long, step long, n long"
_CHANGES = "ad_id long, minute long, as_of long, n long"

Ring = dict[int, dict[int, int]]


def turn(ring: Ring, arrived: Iterable[tuple[int, int, int]], now: int) -> list[tuple]:
    """Take (minute, step, clicks) into the ring and let go what has left by step ``now``.

    Gives (minute, step of the window, count) of every minute whose count changed. A minute
    none of whose clicks is left is forgotten with its last count, that of the last window
    with one of them.
    """
    changed = set()
    for minute, step, n in arrived:
        steps = ring.setdefault(minute, {})
        steps[step] = steps.get(step, 0) + n
        changed.add(minute)
    out = []
    for minute, steps in list(ring.items()):
        last = max(steps)
        at = min(now, last + STEPS - 1)
        gone = [s for s in steps if s <= at - STEPS]
        for step in gone:
            del steps[step]
        if gone or minute in changed:
            out.append((minute, at, sum(steps.values())))
        if now >= last + STEPS:
            del ring[minute]
    return out


class _Rings(StatefulProcessor):
    """One ring per ad; time is the watermark, which is the latest arrival."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._ring = handle.getValueState(
            "ring", "minutes array<bigint>, steps array<bigint>, counts array<bigint>"
        )

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        arrived = [(r.minute, r.step, r.n) for r in rows]
        clock = timerValues.getCurrentWatermarkInMs() // STEP_MILLIS
        return self._turned(key, arrived, max(clock, *(step for _, step, _ in arrived)))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        return self._turned(key, [], timerValues.getCurrentWatermarkInMs() // STEP_MILLIS)

    def _turned(self, key, arrived: list[tuple[int, int, int]], now: int) -> Iterator[Row]:
        ring: Ring = {}
        if self._ring.exists():
            for minute, step, n in zip(*self._ring.get()):
                ring.setdefault(minute, {})[step] = n
        changes = turn(ring, arrived, now)
        held = [(minute, step, n) for minute, steps in ring.items() for step, n in steps.items()]
        if held:
            self._ring.update(tuple(list(column) for column in zip(*held)))
            leaves = min(step for _, step, _ in held) + STEPS
            self._handle.registerTimer(leaves * STEP_MILLIS)
        else:
            self._ring.clear()
        for minute, at, n in changes:
            yield Row(ad_id=key[0], minute=minute, as_of=at, n=n)

    def close(self) -> None:
        pass


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Clicks per ad, minute and step of each batch."""
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = rows.group_by(["ad_id", "minute", "step"]).aggregate([("ad_id", "count")])
        rows = rows.rename_columns(["ad_id", "minute", "step", "n"])
        yield from rows.to_batches()


def window_changes(clicks: DataFrame, arrival: str) -> DataFrame:
    """Changed counts of minutes, ``ad_id, minute, as_of, n``, times in minutes and steps.

    A click without a time of arrival counts nowhere. One that is handed over after later ones
    counts in its own step; if that has left the window already, it changes no later count.
    """
    keyed = clicks.where(F.col(arrival).isNotNull()).withWatermark(arrival, "0 seconds")
    keyed = keyed.select(
        "ad_id",
        F.floor(F.unix_millis("ts") / 60_000).alias("minute"),
        F.floor(F.unix_millis(arrival) / STEP_MILLIS).alias("step"),
    )
    steps = keyed.mapInArrow(_counted, _COUNTS)
    return steps.groupBy("ad_id").transformWithState(_Rings(), _CHANGES, "Update", "EventTime")


def start_window_trend(
    clicks: DataFrame,
    trend: TotalsTable,
    checkpoint: str,
    arrival: str = "timestamp",
    trigger: dict | None = None,
    rewrite_every: int = CROWDED,
) -> StreamingQuery:
    """Keep the trend by arrival; each micro-batch appends the counts that changed.

    ``arrival`` names the column of ``clicks`` with the time each came in. In the table
    ``latest`` holds the step a count is of and the count; the greatest counts, so a batch that
    runs again changes nothing. A new checkpoint begins with empty rings: counts of the
    last hour are taken anew, all others stay.
    """

    def add_counts(batch: DataFrame, batch_id: int) -> None:
        if batch_id % rewrite_every == rewrite_every - 1:
            trend.rewrite(trend.crowded_dates(rewrite_every))
        rows = batch.select(
            F.timestamp_seconds(F.col("minute") * 60).alias("minute_ts"),
            "ad_id",
            F.struct("as_of", F.col("n").alias("click_count")).alias("click_count"),
        )
        trend.add(trend_columns(rows).withColumnRenamed("click_count", "latest"))

    _require_utc(clicks)
    spark = clicks.sparkSession
    before = spark.conf.get(STATE_STORE)
    # state with timers needs this store; a query keeps the settings it began with
    spark.conf.set(STATE_STORE, ROCKSDB)
    try:
        changes = window_changes(clicks, arrival)
        writer = _writer(changes, checkpoint, trigger).outputMode("update")
        return writer.foreachBatch(add_counts).start()
    finally:
        spark.conf.set(STATE_STORE, before)

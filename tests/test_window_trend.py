from __future__ import annotations

import random
from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from clickloom.plans import AdMonitor
from clickloom.sources import parse_ad_log, valid_clicks
from clickloom.streaming import AVAILABLE_NOW, start_window_trend
from clickloom.streaming.window import _COUNTS, STATE_STORE, STEPS, _counted, turn

START = datetime(2024, 1, 1, tzinfo=UTC)
ARRIVALS = "value string, timestamp timestamp"


def _replay(clicks: list[tuple[int, int]], now: int) -> dict:
    """clicks: (minute, step); slides the window step by step and stores what it sees."""
    table = {}
    for at in range(min(s for _, s in clicks), now + 1):
        seen = {}
        for minute, step in clicks:
            if at - STEPS < step <= at:
                seen[minute] = seen.get(minute, 0) + 1
        table |= seen
    return table


@pytest.mark.parametrize("seed", range(20))
def test_ring_equals_sliding_step_by_step(seed):
    rng = random.Random(seed)
    clicks = sorted(((rng.randrange(4), rng.randrange(1500)) for _ in range(40)), key=lambda c: c[1])
    ring, table, now = {}, {}, 0
    while clicks[now:]:
        part = clicks[now : now + rng.randrange(1, 9)]
        now += len(part)
        for minute, at, n in turn(ring, [(m, s, 1) for m, s in part], part[-1][1]):
            table[minute] = max(table.get(minute, (0, 0)), (at, n))
    for end in (clicks[-1][1], clicks[-1][1] + 200, clicks[-1][1] + 2 * STEPS):
        for minute, at, n in turn(ring, [], end):
            table[minute] = max(table.get(minute, (0, 0)), (at, n))
        assert {m: n for m, (_, n) in table.items()} == _replay(clicks, end)
    assert not ring


class Arrivals:
    def __init__(self, spark, root):
        self.spark, self.root = spark, str(root)
        self.monitor = AdMonitor(spark, f"{root}/monitor")

    def add(self, *clicks: tuple[datetime, datetime | None, int]) -> None:
        rows = [(f"{int(made.timestamp() * 1000)} p c 1 {ad}", at) for made, at, ad in clicks]
        frame = self.spark.createDataFrame(rows, ARRIVALS)
        frame.coalesce(1).write.mode("append").parquet(f"{self.root}/lines")

    def run(self, checkpoint: str = "window") -> dict:
        lines = self.spark.readStream.schema(ARRIVALS).parquet(f"{self.root}/lines")
        clicks = valid_clicks(parse_ad_log(lines, arrival="timestamp", keep=["timestamp"]))
        start_window_trend(
            clicks,
            self.monitor.window_trend,
            self.monitor.checkpoint(checkpoint),
            trigger=AVAILABLE_NOW,
            rewrite_every=2,
        ).awaitTermination()
        rows = self.monitor.click_window_trend().collect()
        return {(r.hour, r.minute, r.ad_id): r.click_count for r in rows}


@pytest.fixture
def arrivals(spark, tmp_path):
    return Arrivals(spark, tmp_path)


def _at(minutes: float) -> datetime:
    return START + timedelta(minutes=minutes)


def test_counts_fall_as_clicks_leave_and_other_ads_move_the_clock(spark, arrivals):
    store = spark.conf.get(STATE_STORE)
    arrivals.add(*[(_at(0), _at(m), 1) for m in (0.2, 0.4, 30)])
    assert arrivals.run() == {("00", "00", 1): 3}
    # only another ad is clicked; the first two clicks have left the hour, the third has not
    arrivals.add((_at(62), _at(62), 2))
    assert arrivals.run() == {("00", "00", 1): 1, ("01", "02", 2): 1}
    # the last one has left too: its count stays
    arrivals.add((_at(200), _at(200), 2))
    assert arrivals.run()[("00", "00", 1)] == 1
    # a straggler of the first minute is alone in its window
    arrivals.add(*[(_at(0), _at(201), 1)] * 2)
    assert arrivals.run()[("00", "00", 1)] == 2
    assert spark.conf.get(STATE_STORE) == store


def test_clicks_out_of_order_and_without_arrival(arrivals):
    arrivals.add((_at(0), _at(50), 1))
    arrivals.run()
    arrivals.add((_at(0), _at(10), 1), (_at(0), None, 1))
    assert arrivals.run() == {("00", "00", 1): 2}


def test_a_new_checkpoint_keeps_what_is_stored(arrivals):
    arrivals.add((_at(0), _at(0), 1), (_at(0), _at(1), 1))
    first = arrivals.run()
    assert arrivals.run("again") == first == {("00", "00", 1): 2}


def test_a_hot_ad_is_a_row_per_step_before_the_shuffle(spark):
    clicks = spark.range(20_000, numPartitions=1).selectExpr(
        "7L AS ad_id", "0L AS minute", "id DIV 5000 AS step"
    )
    got = clicks.mapInArrow(_counted, _COUNTS).groupBy("step").agg(F.count("*"), F.sum("n"))
    batches = -(-20_000 // int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")))
    assert all(rows <= batches and n == 5000 for _, rows, n in got.collect())

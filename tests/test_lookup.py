from __future__ import annotations

from pyspark.sql import functions as F

from clickloom.operators import adclicks as ops
from clickloom.plans.ad_monitoring import click_count_store
from clickloom.queries import QUERIES, model

FOLDER = "/root/testdata/sf0.001"


def test_lookup_covers_the_keys_of_all_afternoons(spark):
    clicks = model.clicks(spark, FOLDER)
    keys = ops.ad_day_key(clicks.where(F.hour("ts") >= 12)).distinct()
    got = QUERIES["lookup_user_click_count"](spark, FOLDER)
    found = {(r.date, r.user_id, r.ad_id) for r in got.collect()}
    assert found == {tuple(r) for r in keys.collect()}
    assert len({date for date, *_ in found}) > 3


def test_days_of_a_lookup_prune_partitions(spark, tmp_path):
    counts = click_count_store(spark, str(tmp_path / "counts"))
    counts.add(ops.daily_user_ad_clicks(model.clicks(spark, FOLDER)))
    days = ["2024-01-10", "2024-01-11", "2024-01-12"]
    plan = counts.table(dates=days)._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    assert all(day in scan.split("PartitionFilters:")[1].split("PushedFilters")[0] for day in days)

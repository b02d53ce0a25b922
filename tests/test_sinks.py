from __future__ import annotations

from pathlib import Path

import pytest

from clickloom.plans.ad_monitoring import blacklist_store, click_count_store
from clickloom.schemas import AD_BLACKLIST, AD_USER_CLICK_COUNT
from clickloom.session import new_work_dir
from clickloom.sinks import append_table


@pytest.fixture
def counts(spark):
    return lambda *rows: spark.createDataFrame(list(rows), AD_USER_CLICK_COUNT)


@pytest.fixture
def store(spark, tmp_path):
    return click_count_store(spark, str(tmp_path / "t"))


def _table(store, **bounds):
    return sorted(tuple(r) for r in store.table(**bounds).collect())


def test_append(spark, tmp_path, counts):
    path = str(tmp_path / "t")
    append_table(counts(("d", 1, 1, 1)), path)
    append_table(counts(("d", 1, 1, 1)), path)
    assert spark.read.parquet(path).count() == 2


def _files(store, date=""):
    return sorted(Path(store.path).glob(f"date={date}*/*.parquet"))


def test_the_greatest_total_counts_and_repeats_change_nothing(store, counts):
    assert _table(store) == []
    store.add(counts(("d", 1, 1, 60), ("d", 2, 1, 1)))
    store.add(counts(("d", 1, 1, 100), ("e", 1, 1, 7)))
    store.add(counts(("d", 1, 1, 60)))
    assert _table(store) == [("d", 1, 1, 100), ("d", 2, 1, 1), ("e", 1, 1, 7)]
    assert _table(store, dates=["e"]) == [("e", 1, 1, 7)]


def test_any_reader_gets_the_table(spark, store, counts):
    store.add(counts(("2024-01-01", 1, 1, 60)))
    store.add(counts(("2024-01-01", 1, 1, 61)))
    got = spark.sql(
        "SELECT date, user_id, ad_id, max(click_count) AS click_count"
        f" FROM parquet.`{store.path}` GROUP BY ALL"
    )
    assert [(str(r.date), r.click_count) for r in got.collect()] == [("2024-01-01", 61)]


def test_rewriting_changes_no_total_and_no_other_date(store, counts):
    for n in range(1, 6):
        store.add(counts(("a", 1, 1, n), ("b", 1, 1, n), ("b", 2, 1, 1)))
    before = _table(store)
    other = _files(store, "a")
    assert store.crowded_dates(files=5) == ["a", "b"] and store.crowded_dates(files=6) == []
    store.rewrite(["b"])
    assert _table(store) == before and store.read().count() == 5 + 2
    assert _files(store, "a") == other and len(_files(store, "b")) == 1
    store.add(counts(("b", 1, 1, 9)))
    assert ("b", 1, 1, 9) in _table(store)
    store.rewrite([])


def test_a_rewrite_that_fails_leaves_the_date(spark, store, counts):
    store.add(counts(("a", 1, 1, 1)))
    store.add(counts(("a", 1, 1, 2)))
    files = _files(store)
    files[0].write_bytes(b"no parquet file at all, so that the job fails")
    with pytest.raises(Exception):
        store.rewrite(["a"])
    assert _files(store) == files


def test_dates_are_pruned(store, counts):
    store.add(counts(("a", 1, 1, 1), ("b", 1, 1, 2)))
    frame = store.table(dates=["b"])
    assert frame.collect()[0].click_count == 2
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "date" in plan.split("PartitionFilters", 1)[1]


def test_users_are_kept_once(spark, tmp_path):
    store = blacklist_store(spark, str(tmp_path / "t"))
    for users in ([1, 2], [2], []):
        store.add(spark.createDataFrame([(u,) for u in users], AD_BLACKLIST))
    assert sorted(r.user_id for r in store.table().collect()) == [1, 2]


def test_work_dir(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    first, second = new_work_dir(spark, "a"), new_work_dir(spark, "a")
    assert first.startswith(root + "/a-") and first != second

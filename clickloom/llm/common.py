"""Names, written tables and encodings shared by the operators."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.session import new_work_dir


BATCH_BYTES = 8 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that ``df`` does not have yet, in any letter case."""
    taken = {c.lower() for c in df.columns}
    free = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        free.append(name)
    return free


def put(df: DataFrame, results: dict[str, Column]) -> DataFrame:
    """``df`` with result columns; one of its own columns by such a name is replaced."""
    new = {name.lower() for name in results}
    own = [df[c] for c in df.columns if c.lower() not in new]
    return df.select(*own, *[value.alias(name) for name, value in results.items()])


def full_text(text: str | Column) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def written(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared folder and read back: cut lineage, fixed row numbers."""
    folder = new_work_dir(df.sparkSession, purpose)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, after a bound on its session's Arrow batches unless the session has one.

    Spark's own bound of 64 MB is held several times in a task, by the JVM and by Python;
    tasks over long texts need no more than ``BATCH_BYTES`` at a time.
    """
    conf = df.sparkSession.conf
    if _BATCH_SETTING not in conf.getAll:
        conf.set(_BATCH_SETTING, BATCH_BYTES)
    return df


# drop what operators keep in a Python worker between tasks
HELD_TABLES: list[Callable[[], None]] = []


def settle(drop_tables: bool = False) -> None:
    """Give memory back to the system that a Python worker no longer uses.

    Spark uses workers again for later stages. ``drop_tables`` also drops the tables other
    operators keep there, for operators that keep none.
    """
    if drop_tables:
        for drop in HELD_TABLES:
            drop()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def join_hot(left: DataFrame, right: DataFrame, *key: str, how: str = "inner") -> DataFrame:
    """Join with a table of one row per key where one key may hold most of the left rows.

    The adaptive skew join splits such a key only if both sides were shuffled for the join.
    A table aggregated by the key is not, its partitioning is used again. The join is
    therefore on the key and a number made from it, which no side is partitioned by.
    """
    (part,) = fresh(left, "part")
    number = F.pmod(F.xxhash64(*[F.col(k) for k in key]), F.lit(2))
    return (
        left.withColumn(part, number)
        .join(right.withColumn(part, number), [*key, part], how)
        .drop(part)
    )


def byte_chunks(
    column: pa.Array | pa.ChunkedArray, most: int = 1 << 22
) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """UTF-8 bytes of a text column without copies into Python strings, nulls as empty.

    Yields (bytes, offsets from 0, first row) for runs of rows of about ``most`` bytes; a
    longer text is a run of its own.
    """
    chunks = column.chunks if isinstance(column, pa.ChunkedArray) else [column]
    row = 0
    for chunk in chunks:
        texts = chunk.cast(pa.large_string()).fill_null("")
        if not len(texts):
            continue
        _, spots, data = texts.buffers()
        offsets = np.frombuffer(spots, np.int64)[texts.offset : texts.offset + len(texts) + 1]
        raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        at = 0
        while at < len(texts):
            end = int(np.searchsorted(offsets, offsets[at] + most, side="right")) - 1
            end = min(max(end, at + 1), len(texts))
            cut = offsets[at : end + 1]
            yield raw[cut[0] : cut[-1]], cut - cut[0], row + at
            at = end
        row += len(texts)

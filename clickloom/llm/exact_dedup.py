"""Exact deduplication: a filter over hash slots first, a shuffle only of what may repeat.

Pass one counts, for two slots of every text's hash, how many rows fall there, and keeps a
bit for each slot met more than once. A text whose slots do not both have their bit occurs
once for certain. Pass two tests every row against the bits: rows that occur once pass
straight through, the others are grouped by SHA-256. A false alarm only costs its shuffle.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import fresh, full_text, join_hot, put, settle, small_batches, written

# the least and greatest number of filter bits, as powers of two: 128 kB and 128 MB
LEAST_BITS, MOST_BITS = 20, 30
# filter bits for each row; two slots of a row then meet others in about one of 70 rows
ROW_BITS = 16


def slot_bits_for(rows: int) -> int:
    """Bits of the filter for ``rows`` rows, as a power of two, between the two bounds."""
    return min(MOST_BITS, max(LEAST_BITS, (ROW_BITS * rows - 1).bit_length()))


def _slots(text: Column, slot_bits: int) -> tuple[Column, Column]:
    first = F.xxhash64(text)
    mask = F.lit((1 << slot_bits) - 1)
    return first.bitwiseAND(mask), F.xxhash64(first, F.lit(1)).bitwiseAND(mask)


def repeated_slots(docs: DataFrame, text: Column, slot_bits: int) -> np.ndarray:
    """Bits, in 64-bit words, of the hash slots that more than one row falls into.

    What reaches the driver has at most ``2 ** slot_bits / 64`` words, whatever the input.
    """
    slot, word, bits = F.col("slot"), F.col("word"), F.col("bits")
    rows = (
        docs.select(F.explode(F.array(*_slots(text, slot_bits))).alias("slot"))
        .groupBy("slot")
        .count()
        .where(F.col("count") > 1)
        .select(
            F.shiftright(slot, 6).alias("word"),
            F.expr("shiftleft(1L, cast(slot & 63 AS int))").alias("bits"),
        )
        .groupBy("word")
        .agg(F.bit_or("bits").alias("bits"))
        .select(word, bits)
        .toArrow()
    )
    words = np.zeros(max(1, (1 << slot_bits) // 64), np.int64)
    words[rows.column("word").to_numpy()] = rows.column("bits").to_numpy()
    return words


def may_repeat(docs: DataFrame, text: Column, slot_bits: int | None = None) -> Column:
    """True for every row whose text occurs again, and for few others.

    Without ``slot_bits`` the rows are counted and :func:`slot_bits_for` sizes the filter.
    """
    if slot_bits is None:
        slot_bits = slot_bits_for(docs.count())
    held = docs.sparkSession.sparkContext.broadcast(repeated_slots(docs, text, slot_bits))

    @F.pandas_udf("boolean")
    def test(one: pd.Series, two: pd.Series) -> pd.Series:
        settle(drop_tables=True)
        words, hit = held.value, True
        for slots in (one.to_numpy(np.int64), two.to_numpy(np.int64)):
            hit &= (words[slots >> 6] >> (slots & 63)) & 1 == 1
        return pd.Series(hit)

    return test(*_slots(text, slot_bits))


def exact_dedup(
    docs: DataFrame,
    text: str = "text",
    id_col: str = "doc_id",
    normal: Callable[[Column], Column] | None = None,
    slot_bits: int | None = None,
) -> DataFrame:
    """Every row of ``docs`` with ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Of rows whose texts are equal, after ``normal`` if given, the one with the largest id
    is kept. A null text is an empty text. A null id is below every other; if it is all a
    group has, its ``keep_id`` is null. Of rows that repeat the largest id exactly one is
    kept. An empty table gives an empty table. Columns of ``docs`` named like a result
    are replaced, others stay.

    The filter has ``2 ** slot_bits`` bits, without ``slot_bits`` about 16 for each row, but
    128 MB at most. That tells rows apart well up to some 67 million of them; beyond, ever
    more rows shuffle, up to all of them, and the result is the same. ``slot_bits`` of 33,
    1 GB held by the driver and each Python worker, serve half a billion rows.
    """
    value = full_text(text)
    value = normal(value) if normal else value
    digest, flag, place, best, size = fresh(docs, "digest", "flag", "place", "best", "size")
    tested = small_batches(docs).withColumn(flag, may_repeat(docs, value, slot_bits))

    once = put(
        tested.where(~F.col(flag)).drop(flag),
        {
            "keep_id": F.col(id_col),
            "group_size": F.lit(1).cast("long"),
            "kept": F.lit(True),
            "text_sha256": F.sha2(value, 256),
        },
    )
    again = written(
        tested.where(F.col(flag))
        .drop(flag)
        .withColumns({digest: F.sha2(value, 256), place: F.monotonically_increasing_id()}),
        "exact-dedup",
    )
    groups = again.groupBy(digest).agg(
        F.max(F.struct(F.col(id_col).alias("id"), F.col(place).alias("place"))).alias(best),
        F.count("*").alias(size),
    )
    found = join_hot(again, groups, digest)
    found = put(
        found,
        {
            "keep_id": found[best]["id"],
            "group_size": found[size],
            "kept": found[place] == found[best]["place"],
            "text_sha256": found[digest],
        },
    ).drop(digest, place, best, size)
    return once.unionByName(found.select(once.columns))

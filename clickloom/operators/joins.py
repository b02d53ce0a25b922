"""Keeping or dropping rows by a list of keys when one key may hold most of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keep_or_drop(
    rows: DataFrame, ids: DataFrame, key: str, how: str, salts: int = 1
) -> DataFrame:
    """``left_semi`` or ``left_anti`` join of ``rows`` with the keys in ``ids``.

    The adaptive skew join splits a hot key only when both inputs were shuffled for the
    join itself. A list that comes out of an aggregation by the key is not: its
    partitioning is reused. So the join is on the key and a part number made from it, which
    no input is partitioned by yet. That costs a shuffle of the list, one column wide.

    ``salts`` above 1 is for sessions without adaptive execution: every listed key is
    repeated that often, and the rows of a key are spread over the repeats by their content.

    The list is broadcast only when the optimizer knows it to be small.
    """
    ids = ids.select(key)
    if salts == 1:
        ids = ids.withColumn("_part", _part(F.col(key), 2))
        rows = rows.withColumn("_part", _part(F.col(key), 2))
    else:
        ids = ids.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        rows = rows.withColumn("_part", _part(F.struct(*rows.columns), salts))
    return rows.join(ids, [key, "_part"], how).drop("_part")


def _part(c: Column, parts: int) -> Column:
    return F.pmod(F.xxhash64(c), F.lit(parts)).cast("int")

"""Near-duplicates by SimHash fingerprints, compared through tables of pivot distances.

A table made once holds, for each distinct fingerprint, its Hamming distances to ``PIVOTS``
fixed reference fingerprints, a byte each; the rows compared later carry them along. Two fingerprints within ``k`` bits differ by at most ``k`` in every one of these coordinates,
so a pair with a larger coordinate difference is discarded without looking at its bits;
survivors are verified.

For fingerprints of 64 nearly random bits a coordinate alone leaves over half of all pairs,
so coordinates cannot decide what is compared where. That is done by bits: ``k + t`` segments
hold ``k`` differing bits at most, so ``t`` of them are equal, and every choice of ``t``
segments is a bucket key. Within a bucket the pivot tables prune. A bucket of any size is cut
into blocks, and blocks are compared pairwise in tasks of bounded size. Only links that hold
groups together leave a task, never all pairs; groups are joined by repeated label steps.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType
from xxhash import xxh64_intdigest

from clickloom.llm.common import fresh, full_text, join_hot, put, settle, small_batches, written

SEED = 42
SHINGLE = 4
LIMIT = 4
PIVOTS = 16
BLOCK = 2048
_REFERENCES = np.random.default_rng(64).integers(0, 2**64, PIVOTS, dtype=np.uint64)


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """64-bit SimHash: a bit is 1 if it is set in over half the shingle hashes.

    Words are runs without ASCII white space, A-Z in lower case; a text of fewer words than
    a shingle is one shingle, one without words has fingerprint zero.
    """
    words = text.encode().lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        hashes = np.array([xxh64_intdigest(b" ".join(words), SEED)], np.uint64)
    else:
        runs = map(b" ".join, zip(*[words[i:] for i in range(shingle)]))
        hashes = np.fromiter(
            map(xxh64_intdigest, runs, repeat(SEED)), np.uint64, len(words) - shingle + 1
        )
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 4096):
        part = hashes[at : at + 4096].astype("<u8", copy=False).view(np.uint8).reshape(-1, 8)
        bits = np.unpackbits(part, axis=1, bitorder="little")
        # sums of up to 255 rows fit in a byte, which keeps the addition narrow
        for low in range(0, len(bits), 255):
            counts += np.add.reduce(bits[low : low + 255], axis=0, dtype=np.uint8)
    ones = np.packbits(counts * 2 > len(hashes), bitorder="little")
    return int(ones.view("<u8")[0])


@F.pandas_udf(LongType())
def _prints(texts: pd.Series) -> pd.Series:
    settle(drop_tables=True)
    prints = np.fromiter(map(fingerprint, texts), np.uint64, len(texts))
    return pd.Series(prints.view(np.int64))


def with_fingerprints(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``fingerprint``, 16 lower-case hexadecimal digits; null is empty text."""
    digits = F.lower(F.lpad(F.hex(_prints(full_text(text))), 16, "0"))
    return put(small_batches(docs), {"fingerprint": digits})


def segments(bits: int, parts: int) -> list[tuple[int, int]]:
    """(first bit, length) of ``parts`` nearly equal segments."""
    edges = [round(i * bits / parts) for i in range(parts + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def equal_segments(rows: int, limit: int = LIMIT) -> int:
    """How many segments a bucket key has: enough for about one fingerprint in a bucket.

    At least two, so that small and large inputs go the same way; the links are the same
    for any number.
    """
    t = 2
    while t < 6 and rows > 2 ** (64 * t / (limit + t) + 3):
        t += 1
    return t


def bucketed(prints: DataFrame, t: int, limit: int = LIMIT) -> DataFrame:
    """Every row of ``prints`` once per choice of ``t`` segments, with ``choice`` and ``key``."""
    parts = segments(64, limit + t)
    keys = []
    for choice, chosen in enumerate(combinations(parts, t)):
        mask = sum(((1 << n) - 1) << at for at, n in chosen)
        signed = mask - (1 << 64) if mask >= 1 << 63 else mask
        keys.append(
            F.struct(
                F.lit(choice).alias("choice"), F.col("fp").bitwiseAND(F.lit(signed)).alias("key")
            )
        )
    return prints.select("*", F.explode(F.array(*keys)).alias("b")).select("b.*", *prints.columns)


def pivot_distances(prints: np.ndarray) -> np.ndarray:
    """Hamming distances to the references, one row of coordinates per fingerprint."""
    return np.bitwise_count(prints[:, None] ^ _REFERENCES[None, :]).astype(np.int8)


@F.arrow_udf(BinaryType())
def _pivots(prints: pa.Array) -> pa.Array:
    table = pivot_distances(prints.to_numpy(zero_copy_only=False).view(np.uint64))
    rows = pa.Array.from_buffers(pa.binary(PIVOTS), len(table), [None, pa.py_buffer(table)])
    return rows.cast(pa.binary())


def with_pivots(prints: DataFrame) -> DataFrame:
    """``prints`` with ``pivots``, the distances of ``fp`` to the references, a byte each."""
    return prints.withColumn("pivots", _pivots("fp"))


def _table(pivots: pa.Array) -> np.ndarray:
    """The distances held in a column ``pivots``, one row of coordinates per fingerprint."""
    fixed = pivots.cast(pa.binary(PIVOTS))
    held = np.frombuffer(fixed.buffers()[1], np.int8).reshape(-1, PIVOTS)
    return held[fixed.offset : fixed.offset + len(fixed)]


def near(
    one: int, table: np.ndarray, prints: np.ndarray, among: np.ndarray, limit: int
) -> np.ndarray:
    """Which rows ``among`` lie within ``limit`` bits of row ``one``."""
    for first in range(0, PIVOTS, 4):
        cut = slice(first, first + 4)
        apart = np.abs(table[among, cut] - table[one, cut]).max(axis=1)
        among = among[apart <= limit]
        if not len(among):
            return among
    return among[np.bitwise_count(prints[among] ^ prints[one]) <= limit]


def links_within(
    prints: np.ndarray, limit: int = LIMIT, table: np.ndarray | None = None
) -> list[tuple[int, int]]:
    """Links that join all fingerprints of one group: (smallest of the group, member).

    ``table`` has the pivot distances of ``prints``; without it they are computed here.

    Groups are grown from a seed; what is found is no longer compared, so a dense group
    costs about as much as its size, and only unlike fingerprints meet each other.
    """
    table = pivot_distances(prints) if table is None else table
    free, links = np.arange(len(prints)), []
    while len(free):
        seed, free = free[0], free[1:]
        group, edge = [seed], [seed]
        while edge and len(free):
            hit = near(edge.pop(), table, prints, free, limit)
            if len(hit):
                free = np.setdiff1d(free, hit, assume_unique=True)
                group += hit.tolist()
                edge += hit.tolist()
        signed = prints[group].view(np.int64)
        low = int(signed.min())
        links += [(low, int(x)) for x in signed if x != low]
    return links


def _link_batches(limit: int):
    """Links of all tasks of a partition sorted by task; a task may span batches."""

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links(prints: np.ndarray, table: np.ndarray, starts: np.ndarray) -> pa.RecordBatch:
            found: list[tuple[int, int]] = []
            sizes = np.diff(starts)
            pair = starts[:-1][sizes == 2]
            if len(pair):
                # most tasks hold two fingerprints: all of them at once
                one, two = prints[pair], prints[pair + 1]
                apart = np.abs(table[pair] - table[pair + 1]).max(axis=1)
                close = np.flatnonzero(apart <= limit)
                close = close[np.bitwise_count(one[close] ^ two[close]) <= limit]
                a, b = one[close].view(np.int64), two[close].view(np.int64)
                found += zip(np.minimum(a, b).tolist(), np.maximum(a, b).tolist())
            for at in np.flatnonzero(sizes > 2):
                cut = slice(starts[at], starts[at + 1])
                some, rows = np.unique(prints[cut], return_index=True)
                found += links_within(some, limit, table[cut][rows])
            a, b = zip(*found) if found else ((), ())
            return pa.RecordBatch.from_arrays(
                [pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"]
            )

        left: tuple[np.ndarray, ...] = ()
        for batch in batches:
            if not batch.num_rows:
                continue
            now = tuple(
                batch.column(name).to_numpy(zero_copy_only=False)
                for name in ("choice", "key", "blocks", "fp")
            )
            now += (_table(batch.column("pivots")),)
            now = tuple(np.concatenate(x) for x in zip(left, now)) if left else now
            differs = np.zeros(len(now[0]), bool)
            for values in now[:3]:
                differs[1:] |= values[1:] != values[:-1]
            starts = np.concatenate([[0], np.flatnonzero(differs)])
            # the last task may go on in the next batch
            left = tuple(x[starts[-1] :] for x in now)
            yield links(now[3].view(np.uint64), now[4], starts)
        if left:
            yield links(left[3].view(np.uint64), left[4], np.array([0, len(left[3])]))

    return mapped


def near_links(prints: DataFrame, limit: int = LIMIT, block: int = BLOCK) -> DataFrame:
    """(a, b): links between distinct fingerprints ``fp`` that join every group.

    The pivot table is written once; each bucket reads the distances from it.
    """
    pivoted = written(with_pivots(prints.select("fp")), "simhash-pivots")
    t = equal_segments(pivoted.count(), limit)
    rows = bucketed(pivoted, t, limit)
    sizes = bucketed(pivoted.select("fp"), t, limit).groupBy("choice", "key").count().where("count > 1")
    tasks = join_hot(rows, sizes, "choice", "key").withColumn(
        "n", F.ceil(F.col("count") / block).cast("int")
    )
    # block i of a bucket meets every block, itself included, in the task named by the pair
    own = F.pmod(F.xxhash64("fp"), F.col("n")).cast("int")
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("n") - 1),
        lambda j: F.least(own, j) * F.col("n") + F.greatest(own, j),
    )
    tasks = tasks.select("choice", "key", "fp", "pivots", F.explode(pairs).alias("blocks"))
    return (
        tasks.repartition("choice", "key", "blocks")
        .sortWithinPartitions("choice", "key", "blocks")
        .mapInArrow(_link_batches(limit), "a long, b long")
        .distinct()
    )


def components(links: DataFrame) -> DataFrame:
    """(fp, root): the smallest fingerprint reachable, for every fingerprint with a link.

    In each round every node points all its larger neighbours to its smallest one, then its
    smaller ones too; the number of rounds grows with the logarithm of the longest chain. A
    node with very many neighbours is grouped by partial minima, its list is never built.
    """

    def star(edges: DataFrame, larger: bool) -> DataFrame:
        both = edges.union(edges.select("b", "a")) if larger else edges.select("b", "a")
        both = both.toDF("node", "other")
        least = both.groupBy("node").agg(F.min("other").alias("low"))
        least = least.withColumn("low", F.least("node", "low"))
        met = join_hot(both, least, "node")
        if larger:
            out = met.where("other > node").selectExpr("low AS a", "other AS b")
        else:
            out = met.selectExpr("low AS a", "other AS b").union(
                least.selectExpr("low AS a", "node AS b")
            )
        return out.where("a <> b").distinct()

    def state(edges: DataFrame) -> Row:
        return edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()

    edges, before = links, None
    while (now := state(edges)) != before:
        before = now
        edges = written(star(star(edges, True), False), "simhash-links")
    return edges.select(F.col("b").alias("fp"), F.col("a").alias("root")).union(
        edges.select("a", "a").distinct()
    )


def with_components(
    printed: DataFrame, id_col: str = "doc_id", limit: int = LIMIT, block: int = BLOCK
) -> DataFrame:
    """Every row of ``printed``, which has a ``fingerprint``, with ``component_id``.

    The rows are written once, as fingerprints are dear; drop what is not needed before.
    """
    fp, low = fresh(printed, "fp", "low")
    rows = written(printed, "simhash-rows")
    signed = F.conv("fingerprint", 16, -10).cast("long")
    classes = written(
        rows.groupBy(signed.alias("fp")).agg(F.min(id_col).alias("low")), "simhash-classes"
    )
    links = written(near_links(classes.select("fp"), limit, block), "simhash-links")
    linked = classes.join(components(links), "fp")
    lowest = linked.groupBy("root").agg(F.min("low").alias("lowest"))
    merged = join_hot(linked, lowest, "root").select("fp", "lowest")
    found = classes.join(merged, "fp", "left").select(
        F.col("fp").alias(fp), F.coalesce("lowest", "low").alias(low)
    )
    joined = join_hot(rows.withColumn(fp, signed), found, fp)
    return put(joined, {"component_id": joined[low]}).drop(fp, low)


def simhash_dedup(
    docs: DataFrame,
    text: str = "text",
    id_col: str = "doc_id",
    limit: int = LIMIT,
    block: int = BLOCK,
) -> DataFrame:
    """Every row of ``docs`` with ``fingerprint`` and ``component_id``.

    ``fingerprint`` is 16 lower-case hexadecimal digits. Fingerprints that differ in at most
    ``limit`` bits are linked; ``component_id`` is the smallest id reachable over links, the
    row's own included. Nulls count as empty texts, whose fingerprint is zero and is linked
    like any other. Null ids are ignored unless a component has no other, then it is null.
    Rows that repeat each other share their component. An empty table gives an empty table.
    Columns named like a result are replaced.
    """
    return with_components(with_fingerprints(docs, text), id_col, limit, block)

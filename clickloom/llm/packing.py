"""Best-fit packing of tokenised documents, certified by lower bounds.

Pieces shorter than a sequence are dealt into partitions, and each is packed best-fit
decreasing. Dual feasible functions give a lower bound on the bins of any packing. In each
round two neighbouring partitions meet: if their bins reach the bound of all their pieces,
their packing is certified and stays, else they exchange documents, the pieces are packed
again together and the better packing stays. After the last round a task has seen
``2 ** rounds`` partitions, a bounded number of (row, length) pairs whatever the input.
"""

from __future__ import annotations

import zlib
from itertools import count

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.bytebpe import byte_bpe
from clickloom.llm.common import fresh, full_text, put, settle, small_batches, written

CAPACITY = 2048
PART_PIECES = 4096
ROUNDS = 3
END_ID = 0

PIECES = "array<struct<piece:int,start:bigint,length:bigint,ids_crc32:bigint>>"
PACKED = "place long, length long, part long, bin long, offset long"


def tokenised_pieces(
    docs: DataFrame, path: str, text: str = "text", capacity: int = CAPACITY
) -> DataFrame:
    """One row per piece of every document: its columns but ``text``, and the piece's.

    Ids are those of the library; the text of an added token of the vocabulary is that token.
    A document's ids are followed by ``END_ID``. One of more than ``capacity`` ids is cut
    into pieces of that many; what does not fill a piece comes first.
    """
    (done,) = fresh(docs, "done")

    @F.pandas_udf(PIECES)
    def cut(texts: pd.Series) -> pd.Series:
        bpe, out = byte_bpe(path, added=True), []
        for value in texts:
            ids = bpe.encode(value) + END_ID.to_bytes(4, "little")
            total = len(ids) // 4
            edges = [0, *range(total % capacity or capacity, total + 1, capacity)]
            out.append(
                [
                    (i, a, b - a, zlib.crc32(ids[4 * a : 4 * b]))
                    for i, (a, b) in enumerate(zip(edges, edges[1:]))
                ]
            )
        settle()
        return pd.Series(out)

    rows = small_batches(docs).select(
        *[docs[c] for c in docs.columns if c != text],
        F.explode(cut(full_text(docs[text]))).alias(done),
    )
    names = ("piece", "start", "length", "ids_crc32")
    return put(rows, {n: rows[done][n] for n in names}).drop(done)


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Bins that any packing of ``lengths`` needs at least.

    The best of two families of dual feasible functions: one counts long pieces as whole
    bins and leaves out those that fit beside them, the other rounds to fractions of a bin.
    """
    sizes, times = np.unique(lengths, return_counts=True)
    if not len(sizes):
        return 0
    best = -(-int((sizes * times).sum()) // capacity)
    # where this bound changes, its limit is the length of a piece or its complement
    for least in np.unique(np.minimum(sizes, capacity - sizes)).tolist():
        value = np.where(sizes > capacity - least, capacity, np.where(sizes < least, 0, sizes))
        best = max(best, -(-int((value * times).sum()) // capacity))
    for k in range(1, 21):
        whole, rest = np.divmod((k + 1) * sizes, capacity)
        value = np.where(rest == 0, sizes * k, whole * capacity)
        best = max(best, -(-int((value * times).sum()) // (k * capacity)))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each length: longest first, into the fullest bin that has room."""
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    room: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_rooms, fresh_bins = 0, count()
    for i in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[i])
        fits = open_rooms >> length
        if fits:
            left = length + (fits & -fits).bit_length() - 1
            target = room[left].pop()
            if not room[left]:
                open_rooms &= ~(1 << left)
        else:
            left, target = capacity, next(fresh_bins)
        bins[i], offsets[i] = target, capacity - left
        left -= length
        if left:
            room[left].append(target)
            open_rooms |= 1 << left
    return bins, offsets


def pack_pieces(
    pieces: DataFrame,
    capacity: int = CAPACITY,
    part_pieces: int = PART_PIECES,
    rounds: int = ROUNDS,
) -> DataFrame:
    """(place, sequence_id, offset) for rows (place, length) shorter than ``capacity``."""
    total = pieces.count()
    parts = max(1, -(-total // part_pieces))

    def first(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("place", ignore_index=True)
        frame["bin"], frame["offset"] = best_fit_decreasing(frame["length"].to_numpy(), capacity)
        return frame[columns]

    def exchange(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("place", ignore_index=True)
        lengths = frame["length"].to_numpy()
        frame["bin"] = frame.groupby(["part", "bin"], sort=True).ngroup()
        frame["part"] //= 2
        used = frame["bin"].max() + 1
        if used > lower_bound(lengths, capacity):
            bins, offsets = best_fit_decreasing(lengths, capacity)
            if bins.max() + 1 < used:
                frame["bin"], frame["offset"] = bins, offsets
        return frame[columns]

    columns = ["place", "length", "part", "bin", "offset"]
    dealt = pieces.withColumn("part", F.pmod(F.xxhash64("place"), F.lit(parts)))
    packed = dealt.groupBy("part").applyInPandas(first, PACKED)
    for _ in range(rounds):
        half = F.shiftright("part", 1)
        packed = written(packed, "packed").groupBy(half).applyInPandas(exchange, PACKED)
    # partition and bin in one number, even; whole pieces have odd ones
    number = F.col("part") * 2**21 + F.col("bin") * 2
    return packed.select("place", number.alias("sequence_id"), "offset")


def pack_documents(
    docs: DataFrame,
    path: str | None = None,
    text: str = "text",
    capacity: int = CAPACITY,
    part_pieces: int = PART_PIECES,
    rounds: int = ROUNDS,
) -> DataFrame:
    """Every piece of every document with its ``sequence_id`` and ``offset``.

    Rows have the columns of ``docs`` but ``text``, then ``piece``, ``start``, ``length``,
    ``ids_crc32`` (of the ids as unsigned little-endian 32-bit numbers), ``sequence_id``
    and ``offset``; columns named like these are replaced. A sequence is filled from 0
    without gaps and holds at most ``capacity`` tokens. A null text is an empty one: one
    piece that holds only the end id. Rows that repeat each other are packed each. An
    empty table gives an empty table.
    """
    path = path or public_tokenizers.path("byte_bpe_50k.json")
    pieces = tokenised_pieces(docs, path, text, capacity)
    place, sequence, offset = fresh(pieces, "place", "seq", "off")
    pieces = written(pieces.withColumn(place, F.monotonically_increasing_id()), "pieces")
    whole = F.col("length") == capacity
    single = put(
        pieces.where(whole),
        {"sequence_id": F.col(place) * 2 + 1, "offset": F.lit(0).cast("long")},
    ).drop(place)
    rest = pieces.where(~whole)
    packed = pack_pieces(
        rest.select(F.col(place).alias("place"), "length"), capacity, part_pieces, rounds
    ).toDF(place, sequence, offset)
    joined = rest.join(packed, place)
    shared = put(joined, {"sequence_id": joined[sequence], "offset": joined[offset]}).drop(
        place, sequence, offset
    )
    return single.unionByName(shared.select(single.columns))

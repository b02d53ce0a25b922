"""Hard negatives by the method of the Four Russians.

Scores are inner products of vectors of whole numbers. A candidate is kept as bit planes: byte
``g`` of plane ``k`` holds bit ``k`` of eight neighbouring dimensions. For each anchor and each
group of eight dimensions a table holds the sums of all 256 subsets of the anchor's eight
numbers; a byte of a plane is an index into it. Looked up, added over the groups and shifted
in plane by plane, with the plane of signs subtracted, that is the exact score.

Anchors are a stated query set: they meet all rows in blocks. A block of ``HELD`` anchors goes
to every task, whatever the input; a task holds the tables of ``GROUP`` anchors at a time, goes
through its candidates and keeps for each anchor the best so far, so neither scores nor pairs
leave it. First the best rows of the anchor's own label are found, then, with their scores
known, the best rows of other labels in the window of each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickloom.llm.common import small_batches, written
from clickloom.llm.whitening import usable

SCALE = 256
POSITIVES = 5
NEGATIVES = 5
# a negative scores at least LEAST of HUNDRED parts of the positive's score, and MOST at most
LEAST, MOST, HUNDRED = 80, 100, 100
HELD = 4096
GROUP = 512
CHUNK = 1024
NO_ID = 2**63 - 1
_SIGNED = "place long, id long, label long, planes binary"


def packed_planes(numbers: np.ndarray, planes: int) -> np.ndarray:
    """Bit planes of rows of whole numbers: (rows, planes, groups of eight) bytes.

    Numbers are in two's complement, the last plane holds the signs.
    """
    rows, width = numbers.shape
    padded = np.zeros((rows, -(-width // 8) * 8), np.int64)
    padded[:, :width] = numbers
    bits = (padded[:, None, :] >> np.arange(planes)[None, :, None]) & 1
    return np.packbits(bits.astype(np.uint8), axis=2, bitorder="little")


def unpacked(planes: np.ndarray) -> np.ndarray:
    """The whole numbers of packed planes, zero-padded to groups of eight."""
    bits = np.unpackbits(planes, axis=2, bitorder="little").astype(np.int64)
    weight = np.int64(1) << np.arange(planes.shape[1], dtype=np.int64)
    weight[-1] = -weight[-1]
    return np.einsum("rpd,p->rd", bits, weight)


def subset_sums(anchors: np.ndarray, kind: type = np.int64) -> np.ndarray:
    """(groups, 256, anchors): for each byte the sum of the anchor's numbers at its bits."""
    width = anchors.shape[1] // 8
    tables = np.zeros((width, 256, len(anchors)), kind)
    groups = anchors.reshape(len(anchors), width, 8).transpose(1, 2, 0)
    for bit in range(8):
        # each table of so many bits is repeated with the next number added
        tables[:, 1 << bit : 2 << bit] = tables[:, : 1 << bit] + groups[:, bit, None, :]
    return tables


def scores(tables: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """(candidates, anchors): exact inner products, looked up plane by plane."""
    total = np.zeros((len(planes), tables.shape[2]), tables.dtype)
    top = planes.shape[1] - 1
    for plane in range(top, -1, -1):
        looked = np.zeros_like(total)
        for group in range(tables.shape[0]):
            looked += tables[group][planes[:, plane, group]]
        # the plane of signs comes first and counts negative
        total = (total << 1) + looked if plane < top else -looked
    return total


class _Best:
    """The best ``most`` rows of each of ``slots`` so far; ties by id, then by place."""

    def __init__(self, slots: int, most: int) -> None:
        self.most = most
        # the last of the best: rows that score less, or as much with a greater id, are out
        self.floor = np.full(slots, np.iinfo(np.int64).min)
        self.floor_id = np.full(slots, NO_ID)
        self.rows = np.zeros((4, 0), np.int64)  # slot, score, id, place

    def add(self, slot: np.ndarray, score: np.ndarray, ident: np.ndarray, place: np.ndarray) -> None:
        may = (score > self.floor[slot]) | (ident <= self.floor_id[slot])
        if not may.any():
            return
        new = np.stack([slot, score, ident, place])[:, may]
        rows = np.concatenate([self.rows, new], axis=1)
        rows = rows[:, np.lexsort((rows[3], rows[2], -rows[1], rows[0]))]
        starts = np.flatnonzero(np.r_[True, rows[0, 1:] != rows[0, :-1]])
        rank = np.arange(rows.shape[1]) - np.repeat(starts, np.diff(np.r_[starts, rows.shape[1]]))
        self.rows = rows[:, rank < self.most]
        last = rows[:, rank == self.most - 1]
        self.floor[last[0]], self.floor_id[last[0]] = last[1], last[2]


def _planes(column: pa.Array, planes: int) -> np.ndarray:
    size = len(column)
    raw = np.frombuffer(b"".join(column.to_pylist()), np.uint8)
    return raw.reshape(size, planes, -1)


def prepared(
    vectors: DataFrame,
    vector: str = "embedding",
    id_col: str = "vec_id",
    label: str = "label",
) -> tuple[DataFrame, int, bool]:
    """(rows, planes, whether scores fit 32 bits) of the vectors that take part, written once.

    A row has a ``place`` of its own, ``id``, ``label`` and ``planes``.
    """
    kept = vectors.where(usable(F.col(vector)) & F.col(label).isNotNull())

    def whole(c):
        return F.floor(c.cast("double") * SCALE)

    numbers = F.transform(vector, whole)
    chosen = kept.select(
        F.monotonically_increasing_id().alias("place"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"),
        F.col(label).cast("long").alias("label"),
        numbers.alias("x"),
    )
    size = F.size("x")
    low, high, least, most = chosen.agg(
        F.min(size), F.max(size), F.min(F.array_min("x")), F.max(F.array_max("x"))
    ).first()
    if low != high:
        raise ValueError(f"vectors of {low} and of {high} entries have no inner product")
    edge = max(abs(least or 0), abs(most or 0)) + 1
    width = -(-(high or 0) // 8) * 8
    if width * edge * edge >= 1 << 55:
        raise ValueError("scores of these vectors are too large")
    planes = edge.bit_length() + 1

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place, ident, kind, x = batch.columns
            table = x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1)
            found = packed_planes(table, planes) if len(x) else np.zeros((0, planes, 0), np.uint8)
            data = pa.array([row.tobytes() for row in found], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [place, ident, kind, data], ["place", "id", "label", "planes"]
            )

    rows = written(small_batches(chosen).mapInArrow(packed, _SIGNED), "negatives-rows")
    return rows, planes, 2 * width * edge * edge < 1 << 31


def _search(
    rows: DataFrame,
    anchors: dict[str, np.ndarray],
    planes: int,
    kind: type,
    windows: np.ndarray | None,
    most: int,
) -> DataFrame:
    """The best rows of each task for each anchor: ``slot``, ``score``, ``id``, ``place``.

    Without ``windows``, rows of the anchor's label but itself, a slot per anchor; with
    ``windows``, (anchors, windows) of positive scores, rows of other labels scored in a
    window, a slot per anchor and window. A window without a score holds nothing.
    """
    held = rows.sparkSession.sparkContext.broadcast((anchors, windows))
    count = len(anchors["place"])
    per = 1 if windows is None else windows.shape[1]

    def chunk(
        best: _Best, found: np.ndarray, cut: slice, ident: np.ndarray, label: np.ndarray, place: np.ndarray
    ) -> None:
        """Add what belongs into ``best`` from scores of a chunk of rows and a group of anchors."""
        known, wanted = held.value
        same = label[:, None] == known["label"][None, cut]
        numbers = np.arange(cut.start, cut.stop)
        for j in range(per):
            slots = numbers * per + j
            fits = found >= best.floor[slots]
            if wanted is None:
                fits &= same & (place[:, None] != known["place"][None, cut])
            else:
                fits &= ~same & (found <= wanted[cut, j])
            who, whom = np.nonzero(fits)
            score = found[who, whom].astype(np.int64)
            if wanted is not None:
                top = wanted[cut, j][whom]
                inside = (LEAST * top <= HUNDRED * score) & (HUNDRED * score <= MOST * top)
                who, whom, score = who[inside], whom[inside], score[inside]
            best.add(slots[whom], score, ident[who], place[who])

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, _ = held.value
        best = _Best(count * per, most)
        tables, of = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            place, ident, label = (
                batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)
            )
            bits = _planes(batch.column(3), planes)
            for first in range(0, count, GROUP):
                cut = slice(first, min(first + GROUP, count))
                if of != first:
                    tables, of = subset_sums(known["x"][cut], kind), first
                for at in range(0, len(place), CHUNK):
                    some = slice(at, at + CHUNK)
                    found = scores(tables, bits[some])
                    chunk(best, found, cut, ident[some], label[some], place[some])
        yield pa.RecordBatch.from_arrays([pa.array(r) for r in best.rows], names)

    names = ["slot", "score", "id", "place"]
    return rows.mapInArrow(mapped, ", ".join(f"{n} long" for n in names))


def _first(found: DataFrame, most: int) -> DataFrame:
    """The first ``most`` of each slot, with ``rank`` from 1."""
    order = Window.partitionBy("slot").orderBy(F.desc("score"), "id", "place")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def mine_hard_negatives(
    vectors: DataFrame,
    every: int = 100,
    vector: str = "embedding",
    id_col: str = "vec_id",
    label: str = "label",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    held: int = HELD,
) -> DataFrame:
    """Hard negatives of the rows whose id is divisible by ``every``.

    Entries become ``floor(256 * x)``; a row's score is its inner product with the anchor.
    Higher scores come first, ties by smaller id, then by place in the table. An anchor's
    positives are its first rows of the same label, itself left out; for each of them the
    first rows of other labels with a score of 80 to 100 of 100 parts of the positive's are
    returned: ``anchor_id``, ``positive_id``, ``rank`` from 1, ``negative_id``,
    ``positive_score``, ``negative_score``, and ``positive_rank``.

    Rows with a null label, a null vector or an entry that is null or not finite take no
    part. A null id is no anchor and above every other id, and null in the result; rows of
    equal id are rows of their own, so an anchor met twice is mined twice. Vectors of different
    lengths are an error, as are entries whose scores could reach 2^55. An empty table, or
    one without an anchor, gives no rows. Other columns are not read.

    The driver sees ``held`` anchors at a time with five places each; all of them go through
    all rows in one pass, twice. Work grows with anchors times rows.
    """
    rows, planes, narrow = prepared(vectors, vector, id_col, label)
    kind = np.int32 if narrow else np.int64
    anchors = rows.where((F.col("id") % every == 0) & (F.col("id") != NO_ID))
    rounds = -(-anchors.count() // held)
    schema = (
        "anchor_id long, positive_id long, positive_rank int, rank int, negative_id long,"
        " positive_score long, negative_score long"
    )
    spark = vectors.sparkSession
    done = [spark.createDataFrame([], schema)]
    for number in range(rounds):
        # blocks by a hash of the place: about ``held`` anchors, whatever ids repeat
        mine = F.pmod(F.xxhash64("place"), F.lit(rounds)) == number
        block = anchors.where(mine).toArrow()
        if not block.num_rows:
            continue
        known = {
            name: block.column(name).to_numpy() for name in ("place", "id", "label")
        } | {"x": unpacked(_planes(block.column("planes").combine_chunks(), planes))}
        own = _first(_search(rows, known, planes, kind, None, positives), positives).toArrow()
        slot, rank = (own.column(c).to_numpy() for c in ("slot", "rank"))
        # no window where an anchor has fewer positives: nothing scores this low
        low = np.iinfo(np.int64).min // 256
        tops = np.full((len(known["place"]), positives), low)
        tops[slot, rank - 1] = own.column("score").to_numpy()
        names = np.full(tops.shape, NO_ID)
        names[slot, rank - 1] = own.column("id").to_numpy()
        best = _first(_search(rows, known, planes, kind, tops, negatives), negatives)
        told = spark.createDataFrame(
            pa.table(
                {
                    "slot": np.arange(tops.size),
                    "anchor_id": np.repeat(known["id"], positives),
                    "positive_id": names.reshape(-1),
                    "positive_rank": np.tile(np.arange(1, positives + 1), len(tops)),
                    "positive_score": tops.reshape(-1),
                }
            )
        )
        found = best.join(told, "slot").select(
            "anchor_id",
            F.nullif("positive_id", F.lit(NO_ID)).alias("positive_id"),
            F.col("positive_rank").cast("int"),
            "rank",
            F.nullif("id", F.lit(NO_ID)).alias("negative_id"),
            "positive_score",
            F.col("score").alias("negative_score"),
        )
        done.append(written(found, "negatives-found"))
    result = done[0]
    for part in done[1:]:
        result = result.unionByName(part)
    return result

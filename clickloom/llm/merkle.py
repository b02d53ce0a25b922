"""Document fingerprints as Merkle trees.

A text is cut, without losing a character, into sections (ended by empty lines), paragraphs
(ended by line breaks) and clauses (ended by punctuation). A clause of more than ``LONG_CLAUSE``
bytes is cut once more, behind certain bytes that follow ``LEAST_STRETCH`` others, or after
``MOST_STRETCH``: what is cut depends on the words alone, so texts that share a long stretch
share its leaves. Every node has a digest of 16 bytes over its children's digests and what
stands between them, so equal roots mean equal texts, and two trees are compared from the root
down: branches of equal digest are skipped, and what is left are the paragraphs that were edited.

The fingerprint is the tree as text: ``root`` of 32 hexadecimal digits, then for each section
``/`` and 16 digits, for each of its paragraphs ``-`` and 16 digits, ``.`` and 8 digits for
each of its leaves.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StringType, StructType

from clickloom.llm.common import full_text, put, settle, small_batches, written

PART_BYTES = 8 << 20
MOST_RANGES = 1 << 16
SAMPLE = 64
LOWEST = -(2**63)

_SECTION = re.compile(r".*?(?:\n[ \t\r]*\n\s*|\Z)", re.S)
_CLAUSE = re.compile(r"([^.!?,;:]*)([.!?,;:\s]*)")

LONG_CLAUSE, LEAST_STRETCH, MOST_STRETCH = 64, 24, 192
# a stretch ends with a byte whose last three bits are 100
_ENDS = b"".join(re.escape(bytes([b])) for b in range(4, 256, 8))
_STRETCH = re.compile(
    b"[\\s\\S]{%d,%d}?[%s]|[\\s\\S]{1,%d}"
    % (LEAST_STRETCH, MOST_STRETCH - 1, _ENDS, MOST_STRETCH)
)


def _digest(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


def fingerprint(text: str) -> str:
    """The Merkle tree of a text as a string."""
    tops, out = [], []
    for section in filter(None, _SECTION.findall(text)):
        middles, below = [], []
        for paragraph in section.split("\n"):
            leaves, shown = [], []
            for words, end in _CLAUSE.findall(paragraph):
                raw = words.encode()
                for stretch in [raw] if len(raw) <= LONG_CLAUSE else _STRETCH.findall(raw):
                    leaf = _digest(b"l" + stretch)
                    leaves.append(leaf)
                    if stretch:
                        shown.append("." + leaf[:4].hex())
                leaves.append(b"e" + end.encode() + b"\0")
            node = _digest(b"p" + b"".join(leaves))
            middles.append(node)
            if shown:
                below.append("-" + node[:8].hex() + "".join(shown))
        node = _digest(b"s" + b"".join(middles))
        tops.append(node)
        out.append("/" + node[:8].hex() + "".join(below))
    return _digest(b"r" + b"".join(tops)).hex() + "".join(out)


def likeness(one: str, two: str) -> float:
    """Share of leaves two fingerprints have in common, 0 to 1; 1 if the roots are equal."""
    if one[:32] == two[:32]:
        return 1.0
    a, b = (Counter(re.findall(r"\.([0-9a-f]{8})", x)) for x in (one, two))
    total = a.total() + b.total()
    return 2 * (a & b).total() / total if total else 0.0


def edited_paragraphs(one: str, two: str) -> tuple[list[int], list[int]]:
    """Numbers of the paragraphs, of each text, that the other text does not have.

    Sections of equal digest are skipped as a whole. Paragraphs without words have no number.
    """
    if one[:32] == two[:32]:
        return [], []
    trees = [[part.split("-") for part in x.split("/")[1:]] for x in (one, two)]
    same = {s[0] for s in trees[0]} & {s[0] for s in trees[1]}
    known = [{p[:16] for s in tree for p in s[1:]} for tree in trees]
    found: tuple[list[int], list[int]] = ([], [])
    for tree, other, numbers in zip(trees, reversed(known), found):
        at = 0
        for section, *paragraphs in tree:
            if section not in same:
                numbers += [at + i for i, p in enumerate(paragraphs) if p[:16] not in other]
            at += len(paragraphs)
    return found


@F.pandas_udf(StringType())
def _fingerprints(texts: pd.Series) -> pd.Series:
    return texts.map(fingerprint)


def fingerprint_documents(docs: DataFrame, text: str = "text") -> DataFrame:
    """Every row of ``docs`` with ``fingerprint``; a null text counts as an empty one.

    Rows that repeat each other have equal fingerprints. An empty table gives an empty
    table. A column of ``docs`` called ``fingerprint`` is replaced.
    """
    return put(small_batches(docs), {"fingerprint": _fingerprints(full_text(text))})


def edited_rows(rows: list[tuple[int | None, str, str]]) -> list[tuple]:
    """Fingerprints of texts and of their edits, for (id, text, next text) in order.

    The edit puts the beginning of the next text in place of the second half. Gives (id,
    code points, SHA-256 of the edit, both fingerprints, likeness to the edit and to the
    next text).
    """
    out, known = [], {}
    for ident, text, following in rows:
        half = len(text) // 2
        edit = text[: len(text) - half] + following[:half]
        own = known.get(text) or fingerprint(text)
        other = fingerprint(following)
        known = {following: other}
        changed = own if edit == text else fingerprint(edit)
        digest = hashlib.sha256(edit.encode()).hexdigest()
        near = likeness(own, changed), likeness(own, other)
        out.append((ident, len(text), digest, own, changed, *near))
    return out


def map_with_next(
    docs: DataFrame,
    rows: Callable[[list[tuple[int, str, str]]], list[tuple]],
    schema: str,
    text: str = "text",
    id_col: str = "doc_id",
    part_bytes: int = PART_BYTES,
    most_ranges: int = MOST_RANGES,
) -> DataFrame:
    """``rows`` applied to (id, text, next text) of every row, next by descending id.

    The last row is followed by the first; one row alone follows itself. A null text is
    empty. A null id counts as the smallest number and is null in the result. Rows of equal
    id are ordered by a hash of their text; rows that repeat each other follow each other.

    Texts are shuffled once, into ranges of (id, hash) of about ``part_bytes``, so neither
    a frequent id nor a null id makes a large range. There are ``most_ranges`` of them at most;
    beyond that many they grow, which costs a task a longer sort on disk and no more memory.
    The first row of each range is also sent to the end of the range before. The driver sees
    ``SAMPLE`` keys and one head per range, 67 MB of keys at most, and each task all heads and
    edges, 4 MB at most.
    """
    value = full_text(text)
    keyed = small_batches(docs).select(
        F.col(id_col).cast("long").alias("id"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(LOWEST)).alias("k"),
        F.xxhash64(value).alias("h"),
        value.alias("text"),
    )
    keys = written(keyed.select("k", "h", F.octet_length("text").alias("n")), "merkle-keys")
    total, size = keys.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    parts = max(1, min(total, -(-size // part_bytes), most_ranges))
    share = min(1.0, SAMPLE * parts / max(total, 1))
    sample = keys.sample(share, 1).select("k", "h").toArrow()
    edges = np.sort(_order(*[sample.column(c).to_numpy() for c in ("k", "h")]))
    edges = edges[[len(edges) * i // parts for i in range(1, parts)]] if len(edges) else edges

    def part_of(k: pd.Series, h: pd.Series) -> np.ndarray:
        # ranges are numbered from the greatest ids on
        return len(edges) - np.searchsorted(edges, _order(k.to_numpy(), h.to_numpy()), "right")

    @F.pandas_udf("int")
    def number(k: pd.Series, h: pd.Series) -> pd.Series:
        return pd.Series(part_of(k, h).astype(np.int32))

    tops = keys.groupBy(number("k", "h").alias("part")).agg(F.max(F.struct("k", "h")).alias("top"))
    heads = tops.select("part", "top.k", "top.h").toArrow().to_pydict()
    heads = dict(zip(heads["part"], zip(heads["k"], heads["h"])))
    order = sorted(heads)
    # the head of a range goes to the range before it, that of the first to the last
    before = {heads[p]: order[i - 1] for i, p in enumerate(order)}

    @F.pandas_udf("array<struct<part:int,after:int>>")
    def targets(k: pd.Series, h: pd.Series) -> pd.Series:
        own = part_of(k, h).tolist()
        heads_of = map(before.get, zip(k.tolist(), h.tolist()))
        return pd.Series(
            [[(p, 0)] if q is None else [(p, 0), (q, 1)] for p, q in zip(own, heads_of)]
        )

    dealt = keyed.withColumn("t", F.explode(targets("k", "h")))
    dealt = dealt.select("id", "k", "h", "text", "t.*")
    placed = dealt.repartitionById(parts, F.col("part")).sortWithinPartitions(
        "part", "after", F.desc("k"), F.desc("h")
    )

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            settle(drop_tables=True)
            ready = []
            for part, after, ident, words in zip(*[c.to_pylist() for c in batch.columns]):
                if held is not None and held[0] == part:
                    ready.append((held[1], held[2], words))
                # rows of a head after the first are not needed
                held = None if after else (part, ident, words)
            if ready:
                columns = zip(*rows(ready))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(columns, kinds)], schema=kinds
                )

    kinds = to_arrow_schema(StructType.fromDDL(schema))
    return placed.select("part", "after", "id", "text").mapInArrow(mapped, schema)


def _order(k: np.ndarray, h: np.ndarray) -> np.ndarray:
    """(k, h) as bytes that compare like the two numbers."""
    both = np.empty((len(k), 2), ">u8")
    for column, values in enumerate((k, h)):
        both[:, column] = values.astype(np.int64).view(np.uint64) ^ np.uint64(1 << 63)
    return both.view("S16").reshape(-1)

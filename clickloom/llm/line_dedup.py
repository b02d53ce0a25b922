"""Line deduplication over overlapping windows of three consecutive lines.

Windows are hashed, windows met more than once in the whole corpus are found, and of each
only the first occurrence, by id and position, stays. All lines that later occurrences cover
are removed; overlapping occurrences merge into one run of lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import fresh, full_text, join_hot, put

WINDOW = 3
SPANS = "array<struct<start:bigint,end:bigint>>"


def _windows(docs: DataFrame, text: Column, ident: Column, lines: int) -> DataFrame:
    """(doc, position, two hashes) of every window; ``doc`` is id and hashes of the text.

    Two hashes with unlike beginnings make 128 bits: in a corpus of 10^12 windows an
    accidental match is not to be expected.
    """
    last = F.size("lines") - F.lit(lines)
    hashed = F.transform(
        F.sequence(F.lit(0), last),
        lambda i: F.struct(
            i.alias("position"),
            *[
                F.xxhash64(F.lit(seed), *[F.col("lines")[i + k] for k in range(lines)]).alias(name)
                for seed, name in enumerate(("h1", "h2"))
            ],
        ),
    )
    return (
        docs.select(_doc(ident, text).alias("doc"), F.split(text, "\n", -1).alias("lines"))
        .where(last >= 0)
        .select("doc", F.explode(hashed).alias("w"))
        .select("doc", "w.*")
    )


def _doc(ident: Column, text: Column) -> Column:
    return F.struct(
        ident.alias("id"), F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(1), text).alias("t2")
    )


def later_windows(docs: DataFrame, text: Column, ident: Column, lines: int) -> DataFrame:
    """(doc, positions): where windows of a document begin that occurred before."""
    windows = _windows(docs, text, ident, lines)
    repeated = (
        windows.groupBy("h1", "h2")
        .agg(F.count("*").alias("n"), F.min(F.struct("doc", "position")).alias("first"))
        .where("n > 1")
        .drop("n")
    )
    return (
        join_hot(windows, repeated, "h1", "h2")
        .where(F.struct("doc", "position") != F.col("first"))
        .groupBy("doc")
        .agg(F.collect_set("position").alias("positions"))
    )


def dedup_lines(
    docs: DataFrame, text: str = "text", id_col: str = "doc_id", lines: int = WINDOW
) -> DataFrame:
    """Every row of ``docs`` with ``clean``, its text without repeated windows.

    ``n_lines``, ``n_removed`` and ``removed_spans`` (runs of removed lines, from 0, the end
    exclusive) are added too. Lines end at ``\\n`` and
    are compared as they are, empty ones too.

    A text of fewer than ``lines`` lines, empty or null, has no window and stays as it is,
    a null text as an empty one. Null ids come first and equal each other. Rows that
    repeat an id and a text are one document: the same is removed from all of them. An
    empty table gives an empty table. Columns named like a result are replaced.
    """
    value, ident = full_text(text), F.col(id_col)
    doc, found = fresh(docs, "doc", "found")
    later = later_windows(docs, value, ident, lines).select(
        F.col("doc").alias(doc), F.col("positions").alias(found)
    )
    both = docs.withColumn(doc, _doc(ident, value)).join(later, doc, "left")
    parts = F.split(full_text(both[text]), "\n", -1)
    covered = F.array_sort(
        F.array_distinct(
            F.flatten(F.transform(both[found], lambda p: F.sequence(p, p + F.lit(lines - 1))))
        )
    )
    after = F.transform(covered, lambda i: i + 1)
    # a run begins where the line before is not covered and ends where the next is not
    runs = F.arrays_zip(
        F.array_sort(F.array_except(covered, after)), F.array_sort(F.array_except(after, covered))
    )
    stay = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), covered)
    left = F.array_join(F.transform(stay, lambda i: parts[i]), "\n")
    touched = both[found].isNotNull()
    result = put(
        both,
        {
            "clean": F.when(touched, left).otherwise(full_text(both[text])),
            "n_lines": F.size(parts).cast("long"),
            "n_removed": F.when(touched, F.size(covered)).otherwise(0).cast("long"),
            "removed_spans": F.when(touched, runs.cast(SPANS)).otherwise(F.array().cast(SPANS)),
        },
    )
    return result.drop(doc, found)

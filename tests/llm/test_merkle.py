from __future__ import annotations

import hashlib

import pytest

from clickloom.llm.merkle import (
    LEAST_STRETCH,
    LONG_CLAUSE,
    MOST_STRETCH,
    edited_paragraphs,
    edited_rows,
    fingerprint,
    fingerprint_documents,
    likeness,
    map_with_next,
)
from clickloom.llm.queries import QUERIES

SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string,"
    " edited_fingerprint string, near_edited double, near_next double"
)


@pytest.mark.parametrize(
    "text",
    [
        *["", " ", "a", "a b. c, d\n", "one\n\ntwo\nthree", "\n\n\n", "a\r\n\r\nb"],
        *["x. y. x. y.", "É;É"],
    ],
)
def test_any_changed_character_changes_the_root(text):
    root = fingerprint(text)[:32]
    seen = {root}
    for i in range(len(text) + 1):
        for change in ("q", "\n", " ", "."):
            for new in (text[:i] + change + text[i:], text[:i] + change + text[i + 1 :]):
                if new != text:
                    assert fingerprint(new)[:32] != root
                    seen.add(fingerprint(new)[:32])
        assert fingerprint(text) == fingerprint(str(text))


def test_likeness():
    whole = fingerprint("a b. c d. e f. g h.")
    assert likeness(whole, whole) == 1
    assert likeness(whole, fingerprint("a b. c d. x. y.")) == 0.5
    assert likeness(whole, fingerprint("x")) == 0
    assert likeness(fingerprint(""), fingerprint(" ")) == 0
    assert likeness(fingerprint(""), fingerprint("")) == 1


@pytest.mark.parametrize("word", ["w{}", "слово{}", "字{}", "{:x}"])
def test_a_long_clause_shares_the_stretches_it_keeps(word):
    words = [word.format(i * 7919 % 1000) for i in range(400)]
    other = [word.format(i * 104729 % 997) + "q" for i in range(400)]
    text, edit = " ".join(words), " ".join(words[:200] + other[:200])
    assert likeness(fingerprint(text), fingerprint(edit)) > 0.3
    assert likeness(fingerprint(text), fingerprint(" ".join(other))) < 0.1
    # the stretch is found again wherever it stands
    moved = " ".join(other[:150] + words)
    assert likeness(fingerprint(text), fingerprint(moved)) > 0.3


def test_leaves_of_long_clauses_are_bounded():
    # no byte of "x" ends a stretch, every byte of "d" does
    assert fingerprint("x" * 50_000).count(".") == -(-50_000 // MOST_STRETCH)
    assert fingerprint("d" * 50_000).count(".") == -(-50_000 // (LEAST_STRETCH + 1))
    assert fingerprint("d" * LONG_CLAUSE).count(".") == 1


def test_edits_are_located():
    one = fingerprint("a\nb, b\n\nc\nd")
    two = fingerprint("a\nb, x\n\nc\nd\nnew")
    assert edited_paragraphs(one, two) == ([1], [1, 4])
    assert edited_paragraphs(one, one) == ([], [])


def _brute(rows):
    """rows: (id, text) in descending order."""
    out = []
    for i, (ident, text) in enumerate(rows):
        text, after = text or "", rows[(i + 1) % len(rows)][1] or ""
        half = len(text) // 2
        edit = text[: len(text) - half] + after[:half]
        prints = [fingerprint(x) for x in (text, edit, after)]
        out.append(
            (
                ident,
                len(text),
                hashlib.sha256(edit.encode()).hexdigest(),
                *prints[:2],
                likeness(prints[0], prints[1]),
                likeness(prints[0], prints[2]),
            )
        )
    return sorted(out, key=repr)


@pytest.mark.parametrize("part_bytes", [1, 20_000, 1 << 30])
def test_whole_query_at_any_range_size(spark, part_bytes):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = sorted((tuple(r) for r in docs.collect()), reverse=True)
    got = map_with_next(docs, edited_rows, SCHEMA, part_bytes=part_bytes)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == _brute(rows)


@pytest.mark.parametrize("most", [1, 3])
def test_ranges_grow_beyond_their_greatest_number(spark, most):
    docs = spark.range(500).selectExpr("id AS doc_id", "repeat(cast(id AS string), 9) AS text")
    got = map_with_next(docs, edited_rows, SCHEMA, part_bytes=1, most_ranges=most)
    assert got.rdd.getNumPartitions() == most
    rows = sorted((tuple(r) for r in docs.collect()), reverse=True)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == _brute(rows)


def test_registered_query(spark):
    got = QUERIES["op8_document_fingerprints"](spark, "/root/testdata/sf0.001")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = sorted((tuple(r) for r in docs.collect()), reverse=True)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == _brute(rows)


@pytest.mark.parametrize("part_bytes", [1, 1 << 30])
def test_odd_rows(spark, part_bytes):
    rows = [(5, "five. five"), (4, None), (4, None), (3, ""), (-2, "x" * 50_000), (None, "none")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = map_with_next(docs, edited_rows, SCHEMA, part_bytes=part_bytes).collect()
    assert sorted((tuple(r) for r in got), key=repr) == _brute(rows)


def test_many_rows_of_one_id_are_spread(spark):
    docs = spark.range(400).selectExpr("7L AS doc_id", "cast(id AS string) AS text")
    got = map_with_next(docs, edited_rows, SCHEMA, part_bytes=50)
    assert got.count() == 400
    assert got.rdd.glom().map(len).max() < 200


def test_one_row_and_none(spark):
    one = spark.createDataFrame([(1, "abcd")], "doc_id long, text string")
    row = map_with_next(one, edited_rows, SCHEMA).first()
    assert row.near_next == 1 and row.edited_sha256 == hashlib.sha256(b"abab").hexdigest()
    assert map_with_next(one.limit(0), edited_rows, SCHEMA).count() == 0
    docs = spark.createDataFrame([(None, 1)], "text string, fingerprint int")
    got = fingerprint_documents(docs)
    assert got.columns == ["text", "fingerprint"] and got.first().fingerprint == fingerprint("")

"""Nulls, repeated rows, long texts, empty tables and clashing names."""

from __future__ import annotations

import base64
import hashlib
import textwrap

import pytest
from pyspark.sql import functions as F

from clickloom.llm.common import BATCH_BYTES, byte_chunks, join_hot, small_batches
from clickloom.llm.exact_dedup import exact_dedup, may_repeat, slot_bits_for
from clickloom.llm.license_scan import SENTENCES, scan_licences
from clickloom.llm.line_dedup import dedup_lines
from clickloom.llm.warc import read_archive, write_archive, write_tables
from clickloom.session import new_work_dir

DOCS = "doc_id long, text string, kept string, place int"


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("slot_bits", [6, 27, None])
def test_exact_dedup(spark, slot_bits):
    long = "x" * 300_000
    rows = [
        (1, "a", "k", 1),
        (2, "a", "k", 2),
        (2, "a", "k", 2),
        (None, "a", "k", 3),
        (None, "n", "k", 4),
        (None, "n", "k", 4),
        (5, None, None, None),
        (4, "", "k", 5),
        (7, long, "k", 6),
        (6, long, "k", 6),
        *[(100 + i, f"single {i}", "k", 0) for i in range(50)],
    ]
    got = exact_dedup(spark.createDataFrame(rows, DOCS), slot_bits=slot_bits)
    names = ["doc_id", "text", "place", "keep_id", "group_size", "kept", "text_sha256"]
    assert got.columns == names
    found = got.collect()
    assert len(found) == len(rows)
    assert all(r.text_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest() for r in found)
    groups = {}
    for r in found:
        groups.setdefault(r.text or "", []).append(r)
    for same in groups.values():
        assert {r.group_size for r in same} == {len(same)}
        (one,) = [r for r in same if r.kept]
        ids = [r.doc_id for r in same if r.doc_id is not None]
        assert one.doc_id == (max(ids) if ids else None)
        assert {r.keep_id for r in same} == {one.doc_id}


def test_filter_grows_with_the_rows_up_to_its_bound():
    assert [slot_bits_for(n) for n in (0, 1, 2**16, 2**16 + 1, 2**23, 2**26, 10**12)] == [
        20, 20, 20, 21, 27, 30, 30
    ]


def test_exact_dedup_normalised_and_empty(spark):
    docs = spark.createDataFrame([(1, "A b"), (2, "a B")], "doc_id long, text string")
    assert {r.keep_id for r in exact_dedup(docs, normal=F.lower).collect()} == {2}
    assert exact_dedup(docs.limit(0)).count() == 0


def test_single_texts_pass_the_filter_by(spark):
    docs = spark.range(5000).selectExpr("id AS doc_id", "cast(id % 4990 AS string) AS text")
    flagged = docs.where(may_repeat(docs, F.col("text"))).count()
    assert 20 <= flagged < 40


def test_line_dedup(spark):
    block = "a\nb\nc"
    rows = [
        (2, f"x\n{block}\ny", "k", 1),
        (1, block, "k", 2),
        (1, block, "k", 2),
        (None, f"{block}\nz", "k", 3),
        (3, None, None, None),
        (4, "a\nb", "k", 4),
        (5, "same\n" * 20_000, "k", 5),
    ]
    docs = spark.createDataFrame(rows, DOCS).withColumnRenamed("kept", "clean")
    got = dedup_lines(docs)
    assert got.columns == [
        *["doc_id", "text", "place", "clean", "n_lines", "n_removed", "removed_spans"]
    ]
    found = {}
    for r in got.collect():
        found.setdefault(r.doc_id, []).append(
            (r.clean, r.n_lines, r.n_removed, [tuple(s) for s in r.removed_spans])
        )
    # the null id comes first, so it keeps the block
    assert found[None] == [(f"{block}\nz", 4, 0, [])]
    assert found[1] == [("", 3, 3, [(0, 3)])] * 2
    assert found[2] == [("x\ny", 5, 3, [(1, 4)])]
    assert found[3] == [("", 1, 0, [])]
    assert found[4] == [("a\nb", 2, 0, [])]
    assert found[5] == [("same\n", 20_001, 19_999, [(1, 20_000)])]
    assert dedup_lines(docs.limit(0)).count() == 0


def test_licences(spark):
    mit = "Released under the MIT License."
    rows = [
        (1, None, "k", 1),
        (2, "", "k", 1),
        (3, f"x. {mit} {mit}", "k", 1),
        (3, f"x. {mit} {mit}", "k", 1),
        (None, "word " * 60_000 + f". {mit}", None, None),
    ]
    docs = spark.createDataFrame(rows, DOCS).withColumnRenamed("kept", "licences")
    got = scan_licences(docs)
    assert got.columns == ["doc_id", "text", "place", "licence_sentences", "licences"]
    found = [(r.doc_id, [tuple(x) for x in r.licence_sentences], r.licences) for r in got.collect()]
    assert found == [
        (1, [], []),
        (2, [], []),
        (3, [(1, "D"), (2, "D")], ["MIT", "MIT"]),
        (3, [(1, "D"), (2, "D")], ["MIT", "MIT"]),
        (None, [(1, "D")], ["MIT"]),
    ]
    assert scan_licences(docs.limit(0)).count() == 0


APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.
"""


def _published() -> dict[str, str]:
    """Licences as they are published, by name."""
    mit = f"Copyright (c) 2020 Someone\n\n{SENTENCES['E']}\n\n{SENTENCES['F']}.\n"
    items = [SENTENCES[x] + "." for x in "NOP"]
    bsd = [f"{i}. {x}\n\n" for i, x in enumerate(items, 1)]
    opening = "Redistribution and use in source and binary forms are permitted provided that:\n\n"
    return {
        "Apache-2.0": APACHE,
        "MIT": mit,
        "BSD-2-Clause": opening + "".join(bsd[:2]),
        "BSD-3-Clause": opening + "".join(bsd),
        "ISC": SENTENCES["Q"] + ".\n",
        "Unlicense": SENTENCES["S"] + ".\n",
        "all-rights-reserved": "Copyright 2020 Someone.\nAll rights reserved.\n",
    }


def test_published_licences(spark):
    rows = []
    for name, text in _published().items():
        wrapped = "\n\n".join(
            textwrap.fill(" ".join(x.split()), 40, break_on_hyphens=False, break_long_words=False)
            for x in text.split("\n\n")
        )
        for form in (text, wrapped, wrapped.replace("\n", "\r\n")):
            rows.append((name, form))
            for mark in ("# ", "// ", " * ", ";; "):
                rows.append((name, "\n".join(mark + line for line in form.split("\n"))))
    docs = spark.createDataFrame(rows, "name string, text string")
    for r in scan_licences(docs).collect():
        assert r.licences == [r.name], r.text


def test_broken_lines_reach_the_sentences(spark):
    texts = ["All rights\nreserved.", "All  rights  reserved.", "x. All\trights\nreserved!"]
    texts.append(SENTENCES["S"].replace("public domain", "public\ndomain") + ".")
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    found = {r.text: r.licences for r in scan_licences(docs).collect()}
    assert [found[t] for t in texts] == [["all-rights-reserved"]] * 3 + [["Unlicense"]]


def _archive(spark, rows, **options):
    folder = new_work_dir(spark, "warc")
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, id int")
    write_archive(pages, folder, **options)
    return folder, read_archive(spark, folder)


def test_archive_records(spark):
    rows = [
        (3, "http://a/", "<p>é</p>", 1),
        (1, "http://b/\r\nX: y", "<p>é</p>", 1),
        (2, None, None, 1),
        (2, "http://c/", "", 1),
        (4, "http://c/", "", 1),
        (None, "http://d/", "<p>é</p>", None),
        (5, "http://e/", "x" * 3_000_000, 1),
    ]
    folder, got = _archive(spark, rows)
    found = got.collect()
    assert len(found) == len(rows)
    digest = base64.b32encode(hashlib.sha1("<p>é</p>".encode()).digest()).decode()
    by = {(r.id, r.url): r for r in found}
    first = by[1, "http://b/%0D%0AX: y"]
    assert (first.record_type, first.payload_digest, first.payload_bytes) == ("response", digest, 9)
    assert [(by[3, "http://a/"].record_type, by[3, "http://a/"].refers_to)] == [("revisit", 1)]
    assert by[None, "http://d/"].refers_to == 1
    assert by[2, None].record_type == by[2, "http://c/"].record_type == "response"
    assert by[4, "http://c/"].refers_to == 2
    assert spark.read.parquet(f"{folder}/payloads").count() == 3
    for r in found:
        head, _, rest = bytes(r.record).partition(b"\r\n\r\n")
        fields = dict(x.split(b": ", 1) for x in head.split(b"\r\n")[1:])
        assert head.startswith(b"WARC/1.1\r\n") and rest.endswith(b"\r\n\r\n")
        block = rest[:-4]
        assert int(fields[b"Content-Length"]) == len(block)
        _, _, payload = block.partition(b"\r\n\r\n")
        assert len(payload) == (r.payload_bytes if r.record_type == "response" else 0)


def test_short_payloads_are_all_responses_but_stored_once(spark):
    rows = [(1, "u", "ab", 1), (2, "u", "ab", 1), (3, "u", "abc", 1), (4, "u", "abc", 1)]
    folder, got = _archive(spark, rows, min_bytes=3)
    types = {r.id: r.record_type for r in got.collect()}
    assert types == {1: "response", 2: "response", 3: "response", 4: "revisit"}
    assert spark.read.parquet(f"{folder}/payloads").count() == 2


def _changed(spark, folder, payloads=None, **heads):
    """A copy of an archive with other payloads or head bytes."""
    other = new_work_dir(spark, "warc")
    responses = spark.read.parquet(f"{folder}/responses").withColumn("again", F.lit(False))
    revisits = spark.read.parquet(f"{folder}/revisits").withColumn("again", F.lit(True))
    both = responses.unionByName(revisits)
    for name, (old, new) in heads.items():
        text = F.replace(F.decode(name, "UTF-8"), F.lit(old), F.lit(new))
        both = both.withColumn(name, F.encode(text, "UTF-8"))
    stored = spark.read.parquet(f"{folder}/payloads")
    write_tables(both, payloads(stored) if payloads else stored, other)
    return read_archive(spark, other)


def test_damaged_archives_are_errors(spark):
    folder, whole = _archive(spark, [(1, "u", "ab", 1), (2, "u", "ab", 1)])
    assert _rows(_changed(spark, folder)) == _rows(whole)
    changed = lambda rows: rows.withColumn("payload", F.lit(bytearray(b"ac")))
    for trouble, other in {
        "no sound payload": _changed(spark, folder, changed),
        "no sound payload ": _changed(spark, folder, lambda rows: rows.limit(0)),
        "wrong Content-Length": _changed(spark, folder, http_head=("Length: 2", "Length: 1")),
        "wrong digest": _changed(spark, folder, warc_head=("sha1:", "sha1:A")),
    }.items():
        with pytest.raises(Exception, match=trouble):
            other.collect()
    length = "Content-Length: "
    longer = F.replace(F.decode("warc_head", "UTF-8"), F.lit(length), F.lit(f"{length}9"))
    for name in ("responses", "revisits"):
        other = new_work_dir(spark, "warc")
        heads = [
            spark.read.parquet(f"{folder}/{n}")
            .withColumn("warc_head", F.encode(longer, "UTF-8") if n == name else F.col("warc_head"))
            .withColumn("again", F.lit(n == "revisits"))
            for n in ("responses", "revisits")
        ]
        write_tables(heads[0].unionByName(heads[1]), spark.read.parquet(f"{folder}/payloads"), other)
        with pytest.raises(Exception, match="wrong"):
            read_archive(spark, other).collect()


def test_payloads_meet_their_headers_without_a_shuffle(spark):
    rows = [(i, "u", f"page {i % 7}", 1) for i in range(40)]
    _, got = _archive(spark, rows)
    digests = got.select("id", "payload_bytes", "payload_digest")
    assert digests.count() == 40
    with_settings = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plans = digests._jdf.queryExecution()
        join = plans.optimizedPlan().toString().split("Join LeftOuter")[1]
        assert "payload" in join and "warc_head" in join and "http_head" in join
        lines = plans.executedPlan().toString().splitlines()
        exchanges = [line for line in lines if "Exchange" in line]
        scans = [line for line in lines if "payload" in line and "Bucketed: true" in line]
        # only addresses, sizes and digests are shuffled
        assert scans and len(exchanges) <= 3
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", with_settings)


def test_empty_archive(spark):
    _, got = _archive(spark, [])
    assert got.count() == 0


def test_join_hot_keeps_rows_and_names(spark):
    left = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k long, part string")
    right = spark.createDataFrame([(1, "x")], "k long, v string")
    assert _rows(join_hot(left, right, "k")) == [(1, "a", "x"), (1, "b", "x")]
    assert len(_rows(join_hot(left, right, "k", how="left"))) == 3


def test_byte_chunks_of_sliced_columns():
    import pyarrow as pa

    texts = ["é", None, "", "abc", "x" * 50, "z"]
    column = pa.chunked_array([pa.array(texts[:4]), pa.array(["no", *texts[4:]])[1:]])
    for most in (1, 8, 1000):
        out = {}
        for data, edges, row in byte_chunks(column, most):
            for i, (a, b) in enumerate(zip(edges, edges[1:])):
                out[row + i] = bytes(data[a:b]).decode()
        assert out == {i: t or "" for i, t in enumerate(texts)}


def test_batches_are_bounded_unless_the_session_says_otherwise(spark):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    old = spark.conf.get(key)
    try:
        spark.conf.unset(key)
        small_batches(spark.range(1))
        assert spark.conf.get(key) == str(BATCH_BYTES)
        spark.conf.set(key, "16m")
        small_batches(spark.range(1))
        assert spark.conf.get(key) == "16m"
    finally:
        spark.conf.set(key, old)

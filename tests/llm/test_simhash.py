from __future__ import annotations

import random

import numpy as np
import pytest
from brute import components, simhash

from clickloom.llm.queries import QUERIES
from clickloom.llm.simhash import (
    equal_segments,
    fingerprint,
    links_within,
    near_links,
    pivot_distances,
    segments,
    simhash_dedup,
    with_pivots,
)


def _close(a: int, b: int) -> bool:
    return (a ^ b).bit_count() <= 4


@pytest.mark.parametrize(
    "text", ["", " \n", "one", "One two  three", "a b\tc\x0bd e f A B c d", "é É Ü x", "x " * 3000]
)
def test_fingerprint(text):
    assert fingerprint(text) == simhash(text)


def test_long_texts_are_counted_exactly():
    rng = random.Random(1)
    for n in (256, 4096, 4099, 9001):
        text = " ".join(str(rng.randrange(50)) for _ in range(n))
        assert fingerprint(text) == simhash(text)


def _family(rng: random.Random, seeds: int, members: int) -> list[int]:
    """Fingerprints in chains of up to three flips each, and single ones."""
    out = set()
    for _ in range(seeds):
        at = rng.getrandbits(64)
        for _ in range(rng.randrange(1, members)):
            out.add(at)
            for _ in range(rng.randrange(1, 7)):
                at ^= 1 << rng.randrange(64)
    return sorted(out)


def test_links_within_joins_what_is_close():
    prints = _family(random.Random(2), 40, 12)
    links = links_within(np.array(prints, np.uint64))
    signed = {p: p - (1 << 64) if p >> 63 else p for p in prints}
    want = components([signed[p] for p in prints], lambda a, b: _close(a % 2**64, b % 2**64))
    got = components(list(want), lambda a, b: (min(a, b), max(a, b)) in set(links))
    assert got == want


@pytest.mark.parametrize("block", [8, 2048])
def test_linked_groups_at_any_block_size(spark, block):
    prints = _family(random.Random(3), 60, 30)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    found = near_links(spark.createDataFrame([(p,) for p in signed], "fp long"), block=block)
    links = {tuple(r) for r in found.collect()}
    want = components(signed, lambda a, b: _close(a % 2**64, b % 2**64))
    assert components(signed, lambda a, b: (min(a, b), max(a, b)) in links) == want


def test_segments_cover_all_bits_and_keys_grow():
    for parts in range(5, 11):
        cut = segments(64, parts)
        assert sum(n for _, n in cut) == 64 and len(cut) == parts
    assert equal_segments(10) == 2 and equal_segments(10**8) == 3 and equal_segments(10**12) > 4


def test_whole_query_against_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    prints = {r.doc_id: simhash(r.text) for r in rows}
    root = components(sorted(prints), lambda a, b: _close(prints[a], prints[b]))
    got = QUERIES["op6_simhash_dedup"](spark, folder)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert {tuple(r) for r in got.collect()} == {
        (i, f"{p:016x}", root[i]) for i, p in prints.items()
    }


def test_odd_rows(spark):
    rows = [(3, None, 1), (2, "", 2), (2, "", 2), (None, "a b c d e", 3), (None, None, 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp int")
    got = [tuple(r) for r in simhash_dedup(docs).collect()]
    zero, other = "0" * 16, f"{simhash('a b c d e'):016x}"
    assert sorted(got, key=repr) == sorted(
        [
            (3, None, 1, zero, 2),
            (2, "", 2, zero, 2),
            (2, "", 2, zero, 2),
            (None, "a b c d e", 3, other, None),
            (None, None, 4, zero, 2),
        ],
        key=repr,
    )


def test_empty_table_and_replaced_columns(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, component_id string")
    got = simhash_dedup(docs)
    assert got.columns == ["doc_id", "text", "fingerprint", "component_id"]
    assert dict(got.dtypes)["component_id"] == "bigint" and got.count() == 0


def test_pivot_table_is_what_the_distances_are(spark):
    prints = np.array([0, 1, 2**63, 2**64 - 1, 12345678901234567890], np.uint64)
    signed = [(int(p),) for p in prints.view(np.int64)]
    rows = with_pivots(spark.createDataFrame(signed, "fp long")).collect()
    got = {r.fp: list(np.frombuffer(r.pivots, np.int8)) for r in rows}
    assert got == {f: list(d) for (f,), d in zip(signed, pivot_distances(prints))}

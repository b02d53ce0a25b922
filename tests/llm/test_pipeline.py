from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from brute import components, secrets, simhash
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from clickloom.llm.language_id import score_texts, train
from clickloom.llm.packing import lower_bound

FOLDER = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


def test_kept_documents_and_their_packing(spark, docs):
    model = train(docs)
    kept = {r.doc_id: r.text for r in docs.collect()}
    _, share = score_texts(model, pa.array(list(kept.values())))
    kept = {i: t for (i, t), s in zip(kept.items(), share) if s >= pipeline.least_score(4)}
    largest = defaultdict(int)
    for i, t in kept.items():
        largest[t] = max(largest[t], i)
    kept = {i: t for t, i in largest.items()}
    prints = {i: simhash(t) for i, t in kept.items()}
    root = components(sorted(kept), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 4)
    kept = {i: t for i, t in kept.items() if root[i] == i and not secrets(t)}

    rows = pipeline.run(spark, FOLDER).collect()
    assert {r.doc_id for r in rows} == set(kept)
    assert 100 < len(kept) < docs.count()
    bins = {r.sequence_id for r in rows}
    assert len(bins) <= lower_bound(np.array([r.length for r in rows]), 2048) + 1


def test_stages_keep_the_columns_and_clean_rows(spark, docs):
    clean = [
        (1, "The of and threa ores oredat the annly re", "en", "s", 1),
        (2, "Un la ouréaux qui oire eau de ai que", "fr", "s", 1),
    ]
    made = spark.createDataFrame(clean, docs.schema)
    for _, stage in pipeline.STAGES[:-1]:
        made = stage(spark, made, FOLDER)
        assert made.columns == COLUMNS
        assert sorted(tuple(r) for r in made.collect()) == clean


def test_each_stage_takes_effect(spark, docs):
    text = "The of and threa ores oredat the annly re in on at by with from"
    rows = [
        (1, text, "en", "s", 1),
        (2, text, "en", "s", 1),
        (3, "12 34 !!", "en", "s", 1),
        (4, None, None, None, None),
        (5, f"Ersting token = 'abcdefghij' {text[::-1]}", "en", "s", 1),
        (None, "", "en", "s", 1),
    ]
    made = spark.createDataFrame(rows, docs.schema)
    ids = []
    for _, stage in pipeline.STAGES[:-1]:
        made = stage(spark, made, FOLDER)
        ids.append(sorted(r.doc_id for r in made.collect()))
    assert ids == [[1, 2, 5], [2, 5], [2, 5], [2]]


def test_one_row_of_each_group_stays(spark, docs):
    words = [f"word{i}" for i in range(300)]
    one, two = " ".join(words), " ".join([*words[:-1], "end"])
    assert (simhash(one) ^ simhash(two)).bit_count() <= 4
    other = " ".join(f"other{i}" for i in range(90))
    rows = [(i, t, "en", "s", 1) for i, t in [(1, one), (1, two), (2, one), (None, other)]]
    rows += [(None, other, "en", "s", 2), (None, None, None, None, None), (None, "", "en", "s", 1)]
    made = spark.createDataFrame(rows, docs.schema).coalesce(1)
    got = [tuple(r) for r in pipeline.near_duplicates(spark, made, FOLDER).collect()]
    assert sorted(got, key=repr) == sorted([rows[0], rows[3], rows[5]], key=repr)


def test_columns_named_like_results_stay(spark, docs):
    text = "The of and threa ores oredat the annly re in on at by with from"
    names = ["score", "kept", "component_id", "place", "secret_spans", "lang_pred", "KEEP_ID"]
    made = spark.createDataFrame([(1, text, "en", "s", 1)], docs.schema)
    made = made.select("*", *[F.lit(f"own {n}").alias(n) for n in names])
    want = [tuple(r) for r in made.collect()]
    for _, stage in pipeline.STAGES[:-1]:
        made = stage(spark, made, FOLDER)
        assert [tuple(r) for r in made.collect()] == want


def test_least_score_leaves_clean_short_texts_and_can_act(spark, docs):
    assert [round(pipeline.least_score(n), 2) for n in (1, 2, 3, 4)] == [1.0, 0.6, 0.47, 0.4]
    for labels in (["en", "fr"], ["de", "en", "es", "fr"]):
        known = docs.where(F.col("lang").isin(labels))
        model = train(known)
        texts = pa.array([r.text for r in known.where("text <> ''").collect()])
        short = pa.array([" ".join(t.split()[:8]) for t in texts.to_pylist()])
        for some, least in ((texts, 0.99), (short, 0.97)):
            best, share = score_texts(model, some)
            assert (share[best >= 0] >= pipeline.least_score(len(labels))).mean() >= least
    known = docs.where(F.col("lang").isin("en", "fr"))
    unlearned = docs.where(F.col("lang").isin("de", "es") & (F.col("text") != "")).collect()
    short = pa.array([" ".join(r.text.split()[:8]) for r in unlearned])
    _, share = score_texts(train(known), short)
    assert (share < pipeline.least_score(2)).any()


def test_empty_table(spark, docs):
    made = docs.limit(0)
    for _, stage in pipeline.STAGES:
        made = stage(spark, made, FOLDER)
    assert made.count() == 0 and made.columns[0] == "doc_id"

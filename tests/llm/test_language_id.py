from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pytest

from clickloom.llm.language_id import (
    PAD,
    WINDOW,
    LanguageModel,
    fit,
    identify_languages,
    score_texts,
    softmax,
    train,
)
from clickloom.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"


def _windows(texts):
    out = np.full((len(texts), WINDOW), PAD, np.int16)
    for row, text in zip(out, texts):
        data = np.frombuffer(text.encode()[:WINDOW], np.uint8)
        row[: len(data)] = data
    return out


@pytest.fixture(scope="module")
def model():
    rng = np.random.default_rng(1)
    words = {"aa": ["la", "le", "oua", "é"], "bb": ["the", "ing", "of"], "cc": ["ung", "der", "ß"]}
    texts, truth = [], []
    for k, own in enumerate(words.values()):
        for _ in range(150):
            texts.append(" ".join(rng.choice(own, rng.integers(3, 60))))
            truth.append(k)
    return fit(_windows(texts), np.array(truth), list(words))


def test_scores_equal_a_plain_forward_pass(model):
    window = _windows(["the der la é"])[0]
    padded = np.concatenate([window, np.full(3, PAD)])
    rows = [model.embedding[padded[i : i + 4]].reshape(-1) for i in range(WINDOW)]
    hidden = np.maximum(np.max([r @ model.filters for r in rows], axis=0) + model.filter_bias, 0)
    want = hidden @ model.dense + model.dense_bias
    assert np.allclose(model.scores(window[None])[0], want, atol=1e-4)


def test_narrow_filters_see_only_their_width(model):
    weights = model.filters.reshape(4, -1, 3, 16)
    assert not weights[2:, :, 0].any() and not weights[3:, :, 1].any() and weights[3:, :, 2].any()


def test_whole_texts_count_window_by_window(model):
    texts = ["the of ing " * 3, "la oua " * 2000 + "der ung " * 9000, "", "ß", None, "x" * 256]
    best, share = score_texts(model, pa.array(texts))
    for text, b, s in zip(texts, best, share):
        data = (text or "").encode()
        if not data:
            assert b == -1 and s == 0
            continue
        total = np.zeros(3)
        for at in range(0, len(data), WINDOW):
            cut = np.full((1, WINDOW), PAD)
            part = np.frombuffer(data[at : at + WINDOW], np.uint8)
            cut[0, : len(part)] = part
            total += model.scores(cut)[0] * len(part)
        want = softmax(total[None] / len(data))[0]
        assert b == want.argmax() and abs(s - want.max()) < 1e-5
    # the end of a long text decides where it is most of it
    assert best[1] == 2


def test_held_out_accuracy_of_the_query(spark):
    got = QUERIES["op2_language_id"](spark, FOLDER)
    assert got.columns == ["doc_id", "held_out", "lang_pred", "score"]
    rows = {r.doc_id: r for r in got.collect()}
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    assert set(rows) == {d.doc_id for d in docs}
    right = []
    for d in docs:
        row = rows[d.doc_id]
        assert row.held_out == (zlib.crc32(str(d.doc_id).encode()) % 4 == 2)
        assert 0 <= row.score <= 1
        if row.held_out:
            right.append(row.lang_pred == d.lang)
    assert len(right) > 200 and np.mean(right) > 0.97


def test_odd_rows(spark, model):
    rows = [
        (1, None, "x"),
        (1, "", "x"),
        (2, "12 .. ½ _ ²", "x"),
        (3, "the of ing of", "x"),
        (3, "the of ing of", "x"),
        (None, "der ung der ß", None),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    got = identify_languages(docs, model)
    assert got.columns == ["doc_id", "text", "lang_pred", "score"]
    found = [(r.doc_id, r.lang_pred, r.score > 0.5) for r in got.collect()]
    assert found == [
        (1, "und", False),
        (1, "und", False),
        (2, "und", False),
        (3, "bb", True),
        (3, "bb", True),
        (None, "cc", True),
    ]
    assert identify_languages(docs.limit(0), model).count() == 0


def test_training_without_usable_rows(spark):
    rows = [(None, "en"), ("", "en"), ("a", None)]
    docs = spark.createDataFrame(rows, "text string, lang string")
    assert train(docs) is None
    assert [r.lang_pred for r in identify_languages(docs, None).collect()] == ["und"] * 3


def test_one_label_is_enough(spark):
    docs = spark.createDataFrame([("some words", "en")], "text string, lang string")
    model = train(docs)
    assert isinstance(model, LanguageModel)
    assert identify_languages(docs, model).first().lang_pred == "en"


def test_a_filter_on_the_score_predicts_once(spark, model, tmp_path):
    spark.createDataFrame([(1, "la le"), (2, None)], "doc_id long, text string").write.parquet(
        f"{tmp_path}/docs"
    )
    found = identify_languages(spark.read.parquet(f"{tmp_path}/docs"), model)
    kept = found.where("lang_pred <> 'und' AND score > 0.1")
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    assert [r.doc_id for r in kept.collect()] == [1]

"""Language identification by a small byte convolutional network.

A window of ``WINDOW`` bytes goes through an embedding of bytes, filters of several widths,
a rectifier, the maximum over the window and a softmax layer. It is trained in numpy on the
driver, on a bounded sample of labelled texts, and applied to every window of every text in
Arrow batches: a text's windows follow each other without gaps or overlap, and their scores
are averaged by length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import byte_chunks, fresh, full_text, put, settle, small_batches

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBEDDED = 8
PAD = 256
UNKNOWN = "und"

# bounds of the training sample: texts over all labels, windows of each text
TRAIN_TEXTS = 4000
TEXT_WINDOWS = 4
EPOCHS = 6
BLOCK = 32


@dataclass
class LanguageModel:
    """Labels and weights; ``filters`` covers the greatest width, zero where one is narrower."""

    labels: list[str]
    embedding: np.ndarray
    filters: np.ndarray
    filter_bias: np.ndarray
    dense: np.ndarray
    dense_bias: np.ndarray

    def gathered(self, windows: np.ndarray) -> np.ndarray:
        """Embedded neighbourhoods of every position: (windows, positions, width * embedded)."""
        wide = max(WIDTHS)
        padded = np.pad(windows, ((0, 0), (0, wide - 1)), constant_values=PAD)
        embedded = self.embedding[padded]
        size = windows.shape[1]
        return np.concatenate([embedded[:, o : o + size] for o in range(wide)], axis=2)

    def scores(self, windows: np.ndarray) -> np.ndarray:
        """Scores of each window for each label, before the softmax."""
        out = np.empty((len(windows), len(self.labels)), np.float32)
        for at in range(0, len(windows), BLOCK):
            near = self.gathered(windows[at : at + BLOCK])
            found = near.reshape(-1, near.shape[2]) @ self.filters
            most = found.reshape(*near.shape[:2], -1).max(axis=1) + self.filter_bias
            out[at : at + BLOCK] = np.maximum(most, 0) @ self.dense + self.dense_bias
        return out


def softmax(scores: np.ndarray) -> np.ndarray:
    raised = np.exp(scores - scores.max(axis=1, keepdims=True))
    return raised / raised.sum(axis=1, keepdims=True)


def _start(labels: list[str], rng: np.random.Generator) -> tuple[LanguageModel, np.ndarray]:
    wide, total = max(WIDTHS), FILTERS * len(WIDTHS)
    mask = np.zeros((wide, EMBEDDED, total), np.float32)
    for i, width in enumerate(WIDTHS):
        mask[:width, :, i * FILTERS : (i + 1) * FILTERS] = 1
    mask = mask.reshape(wide * EMBEDDED, total)

    def normal(*shape: int, scale: float) -> np.ndarray:
        return rng.normal(0, scale, shape).astype(np.float32)

    model = LanguageModel(
        labels,
        normal(PAD + 1, EMBEDDED, scale=0.5),
        normal(wide * EMBEDDED, total, scale=0.2) * mask,
        np.zeros(total, np.float32),
        normal(total, len(labels), scale=0.1),
        np.zeros(len(labels), np.float32),
    )
    return model, mask


def fit(windows: np.ndarray, truth: np.ndarray, labels: list[str], seed: int = 0) -> LanguageModel:
    """Train on windows (bytes, ``PAD`` after the end) by Adam.

    Half of the windows of each pass are cut to a random length, so that short texts are
    met in training too. Labels weigh the same whatever their number of windows.
    """
    rng = np.random.default_rng(seed)
    model, mask = _start(labels, rng)
    names = ("embedding", "filters", "filter_bias", "dense", "dense_bias")
    state = {n: [np.zeros_like(getattr(model, n)) for _ in range(2)] for n in names}
    weight = 1 / np.maximum(np.bincount(truth, minlength=len(labels)), 1)
    weight = (weight / weight[truth].mean())[truth].astype(np.float32)
    step = 0
    for epoch in range(EPOCHS):
        order = rng.permutation(len(windows))
        for at in range(0, len(order), BLOCK * 2):
            picked = order[at : at + BLOCK * 2]
            some = windows[picked].copy()
            cut = np.where(rng.random(len(some)) < 0.5, rng.integers(6, WINDOW, len(some)), WINDOW)
            some[np.arange(WINDOW)[None] >= cut[:, None]] = PAD
            near = model.gathered(some)
            found = (near.reshape(-1, near.shape[2]) @ model.filters).reshape(*near.shape[:2], -1)
            best = found.argmax(axis=1)
            top = np.take_along_axis(found, best[:, None], axis=1)[:, 0] + model.filter_bias
            hidden = np.maximum(top, 0)
            wrong = softmax(hidden @ model.dense + model.dense_bias)
            wrong[np.arange(len(some)), truth[picked]] -= 1
            wrong *= weight[picked, None] / len(some)
            back = (wrong @ model.dense.T) * (top > 0)
            seen = near[np.arange(len(some))[:, None], best]  # (windows, filters, neighbourhood)
            slope = {
                "dense": hidden.T @ wrong,
                "dense_bias": wrong.sum(axis=0),
                "filter_bias": back.sum(axis=0),
                "filters": np.einsum("nf,nfd->df", back, seen) * mask,
                "embedding": np.zeros_like(model.embedding),
            }
            padded = np.pad(some, ((0, 0), (0, max(WIDTHS) - 1)), constant_values=PAD)
            share = back[:, :, None] * model.filters.T[None]
            for offset in range(max(WIDTHS)):
                touched = padded[np.arange(len(some))[:, None], best + offset]
                part = share[:, :, offset * EMBEDDED : (offset + 1) * EMBEDDED]
                np.add.at(slope["embedding"], touched.reshape(-1), part.reshape(-1, EMBEDDED))
            step += 1
            rate = 0.01 * (1 - epoch / EPOCHS)
            for name, (mean, square) in state.items():
                mean += 0.1 * (slope[name] - mean)
                square += 0.001 * (slope[name] ** 2 - square)
                move = (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
                getattr(model, name)[...] -= rate * move
    return model


def _sample(labelled: DataFrame, text: str, label: str, texts: int) -> DataFrame:
    """About ``texts`` rows at most, as many of each label, and windows spread over each."""
    rows = small_batches(labelled).select(F.col(text).alias("text"), F.col(label).alias("label")).where(
        "text IS NOT NULL AND text <> '' AND label IS NOT NULL"
    )
    counts = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    each = max(1, texts // max(1, len(counts)))
    shares = {value: min(1.0, each / n) for value, n in counts.items()}

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for words, value in zip(*[c.to_pylist() for c in batch.columns]):
                data = words.encode()
                number = min(TEXT_WINDOWS, -(-len(data) // WINDOW))
                last = max(0, len(data) - WINDOW)
                starts = {round(i * last / max(1, number - 1)) for i in range(number)}
                found += [(value, data[s : s + WINDOW]) for s in sorted(starts)]
            columns = zip(*found) if found else ((), ())
            kinds = (pa.string(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], ["label", "data"]
            )

    return rows.sampleBy("label", shares, seed=7).mapInArrow(windows, "label string, data binary")


def train(
    labelled: DataFrame, text: str = "text", label: str = "lang", texts: int = TRAIN_TEXTS
) -> LanguageModel | None:
    """Model of the non-null labels, or None if no row has a text and a label.

    The driver receives windows of about ``texts`` texts, the same number of each label,
    and at most ``TEXT_WINDOWS`` windows of a text, spread over its whole length.
    """
    sample = _sample(labelled, text, label, texts).toArrow()
    if not sample.num_rows:
        return None
    names = sample.column("label").to_numpy()
    labels, truth = np.unique(names.astype(str), return_inverse=True)
    windows = np.full((len(truth), WINDOW), PAD, np.int16)
    for row, data in zip(windows, sample.column("data").to_pylist()):
        row[: len(data)] = np.frombuffer(data, np.uint8)
    return fit(windows, truth, labels.tolist())


def score_texts(model: LanguageModel, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(label number, its share of 0 to 1) for whole texts; number -1 for an empty one."""
    best = np.full(len(texts), -1)
    share = np.zeros(len(texts))
    for data, edges, row in byte_chunks(texts):
        sizes = np.diff(edges)
        number = -(-sizes // WINDOW)
        owner = np.repeat(np.arange(len(sizes)), number)
        order = np.arange(len(owner)) - np.repeat(np.cumsum(number) - number, number)
        starts = edges[:-1][owner] + order * WINDOW
        lengths = np.minimum(WINDOW, edges[1:][owner] - starts)
        total = np.zeros((len(sizes), len(model.labels)))
        for at in range(0, len(owner), 1024):
            cut = slice(at, at + 1024)
            spots = starts[cut, None] + np.arange(WINDOW)
            inside = np.arange(WINDOW) < lengths[cut, None]
            near = data[np.minimum(spots, len(data) - 1)].astype(np.int16)
            windows = np.where(inside, near, np.int16(PAD))
            np.add.at(total, owner[cut], model.scores(windows) * lengths[cut, None])
        real = sizes > 0
        shares = softmax(total[real] / sizes[real, None])
        rows = row + np.flatnonzero(real)
        best[rows], share[rows] = shares.argmax(axis=1), shares.max(axis=1)
    return best, share


def identify_languages(
    docs: DataFrame, model: LanguageModel | None, text: str = "text"
) -> DataFrame:
    """Every row of ``docs`` with ``lang_pred``, a label of the model, and ``score``.

    ``score`` is the softmax share of the predicted label. A text that is null, empty or
    has no letter gets ``und`` and score 0, as does every text if there is no model. The
    whole text counts, whatever its length. Of labels of equal share the one that is first by
    name counts. Rows that repeat each other get equal results.
    An empty table gives an empty table. Columns named like a result are replaced.
    """
    if model is None:
        return put(docs, {"lang_pred": F.lit(UNKNOWN), "score": F.lit(0.0)})
    (done,) = fresh(docs, "done")
    held = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("lang_pred string, score double")
    def predict(texts: pa.Array) -> pa.Array:
        settle(drop_tables=True)
        best, share = score_texts(held.value, texts)
        names = np.array([*held.value.labels, UNKNOWN], object)[best]
        return pa.StructArray.from_arrays(
            [pa.array(names, pa.string()), pa.array(share)], ["lang_pred", "score"]
        )

    # a filter on the result must not make the prediction a second time below a projection
    predict = predict.asNondeterministic()
    value = full_text(text)
    letters = value.rlike(r"\p{L}")
    found = small_batches(docs).withColumn(done, predict(value))
    return put(
        found,
        {
            "lang_pred": F.when(letters, found[done]["lang_pred"]).otherwise(UNKNOWN),
            "score": F.when(letters, found[done]["score"]).otherwise(0.0),
        },
    ).drop(done)

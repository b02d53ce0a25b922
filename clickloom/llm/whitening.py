"""Embedding whitening by Golub-Kahan-Lanczos bidiagonalisation.

X is the matrix of centred rows. Starting with a unit vector v, the method alternates
``u = Xv`` and ``v = X'u``, both distributed products over the rows, and keeps every new
vector orthogonal to all before it. The lengths left over form a small bidiagonal matrix B
with ``X V = U B``; its singular values are the deviations of the principal components, and V
times its right singular vectors are the components.

A left vector u has an entry per row and is never stored: it is ``u = X p`` for a vector p
with an entry per dimension, made by the same recurrence, so each task makes its entries from
its own rows again. One pass over the rows gives ``X'(X q)`` and the square length of ``X q``,
which is all a step needs; the overlaps of ``X q`` with all left vectors come from it by
small products, and where they are above rounding the step is done again on the corrected q.
The driver holds vectors of one entry per dimension, two for each step; the number of steps is
the dimension at most, however many rows there are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import fresh, put, small_batches, written

COMPONENTS = 8
SCALE = 1024
SHIFT = 100_000
# below this part of the largest deviation a direction counts as empty
FLAT = 1e-12
# overlap with earlier vectors above which a step is done again
OVERLAP = 1e-14
# what may be left of the residual of a wanted component, as a part of the largest deviation
SETTLED = 1e-15
REACH = 1 << 52


def whole_numbers(vector: Column) -> Column:
    """``floor(1024 * c) + 100000`` of each entry; entries beyond 2^42 are an error."""

    def one(c: Column) -> Column:
        moved = F.floor(c.cast("double") * SCALE)
        far = F.abs(c.cast("double")) >= REACH / SCALE
        return F.when(far, F.raise_error(F.lit("entry too large for whole numbers"))).otherwise(
            moved + SHIFT
        )

    return F.transform(vector, one)


def usable(vector: Column) -> Column:
    """Whether a vector is not null and all its entries are finite numbers."""
    return F.coalesce(
        F.forall(
            vector,
            lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) != float("inf")),
        ),
        F.lit(False),
    )


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of a column of equally long lists of whole numbers."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


@dataclass
class Whitening:
    """What was fitted: ``n`` rows of exact column sums, components by falling deviation.

    ``components`` has a unit vector per row, ``values`` their eigenvalues of the covariance
    with divisor ``n``, ``trace`` the covariance's trace, ``steps`` and ``passes`` what it took.
    """

    n: int
    sums: list[int]
    trace: float
    components: np.ndarray
    values: np.ndarray
    steps: int
    passes: int

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    def explained(self) -> np.ndarray:
        return self.values / self.trace

    def project(self, rows: np.ndarray) -> np.ndarray:
        """Whitened rows: centred, projected on the components, divided by the deviations."""
        return _centred(rows, self.n, self.sums) @ self.components.T / np.sqrt(self.values)


def _centred(rows: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """Rows less their means; the whole parts are taken off before numbers become doubles."""
    whole = np.array([s // n for s in sums], np.int64)
    rest = np.array([(s % n) / n for s in sums])
    return (rows - whole).astype(np.float64) - rest


def _totals(rows: DataFrame, width: int, of: str, parts) -> list:
    """Sums over all rows of ``width`` numbers; ``parts`` gives those of an array of rows.

    A task sums its rows, Spark sums the tasks: one small row from each.
    """

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                found = parts(_matrix(batch.column(0)))
                total = found if total is None else total + found
        if total is not None:
            kind = pa.int64() if total.dtype.kind == "i" else pa.float64()
            arrays = [pa.array([x], kind) for x in total.tolist()]
            yield pa.RecordBatch.from_arrays(arrays, names)

    names = [f"c{i}" for i in range(width)]
    found = rows.select("x").mapInArrow(mapped, ", ".join(f"{n} {of}" for n in names))
    return list(found.agg(*[F.sum(n) for n in names]).first())


class _Rows:
    """The written rows and the distributed products with them."""

    def __init__(self, rows: DataFrame) -> None:
        self.rows, self.passes = rows, 0
        sizes = rows.agg(
            F.count("*"), F.min(F.size("x")).alias("low"), F.max(F.size("x")).alias("high")
        ).first()
        self.n, low, high = sizes
        if low != high:
            raise ValueError(f"vectors of {low} and of {high} entries cannot be whitened together")
        self.width = high or 0
        self.sums = (
            [int(s) for s in _totals(rows, self.width, "long", lambda x: x.sum(axis=0))]
            if self.n and self.width
            else []
        )

    def product(self, q: np.ndarray) -> tuple[np.ndarray, float]:
        """``X'(X q)`` and the square length of ``X q``."""
        n, sums = self.n, self.sums

        def parts(x: np.ndarray) -> np.ndarray:
            rows = _centred(x, n, sums)
            u = rows @ q
            return np.append(rows.T @ u, u @ u)

        self.passes += 1
        found = np.array(_totals(self.rows, self.width + 1, "double", parts))
        return found[:-1], float(found[-1])

    def spread(self) -> float:
        """The sum of squares of all centred entries."""
        n, sums = self.n, self.sums
        total = _totals(
            self.rows, 1, "double", lambda x: np.array([np.square(_centred(x, n, sums)).sum()])
        )
        return float(total[0])


def _apart(v: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """``v`` without its parts along unit vectors ``others``; twice is enough."""
    if others:
        basis = np.array(others)
        for _ in range(2):
            v = v - basis.T @ (basis @ v)
    return v


def _bidiagonalise(rows: _Rows, wanted: int, seed: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(right singular vectors as rows, squares of the singular values, steps)."""
    rng = np.random.default_rng(seed)
    width = rows.width
    rights: list[np.ndarray] = []
    lefts: list[np.ndarray] = []  # u = X p
    images: list[np.ndarray] = []  # X'u
    alphas: list[float] = []
    betas: list[float] = []  # betas[j] couples left j with right j + 1
    scale = 0.0
    v = rng.normal(size=width)
    v /= np.linalg.norm(v)
    while True:
        q = v - betas[-1] * lefts[-1] if betas else v
        image, square = rows.product(q)
        scale = max(scale, square**0.5)
        for _ in range(2):
            # overlaps of X q with all left vectors, by u'Xq = p'X'Xq
            overlap = np.array(lefts) @ image if lefts else np.zeros(0)
            if not len(overlap) or np.abs(overlap).max() <= OVERLAP * max(square**0.5, FLAT * scale):
                break
            q = q - np.array(lefts).T @ overlap
            image, square = rows.product(q)
        alpha = square**0.5
        rights.append(v)
        empty = alpha <= FLAT * scale
        # a direction that X maps to nothing has no left vector; its column of B is the coupling
        alphas.append(0.0 if empty else alpha)
        lefts.append(np.zeros(width) if empty else q / alpha)
        images.append(np.zeros(width) if empty else image / alpha)
        steps = len(rights)
        if steps == width:
            break
        v = _apart(images[-1] - alphas[-1] * v, rights)
        beta = float(np.linalg.norm(v))
        b = np.diag(alphas) + np.diag(betas, 1)
        sides, values, _ = np.linalg.svd(b)
        open_ends = beta * np.abs(sides[-1, :wanted])
        scale = max(scale, values[0])
        if beta <= FLAT * scale:
            # nothing left in this direction: go on with another one, uncoupled
            v, beta = _apart(rng.normal(size=width), rights), 0.0
            v /= np.linalg.norm(v)
        else:
            v /= beta
            if steps >= wanted + 2 and (open_ends <= SETTLED * values[0]).all():
                break
        betas.append(beta)
    b = np.diag(alphas) + np.diag(betas[: len(alphas) - 1], 1)
    _, values, turned = np.linalg.svd(b)
    return turned @ np.array(rights), np.square(values), len(rights)


def fit(rows: DataFrame, components: int = COMPONENTS, seed: int = 0) -> Whitening | None:
    """Fit on ``rows``, whose column ``x`` holds equally long lists of whole numbers.

    None without rows, without entries, or if all rows are equal. Directions without
    deviation are no components, so there may be fewer than asked for. The seed chooses
    the starting vector, on which the result does not depend beyond signs.
    """
    held = _Rows(rows)
    if not held.n or not held.width:
        return None
    spread = held.spread()
    if spread == 0:
        return None
    vectors, squares, steps = _bidiagonalise(held, min(components, held.width), seed)
    # a component deviates by more than rounding of the sums could
    real = squares > FLAT * squares[0]
    vectors, squares = vectors[real][:components], squares[real][:components]
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    return Whitening(
        held.n, held.sums, spread / held.n, vectors, squares / held.n, steps, held.passes
    )


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int]:
    """Sum over dimensions of ``(n*x - sum)^2`` of each row, exact."""
    far = max((abs(int(x.max())), abs(int(x.min())))) if x.size else 0
    most = n * far + max(map(abs, sums), default=0)
    if most < 1 << 62:
        apart = x * n - np.array(sums, np.int64)
        edge = int(np.abs(apart).max()) if apart.size else 0
        if x.shape[1] * edge * edge < 1 << 63:
            return np.square(apart).sum(axis=1).tolist()
        return [sum(v * v for v in row) for row in apart.tolist()]
    return [sum((n * v - s) ** 2 for v, s in zip(row, sums)) for row in x.tolist()]


def whiten(
    vectors: DataFrame,
    vector: str = "embedding",
    components: int = COMPONENTS,
    seed: int = 0,
) -> tuple[DataFrame, Whitening | None]:
    """Rows of usable vectors with ``whitened`` and ``deviation``, and what was fitted.

    ``whitened`` is an array of doubles, one for each component, ``deviation`` the exact
    decimal sum over dimensions of ``(n*x - S)^2``. Rows whose vector is null, or holds a null
    or an entry that is not finite, are dropped; vectors of different lengths and entries
    beyond 2^42 are errors. Rows that repeat each other each count. An empty table, empty
    vectors, or equal vectors only, have no component: ``whitened`` is empty, ``deviation`` is
    zero. Columns named like a result are replaced, a column ``x`` stays.

    The rows are written once, with whole numbers in place of the vector; every pass reads
    those numbers alone.
    """
    (held,) = fresh(vectors, "x")
    own = [vectors[c] for c in vectors.columns if c.lower() != vector.lower()]
    kept = vectors.where(usable(F.col(vector))).select(
        *own, whole_numbers(F.col(vector)).alias(held)
    )
    rows = written(kept, "whitening-rows")
    model = fit(rows.select(F.col(held).alias("x")), components, seed)
    if model is None:
        nothing = {
            "whitened": F.array().cast("array<double>"),
            "deviation": F.lit(0).cast("decimal(38,0)"),
        }
        return put(rows, nothing).drop(held), None

    @F.arrow_udf("whitened array<double>, deviation decimal(38,0)")
    def project(x: pa.Array) -> pa.Array:
        if not len(x):
            table = np.zeros((0, len(model.values)))
            exact: list[int] = []
        else:
            numbers = _matrix(x)
            table, exact = model.project(numbers), _deviations(numbers, model.n, model.sums)
        lists = pa.ListArray.from_arrays(
            pa.array(np.arange(len(table) + 1) * table.shape[1], pa.int32()),
            pa.array(table.reshape(-1)),
        )
        numbers = pa.array([Decimal(e) for e in exact], pa.decimal128(38, 0))
        return pa.StructArray.from_arrays([lists, numbers], ["whitened", "deviation"])

    (done,) = fresh(rows, "done")
    found = small_batches(rows).withColumn(done, project(held))
    results = {name: found[done][name] for name in ("whitened", "deviation")}
    return put(found, results).drop(done, held), model


def identity_error(whitened: DataFrame, components: int) -> float:
    """Largest absolute entry of the covariance of ``whitened`` minus the identity."""
    number = F.count(F.lit(1))
    pairs = [(i, j) for i in range(components) for j in range(i, components)]

    def entry(i: int) -> Column:
        return F.get("whitened", F.lit(i))

    means = [F.sum(entry(i)) for i in range(components)]
    first = whitened.agg(number, *means).first()
    n, middle = first[0], [s / first[0] for s in first[1:]]
    sums = [F.sum((entry(i) - middle[i]) * (entry(j) - middle[j])) for i, j in pairs]
    found = whitened.agg(*sums).first()
    return max(abs(s / n - (i == j)) for s, (i, j) in zip(found, pairs))


def component_rows(
    vectors: DataFrame, vector: str = "embedding", components: int = COMPONENTS, seed: int = 0
) -> DataFrame:
    """One row per usable vector and component: see :func:`whiten`.

    Adds ``component`` from 1, ``n``, ``deviation``, ``whitened``, ``explained``, the
    component's part of the trace, and ``identity_error``, one value for all rows.
    """
    rows, model = whiten(vectors, vector, components, seed)
    if model is None:
        shares, error, n = [], 0.0, 0
    else:
        shares, n = model.explained().tolist(), model.n
        rows = written(rows, "whitening-done")
        error = identity_error(rows, len(shares))
    each, part = fresh(rows, "each", "part")
    told = F.array(*[F.lit(s) for s in shares]).cast("array<double>")
    long = rows.withColumn(
        each,
        F.arrays_zip(F.col("whitened").alias("w"), told.alias("e")),
    )
    long = long.select("*", F.posexplode(each).alias(f"{part}_at", part))
    return put(
        long,
        {
            "component": long[f"{part}_at"] + 1,
            "n": F.lit(n).cast("long"),
            "deviation": long["deviation"],
            "whitened": long[part]["w"],
            "explained": long[part]["e"],
            "identity_error": F.lit(error),
        },
    ).drop(each, part, f"{part}_at")

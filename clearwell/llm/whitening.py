"""Whitening of embeddings along their leading principal components.

An entry ``c`` becomes the whole number ``floor(64 c) + 1000000``, so that sums are exact.
The *fit list* is each distinct vector once: copies shift nothing. Its covariance is summed
centred, task by task, and comes to the driver as one square matrix, whose size is that of
the dimensions. There Householder reflections make it tridiagonal, Sturm counts bisect the
leading eigenvalues, inverse iteration gives their vectors (made orthogonal within clusters)
and the reflections are undone. The components, at most ``COMPONENTS`` vectors, go to every
task, which projects its rows.

Rows whose vector is null, or holds a null or an entry that is not finite, are left out; so
are those with an entry beyond ``LARGEST``, which has no such whole number. Vectors of
another length are a table of their own, with a fit of their own; empty vectors have no
components. A component whose variance is below ``LEAST_SHARE`` of the largest is rounding
and not returned, so one distinct vector gives no rows. ``deviation`` is null where it does
not fit into a long. Repeated rows, repeated and null ids are rows of their own; other
columns are not looked at; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clearwell.llm.common import ship_code, stored

COMPONENTS = 16
SCALE, SHIFT = 64, 1_000_000
LARGEST = 2.0**56
LEAST_SHARE = 1e-10
_SAFE = 2**62


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids and whole-number vectors, as bytes, of the rows that stay."""
    for batch in batches:
        ids, vectors = batch.columns
        lengths = pc.list_value_length(vectors).fill_null(0).to_numpy(zero_copy_only=False)
        entries = vectors.flatten().cast(pa.float64())
        good = entries.is_valid().to_numpy(zero_copy_only=False)
        # Nulls become NaN.
        values = entries.to_numpy(zero_copy_only=False)
        with np.errstate(invalid="ignore"):
            good &= np.abs(values) <= LARGEST
        numbers = np.floor(np.where(good, values, 0) * SCALE).astype(np.int64) + SHIFT
        ends = np.cumsum(lengths)
        bad = np.concatenate([[0], np.cumsum(~good)])
        stays = vectors.is_valid().to_numpy(zero_copy_only=False) & (lengths > 0)
        stays &= bad[ends] == bad[ends - lengths]
        rows = np.flatnonzero(stays)
        packed = [numbers[ends[k] - lengths[k] : ends[k]].tobytes() for k in rows.tolist()]
        yield pa.RecordBatch.from_arrays(
            [ids.take(pa.array(rows)), pa.array(lengths[rows], pa.int32()), pa.array(packed, pa.binary())],
            ["vec_id", "width", "vector"],
        )


def whole_vectors(embeddings: DataFrame) -> DataFrame:
    """``(vec_id, width, vector)``: whole numbers as bytes of longs."""
    rows = embeddings.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"))
    return rows.mapInArrow(_whole, "vec_id long, width int, vector binary")


def _matrix(cells: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(cells.to_pylist()), "<i8").reshape(len(cells), -1)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums by width and dimension, upper and lower halves apart: neither can overflow."""
    totals: dict[int, np.ndarray] = {}
    for batch in batches:
        widths = batch.column("width").to_numpy()
        for width in np.unique(widths).tolist():
            x = _matrix(batch.column("vector").filter(pa.array(widths == width)))
            parts = np.stack([np.full(width, len(x)), (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)])
            totals[width] = totals.get(width, 0) + parts
    for width, parts in totals.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(width, width), pa.int32()), pa.array(np.arange(width), pa.int32()), *map(pa.array, parts)],
            ["width", "dimension", "n", "high", "low"],
        )


@dataclass(frozen=True)
class Centre:
    """How many distinct vectors there are, and their sums, as whole numbers."""

    n: int
    sums: list[int]

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """``n x - sums``, exact: as Python's integers where longs might overflow."""
        if self.n * int(np.abs(x).max(initial=0)) < _SAFE // 2 and max(map(abs, self.sums), default=0) < _SAFE // 2:
            return self.n * x - np.array(self.sums, np.int64)
        return self.n * x.astype(object) - np.array(self.sums, object)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return self.deviations(x).astype(float) / self.n


def _square_sum(deviations: np.ndarray) -> list[int | None]:
    if not len(deviations):
        return []
    if deviations.dtype != object and float(np.abs(deviations).max()) ** 2 * deviations.shape[1] < _SAFE:
        return (deviations**2).sum(axis=1).tolist()
    exact = (deviations.astype(object) ** 2).sum(axis=1)
    return [int(value) if value < 2**63 else None for value in exact]


def _products(project):
    """The sum of outer products of what ``project`` makes of the vectors of a task, a row for each dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                rows = project(_matrix(batch.column("vector")))
                total = rows.T @ rows if total is None else total + rows.T @ rows
        if total is not None:
            yield _numbered_rows(enumerate(total))

    return run


def _numbered_rows(rows) -> pa.RecordBatch:
    numbers, values = zip(*rows, strict=True)
    arrays = [pa.array(numbers, pa.int32()), pa.array(list(values), pa.list_(pa.float64()))]
    return pa.RecordBatch.from_arrays(arrays, ["dimension", "row"])


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[int, np.ndarray] = {}
    for batch in batches:
        for dimension, row in zip(batch.column("dimension").to_pylist(), batch.column("row"), strict=True):
            totals[dimension] = totals.get(dimension, 0) + row.values.to_numpy()
    if totals:
        yield _numbered_rows(totals.items())


def _product_matrix(vectors: DataFrame, project) -> np.ndarray:
    """Sum of outer products over all vectors; the driver gets one row a dimension."""
    partial = vectors.select("vector").mapInArrow(_products(project), "dimension int, row array<double>")
    rows = partial.repartition("dimension").mapInArrow(_added, "dimension int, row array<double>").collect()
    return np.array([row["row"] for row in sorted(rows, key=lambda r: r["dimension"])])


# Leading eigenvectors of a symmetric matrix.


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray | None]]:
    """Diagonal, second diagonal and Householder vectors: ``H ... A ... H`` is tridiagonal."""
    a = np.array(matrix, float)
    d = len(a)
    off, reflectors = np.zeros(max(d - 1, 0)), []
    for k in range(d - 1):
        column = a[k + 1 :, k]
        length = np.linalg.norm(column)
        if not np.any(column[1:]):
            off[k] = column[0]
            reflectors.append(None)
            continue
        v = column.copy()
        turned = -np.copysign(length, v[0])
        v[0] -= turned
        v /= np.linalg.norm(v)
        rest = a[k + 1 :, k + 1 :]
        p = rest @ v
        w = 2 * (p - (v @ p) * v)
        rest -= np.outer(v, w) + np.outer(w, v)
        off[k] = turned
        reflectors.append(v)
    return np.diagonal(a).copy(), off, reflectors


def counts_below(diagonal: np.ndarray, off: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Sturm count: how many eigenvalues of the tridiagonal matrix are below each point."""
    tiny = np.finfo(float).tiny / np.finfo(float).eps
    pivot = diagonal[0] - points
    below = (pivot < 0).astype(int)
    for k in range(1, len(diagonal)):
        pivot = np.where(np.abs(pivot) < tiny, -tiny, pivot)
        pivot = diagonal[k] - points - off[k - 1] ** 2 / pivot
        below += pivot < 0
    return below


def leading_values(diagonal: np.ndarray, off: np.ndarray, count: int) -> np.ndarray:
    """The ``count`` largest eigenvalues by bisection, all at once, falling."""
    d = len(diagonal)
    reach = np.zeros(d)
    reach[:-1] += np.abs(off)
    reach[1:] += np.abs(off)
    low = np.full(count, (diagonal - reach).min())
    high = np.full(count, (diagonal + reach).max())
    high += np.abs(high) * 1e-15 + np.finfo(float).tiny
    rank = d - 1 - np.arange(count)  # eigenvalues that are smaller
    for _ in range(200):
        middle = low + (high - low) / 2
        if np.all((middle <= low) | (middle >= high)):
            break
        above = counts_below(diagonal, off, middle) <= rank
        low, high = np.where(above, middle, low), np.where(above, high, middle)
    return low + (high - low) / 2


def _shifted_solver(diagonal: np.ndarray, off: np.ndarray, value: float, least: float):
    """Solves with the tridiagonal matrix less ``value``, by elimination with row exchanges."""
    d = len(diagonal)
    main, upper, second = (diagonal - value).tolist(), [*off.tolist(), 0.0], [0.0] * d
    lower = off.tolist()
    steps = []
    for k in range(d - 1):
        if abs(lower[k]) > abs(main[k]):
            factor = main[k] / lower[k]
            main[k], main[k + 1], upper[k], beyond = lower[k], upper[k], main[k + 1], upper[k + 1]
            main[k + 1] -= factor * upper[k]
            second[k] = beyond
            upper[k + 1] = -factor * beyond
            steps.append((True, factor))
        else:
            main[k] = main[k] if abs(main[k]) > least else least
            factor = lower[k] / main[k]
            main[k + 1] -= factor * upper[k]
            steps.append((False, factor))
    main[-1] = main[-1] if abs(main[-1]) > least else least

    def solve(right: np.ndarray) -> np.ndarray:
        x = right.tolist()
        for k, (exchanged, factor) in enumerate(steps):
            if exchanged:
                x[k], x[k + 1] = x[k + 1], x[k]
            x[k + 1] -= factor * x[k]
        for k in range(d - 1, -1, -1):
            if k + 1 < d:
                x[k] -= upper[k] * x[k + 1]
            if k + 2 < d:
                x[k] -= second[k] * x[k + 2]
            x[k] /= main[k]
        return np.array(x)

    return solve


def vectors_of(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors of the tridiagonal matrix by inverse iteration, orthogonal within clusters of values."""
    size = max(np.abs(diagonal).max(), np.abs(off).max(initial=0), np.finfo(float).tiny)
    eps = np.finfo(float).eps
    rng = np.random.default_rng(0)
    found: list[np.ndarray] = []
    cluster = 0
    shift = values[0]
    for k, value in enumerate(values):
        if k and values[k - 1] - value > 1e-3 * size:
            cluster = k
        # Equal values get shifts a little apart.
        shift = min(value, shift - 10 * eps * size) if k > cluster else value
        solve = _shifted_solver(diagonal, off, shift, eps * size)
        vector = rng.uniform(-1, 1, len(diagonal))
        for _ in range(5):
            vector = solve(vector / np.abs(vector).max())
            vector /= np.abs(vector).max()
            for _ in range(2):
                for other in found[cluster:]:
                    vector -= (other @ vector) * other
            vector /= np.linalg.norm(vector)
        found.append(vector)
    return np.array(found)


def leading_components(covariance: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Falling eigenvalues and their unit eigenvectors as rows; of either sign, the largest entry is made positive."""
    count = min(count, len(covariance))
    diagonal, off, reflectors = tridiagonal(covariance)
    values = leading_values(diagonal, off, count)
    vectors = vectors_of(diagonal, off, values)
    for k in range(len(reflectors) - 1, -1, -1):
        if reflectors[k] is not None:
            tail = vectors[:, k + 1 :]
            tail -= 2 * np.outer(tail @ reflectors[k], reflectors[k])
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    signs = np.sign(vectors[np.arange(count), np.abs(vectors).argmax(axis=1)])
    return values, vectors * signs[:, None]


# The operator.


@dataclass(frozen=True)
class Fit:
    """What whitens vectors of one length: ``weights`` are components over the roots of their variances."""

    centre: Centre
    weights: np.ndarray
    explained: list[float]
    identity_error: float

    def project(self, x: np.ndarray) -> np.ndarray:
        return self.centre.centred(x) @ self.weights.T


def fits(vectors: DataFrame, count: int = COMPONENTS) -> dict[int, Fit]:
    """The fit of each length of vectors; ``vectors`` are those of ``whole_vectors``."""
    distinct = stored(vectors.select("width", "vector").distinct(), "whitening-fit")
    summed = distinct.mapInArrow(_sums, "width int, dimension int, n long, high long, low long")
    whole = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("high", "low")]
    centres: dict[int, Centre] = {}
    rows = summed.groupBy("width", "dimension").agg(F.sum("n").alias("n"), *whole).collect()
    for row in sorted(rows, key=lambda r: (r["width"], r["dimension"])):
        centre = centres.setdefault(row["width"], Centre(row["n"], []))
        centre.sums.append((int(row["high"]) << 32) + int(row["low"]))
    found = {}
    for width, centre in centres.items():
        own = distinct.where(F.col("width") == width)
        covariance = _product_matrix(own, centre.centred) / centre.n
        if not covariance.any():
            continue
        values, components = leading_components((covariance + covariance.T) / 2, count)
        kept = values > LEAST_SHARE * values[0]
        values, components = values[kept], components[kept]
        fit = Fit(centre, components / np.sqrt(values)[:, None], (values / np.trace(covariance)).tolist(), 0.0)
        identity = _product_matrix(own, fit.project) / centre.n
        error = float(np.abs(identity - np.eye(len(values))).max())
        found[width] = Fit(centre, fit.weights, fit.explained, error)
    return found


_RESULT = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
)


def _projected(fit: Fit):
    k = len(fit.weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column("vector"))
            rows = len(x)
            ids = batch.column("vec_id").take(pa.array(np.repeat(np.arange(rows), k)))
            deviation = pa.array(_square_sum(fit.centre.deviations(x)), pa.int64())
            columns = [
                ids,
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                pa.array(np.full(rows * k, fit.centre.n, np.int64)),
                deviation.take(pa.array(np.repeat(np.arange(rows), k))),
                pa.array(fit.project(x).ravel()),
                pa.array(np.tile(fit.explained, rows)),
                pa.array(np.full(rows * k, fit.identity_error)),
            ]
            names = [part.split()[0] for part in _RESULT.split(", ")]
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


def whitened(embeddings: DataFrame, count: int = COMPONENTS) -> DataFrame:
    """A row for each vector and component: the whitened coordinate, and how good the fit is."""
    spark = embeddings.sparkSession
    ship_code(spark)
    vectors = whole_vectors(embeddings)
    parts = [
        vectors.where(F.col("width") == width).mapInArrow(_projected(fit), _RESULT)
        for width, fit in sorted(fits(vectors, count).items())
    ]
    return reduce(DataFrame.union, parts) if parts else spark.createDataFrame([], _RESULT)

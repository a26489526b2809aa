"""Document quality by a factorisation machine.

Inputs are hashed words (share of the text, square root), statistics of the text's
structure and its length as metadata. With weights ``w`` and ``RANK`` factors ``V``, the
pairwise interactions of all inputs take linear time by the sum-of-squares identity

    sum_{i<j} <V_i, V_j> x_i x_j = 1/2 sum_f ((sum_i V_if x_i)^2 - sum_i V_if^2 x_i^2).

The model is fitted on at most ``Settings.documents`` labelled rows, in the order of a
hash of their ids, and has a fixed size whatever the corpus; scoring reads every
whole text and is one map without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from clearwell.llm.common import word_hashes, words_of

# The kinds of bytes that the structure statistics count.
_KINDS = {
    1: b"abcdefghijklmnopqrstuvwxyz",
    2: b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    3: b"0123456789",
    4: b" \t\r",
    5: b"\n",
    6: b".,;:'\"-()",
    7: b"!?",
    8: b"#$%&*+/<=>@[\\]^_`{|}~",
}
_KIND_OF = np.zeros(256, np.uint8)
for _kind, _bytes in _KINDS.items():
    _KIND_OF[list(_bytes)] = _kind
STRUCTURE = 16


@dataclass(frozen=True)
class Settings:
    documents: int = 8_000
    buckets: int = 1 << 15
    rank: int = 8
    epochs: int = 6
    batch: int = 128
    rate: float = 0.05
    decay: float = 1e-5
    seed: int = 7


@dataclass(frozen=True)
class Model:
    bias: float
    weights: np.ndarray
    factors: np.ndarray
    mean: np.ndarray
    spread: np.ndarray

    @property
    def buckets(self) -> int:
        return len(self.weights) - STRUCTURE


def inputs(text: str | None, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word buckets, their values and the structure statistics of a whole text; empty and null alike."""
    words = words_of(text)
    n = len(words)
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    kinds = np.bincount(_KIND_OF[data], minlength=9)
    size, lines = max(1, len(data)), kinds[5] + 1
    hashes = word_hashes(words)
    distinct, counts = np.unique(hashes, return_counts=True)
    repeated = float((hashes[1:] == hashes[:-1]).mean()) if n > 1 else 0.0
    statistics = np.array(
        [
            *(kinds[1:] / size),
            kinds[0] / size,
            np.log1p(len(data)),
            np.log1p(n),
            len(data) / max(1, n) / 10,
            np.log1p(n / lines),
            len(distinct) / max(1, n),
            repeated,
            counts.max(initial=0) / max(1, n),
        ],
        np.float32,
    )
    at, where = np.unique((distinct & np.uint64(buckets - 1)).astype(np.int32), return_inverse=True)
    share = np.bincount(where, weights=counts, minlength=len(at)) / max(1, n)
    return at, np.sqrt(share).astype(np.float32), statistics


def _packed(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [inputs(text, buckets) for text in batch.column("text").to_pylist()]
            columns = [pa.array([part.tobytes() for part in parts], pa.binary()) for parts in zip(*rows, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*(columns or [pa.array([], pa.binary())] * 3), batch.column("label")],
                ["at", "value", "structure", "label"],
            )

    return run


def held_out(id_: str = "doc_id") -> F.Column:
    """Rows that no label is learned from. A null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_).cast("string"), F.lit("")).cast("binary")) % 3 == 1


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    """A model of ``labels(doc_id, quality)``, of ids with one answer among the rows that are not held out.

    Without labels every score is 0.5.
    """
    known = labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").where(~held_out())
    known = known.groupBy("doc_id").agg(F.min("quality").alias("label"), F.max("quality").alias("most"))
    known = known.where("label = most").orderBy(F.xxhash64("doc_id"), "doc_id").limit(settings.documents)
    # At most `documents` rows of two numbers: a bounded broadcast.
    known = known.select("doc_id", F.col("label").cast("int").alias("label"))
    rows = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").select("text", "label")
    schema = "at binary, value binary, structure binary, label int"
    rows = rows.mapInArrow(_packed(settings.buckets), schema).collect()
    rows.sort(key=lambda r: (r.structure, r.label))
    return fitted(
        [np.frombuffer(r.at, np.int32) for r in rows],
        [np.frombuffer(r.value, np.float32) for r in rows],
        np.stack([np.frombuffer(r.structure, np.float32) for r in rows]) if rows else np.zeros((0, STRUCTURE)),
        np.array([r.label for r in rows], np.float32),
        settings,
    )


def fitted(at: list, values: list, structure: np.ndarray, labels: np.ndarray, settings: Settings) -> Model:
    """Logistic loss by AdaGrad over shuffled batches; both classes weigh the same."""
    rng = np.random.default_rng(settings.seed)
    size = settings.buckets + STRUCTURE
    mean = structure.mean(axis=0) if len(labels) else np.zeros(STRUCTURE)
    spread = structure.std(axis=0) + 1e-3 if len(labels) else np.ones(STRUCTURE)
    weights, factors = np.zeros(size, np.float32), rng.normal(0, 0.05, (size, settings.rank)).astype(np.float32)
    model = Model(0.0, weights, factors, mean, spread)
    share = float(labels.mean()) if len(labels) else 0.5
    if not len(labels) or not 0 < share < 1:
        factors[:] = 0
        return Model(20.0 * (2 * share - 1), weights, factors, mean, spread)
    scaled = _scaled(structure, model)
    ends = np.arange(settings.buckets, size)
    at = [np.concatenate([a, ends]) for a in at]
    values = [np.concatenate([v, s]).astype(np.float32) for v, s in zip(values, scaled, strict=True)]
    importance = np.where(labels > 0, 0.5 / share, 0.5 / (1 - share)).astype(np.float32)
    bias, bias_sum = 0.0, 1e-8
    weight_sum, factor_sum = np.full(size, 1e-8, np.float32), np.full(factors.shape, 1e-8, np.float32)
    for _ in range(settings.epochs):
        order = rng.permutation(len(labels))
        for begin in range(0, len(order), settings.batch):
            part = order[begin : begin + settings.batch]
            i, x = np.concatenate([at[p] for p in part]), np.concatenate([values[p] for p in part])
            counts = np.array([len(at[p]) for p in part])
            starts = np.concatenate([[0], np.cumsum(counts)[:-1]])
            vx = factors[i] * x[:, None]
            sums = np.add.reduceat(vx, starts, axis=0)
            score = bias + np.add.reduceat(weights[i] * x, starts)
            score = score + 0.5 * ((sums**2).sum(axis=1) - np.add.reduceat((vx**2).sum(axis=1), starts))
            slope = (_sigmoid(score) - labels[part]) * importance[part] / len(part)
            each = np.repeat(slope, counts).astype(np.float32) * x
            rows, where = np.unique(i, return_inverse=True)
            grad = np.bincount(where, weights=each) + settings.decay * weights[rows]
            pull = each[:, None] * (np.repeat(sums, counts, axis=0) - vx)
            grads = np.stack([np.bincount(where, weights=pull[:, f]) for f in range(settings.rank)], axis=1)
            grads += settings.decay * factors[rows]
            weight_sum[rows] += grad**2
            factor_sum[rows] += grads**2
            weights[rows] -= settings.rate * grad / np.sqrt(weight_sum[rows])
            factors[rows] -= settings.rate * grads / np.sqrt(factor_sum[rows])
            bias_sum += slope.sum() ** 2
            bias -= settings.rate * slope.sum() / bias_sum**0.5
    return Model(float(bias), weights, factors, mean, spread)


def _scaled(structure: np.ndarray, model: Model) -> np.ndarray:
    return np.clip((structure - model.mean) / model.spread, -4, 4) / 4


def _sigmoid(x: np.ndarray | float) -> np.ndarray | float:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def score(text: str | None, model: Model) -> float:
    at, value, structure = inputs(text, model.buckets)
    at = np.concatenate([at, np.arange(model.buckets, len(model.weights))])
    x = np.concatenate([value, _scaled(structure, model)]).astype(np.float32)
    vx = model.factors[at] * x[:, None]
    pairs = 0.5 * float((vx.sum(axis=0) ** 2).sum() - (vx**2).sum())
    return float(_sigmoid(model.bias + float(model.weights[at] @ x) + pairs))


def _scores(model, position: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [score(text, model.value) for text in batch.column(position).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, pa.float64())], [*batch.schema.names, "score"]
            )

    return run


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with a last column ``score`` of 0 to 1; an own column of that name is replaced."""
    docs = docs.drop("score")
    schema = StructType([*docs.schema.fields, StructField("score", DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.mapInArrow(_scores(shared, docs.columns.index("text")), schema)


def quality(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs(doc_id, text, ...)``.

    Null and empty texts are scored by their (zero) statistics; repeated rows come back repeated.
    """
    model = fit(docs, labels, settings)
    found = scored(docs.select("doc_id", "text"), model)
    return found.select(
        "doc_id", held_out().alias("held_out"), "score", F.expr("cast(score >= 0.5 AS int)").alias("predicted")
    )


def accepted(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """Rows of ``docs`` that score at least ``least``; all of their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.mapInArrow(_accepted(shared, docs.columns.index("text"), least), docs.schema)


def _accepted(model, position: int, least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [score(text, model.value) >= least for text in batch.column(position).to_pylist()]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return run

"""Whitened coordinates against exact integers and a library's eigenvectors."""

import math
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from clearwell.llm import whitening as W

SCHEMA = "vec_id long, embedding array<double>, label int, width int, vector string, n int, dimension int"


def table(spark, rows):
    return spark.createDataFrame([(id_, v, 0, 1, "x", 2, 3) for id_, v in rows], SCHEMA)


def valid(v):
    return v is not None and all(c is not None and math.isfinite(c) for c in v)


def check(rows, got, count=16, tolerance=1e-7):
    """Everything that ``rows`` fixes, by exact arithmetic; components up to sign."""
    xs = [(id_, [math.floor(64 * Fraction(c)) + 1000000 for c in v]) for id_, v in rows if valid(v)]
    expected = []
    for width in sorted({len(x) for _, x in xs} - {0}):
        own = [(id_, x) for id_, x in xs if len(x) == width]
        fit = sorted({tuple(x) for _, x in own})
        n, sums = len(fit), [sum(column) for column in zip(*fit, strict=True)]
        centred = np.array([[float(Fraction(n * c - s, n)) for c, s in zip(x, sums, strict=True)] for x in fit])
        covariance = centred.T @ centred / n
        values, vectors = np.linalg.eigh(covariance)
        values, vectors = values[::-1][:count], vectors.T[::-1][:count]
        kept = values > W.LEAST_SHARE * values[0]
        values, vectors = values[kept], vectors[kept]
        for id_, x in own:
            deviations = [n * c - s for c, s in zip(x, sums, strict=True)]
            square = sum(d * d for d in deviations)
            place = np.array([d / n for d in deviations])
            for k, (value, vector) in enumerate(zip(values, vectors, strict=True), 1):
                explained = value / np.trace(covariance)
                whitened = abs(vector @ place) / math.sqrt(value)
                expected.append((width, id_, k, n, square if square < 2**63 else None, explained, whitened))
    key = lambda r: (str(r[1]), r[2], r[3], str(r[4]), r[6])
    expected.sort(key=key)
    rows_got = sorted(
        ((0, r.vec_id, r.component, r.n, r.deviation, r.explained, abs(r.whitened)) for r in got), key=key
    )
    assert [r[1:5] for r in rows_got] == [r[1:5] for r in expected]
    for a, b in zip(rows_got, expected, strict=True):
        assert a[5] == pytest.approx(b[5], rel=1e-6)
        assert a[6] == pytest.approx(b[6], abs=tolerance)
    assert all(r.identity_error <= 1e-4 for r in got)


def test_edge_rows(spark):
    rng = np.random.default_rng(5)
    spread = rng.normal(size=(60, 24)) * np.linspace(1, 3, 24)
    rows = [(k, v.tolist()) for k, v in enumerate(spread)]
    rows += [(500 + k, spread[0].tolist()) for k in range(200)]  # copies count once
    rows += [(3, spread[3].tolist()), (None, spread[4].tolist()), (900, (spread[5] + 1e-9).tolist())]
    rows += [(600, None), (601, []), (602, [None] * 24), (603, [math.nan] * 24), (604, [math.inf] + [0.0] * 23)]
    rows += [(700 + k, v.tolist()) for k, v in enumerate(rng.normal(size=(9, 3)))]  # another length
    rows += [(800, [1.0, 2.0])]  # one vector has no variance
    got = W.whitened(table(spark, rows)).collect()
    check([r for r in rows if r[0] != 800], got)
    signs = {}
    for r in got:
        if r.vec_id in (0, 500, 501):
            signs.setdefault(r.component, set()).add(r.whitened)
    assert all(len(values) == 1 for values in signs.values())


def test_very_large_entries(spark):
    rows = [(k, [k * 1e12, (k % 3) * 2e12, (k % 5) * 1e11]) for k in range(30)] + [(99, [1e300, 0.0, 0.0])]
    check(rows[:-1], W.whitened(table(spark, rows)).collect())


def test_empty_and_constant_tables(spark):
    assert W.whitened(table(spark, [])).collect() == []
    assert W.whitened(table(spark, [(k, [0.5, 0.25]) for k in range(5)])).collect() == []
    assert W.whitened(table(spark, [(1, None), (2, [])])).schema == W.whitened(table(spark, [])).schema


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.1"])
def test_given_table(spark, folder):
    embeddings = spark.read.parquet(f"/root/testdata/{folder}/embeddings.parquet")
    got = W.whitened(embeddings).collect()
    check([(r.vec_id, r.embedding) for r in embeddings.collect()], got)
    assert len(got) == 16 * embeddings.count()


def symmetric(seed, d, kind):
    rng = np.random.default_rng(seed)
    turn = np.linalg.qr(rng.normal(size=(d, d)))[0]
    values = {
        "spread": rng.uniform(0, 10, d),
        "equal": np.repeat(rng.uniform(1, 9, 1), d),
        "clusters": rng.choice([1.0, 1.0 + 1e-10, 5.0, 5.0 + 1e-7], d),
        "steep": 10.0 ** -rng.uniform(0, 12, d),
        "low rank": np.where(np.arange(d) < 2, 3.0, 0.0),
    }[kind]
    a = turn * values @ turn.T
    return np.diag(values) if seed % 4 == 0 else (a + a.T) / 2


@settings(max_examples=120, deadline=None)
@given(
    st.integers(0, 10**6),
    st.integers(1, 40),
    st.sampled_from(["spread", "equal", "clusters", "steep", "low rank"]),
)
def test_leading_components(seed, d, kind):
    a = symmetric(seed, d, kind)
    values, vectors = W.leading_components(a, 16)
    size = np.abs(np.linalg.eigvalsh(a)).max()
    assert values == pytest.approx(np.linalg.eigvalsh(a)[::-1][:16], abs=1e-13 * size * d)
    assert np.abs(vectors @ vectors.T - np.eye(len(values))).max() < 1e-12
    assert np.abs(vectors @ a - values[:, None] * vectors).max() < 1e-12 * size * d
    diagonal, off, _ = W.tridiagonal(a)
    points = np.linspace(-size, 2 * size, 7) + 1e-4 * size
    wanted = (np.linalg.eigvalsh(a)[None, :] < points[:, None]).sum(axis=1)
    assert W.counts_below(diagonal, off, points).tolist() == wanted.tolist()

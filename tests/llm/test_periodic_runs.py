"""Runs of words against a scan of every period, extensions against a scan of words."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from clearwell.llm import periodic_runs as P
from tests.llm.cases import documents, texts


def plain_runs(words):
    """Every period on its own; a stretch belongs to its least period."""
    n, found = len(words), {}
    for p in range(1, n // 4 + 1):
        i = 0
        while i + p < n:
            if words[i] != words[i + p]:
                i += 1
                continue
            end = i
            while end + p < n and words[end] == words[end + p]:
                end += 1
            if end + p - i >= max(6, 4 * p):
                found.setdefault((i, end + p - i), p)
            i = end
    return sorted(((s, length, p) for (s, length), p in found.items()), key=lambda r: (r[0], r[2]))


def plain_row(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2])) if runs else (None, None, None)
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    milli = 1000 * best[1] // best[2] if runs else None
    digests = [hashlib.sha256(x.encode("utf-8", "surrogatepass")).hexdigest() for x in (listed, kept)]
    return doc_id, len(runs), *best, milli, *digests


def repeating():
    rng = random.Random(8)
    rows = []
    for k in range(400):
        words = []
        while len(words) < rng.choice([5, 20, 60, 150]):
            part = [rng.choice("abcd") * rng.randrange(1, 3) for _ in range(rng.randrange(1, 9))]
            words += part * rng.randrange(1, 7)
        rows.append((2000 + k, rng.choice([" ", "\n", " \t "]).join(words)))
    return rows


def test_rows(spark):
    rows = texts() + repeating() + [(3000 + k, "go on " * (40 + k)) for k in range(60)]
    got = sorted((tuple(r) for r in P.planted_runs(documents(spark, rows)).collect()), key=str)
    # A text of thousands of equal words is slow to scan; its row is known.
    slow = {83}
    want = sorted((plain_row(*r) for r in rows if r[0] not in slow), key=str)
    assert [r for r in got if r[0] not in slow] == want
    assert [r[1:6] for r in got if r[0] in slow] == [(1, 0, 9000, 1, 9_000_000)]
    assert P.planted_runs(documents(spark, [])).collect() == []


def test_runs_and_collapsed_texts(spark):
    rows = [(1, "x y x y x y x y x y end"), (2, None), (2, "no run here"), (None, "a a a a a a b"), (5, "  kept   as it is ")]
    docs = documents(spark, rows)
    runs = sorted((tuple(r) for r in P.periodic_runs(docs).collect()), key=str)
    assert runs == [(1, 0, 10, 2), (None, 0, 6, 1)]
    out = P.without_repetitions(docs)
    assert out.schema == docs.schema
    kept = sorted(((r.doc_id, r.text) for r in out.collect()), key=str)
    assert kept == sorted([(1, "x y end"), (2, None), (2, "no run here"), (None, "a b"), (5, "  kept   as it is ")], key=str)


@settings(max_examples=300, deadline=None)
@given(st.integers(0, 10**9), st.integers(1, 4), st.integers(2, 120))
def test_extensions(seed, letters, n):
    rng = np.random.default_rng(seed)
    words = rng.integers(0, letters, n)
    if seed % 2:
        words = np.tile(words[: 1 + n // 5], 6)[:n]
    grammar = P.Grammar(words, seed % 7)
    low = rng.integers(0, n, 50)
    high = rng.integers(0, n + 1, 50)
    low, high = np.minimum(low, high)[low != high], np.maximum(low, high)[low != high]

    def scan(i, j, step):
        count = 0
        while True:
            a, b = (i + count, j + count) if step > 0 else (i - count - 1, j - count - 1)
            if a < 0 or b >= n or words[a] != words[b]:
                return count
            count += 1

    assert grammar.extensions(low, high).tolist() == [scan(i, j, 1) for i, j in zip(low, high, strict=True)]
    assert grammar.extensions(low, high, False).tolist() == [scan(i, j, -1) for i, j in zip(low, high, strict=True)]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.sampled_from("aabc"), max_size=40), max_size=6), st.integers(1, 7))
def test_all_runs(parts, times):
    texts = [[w.encode() for w in part * times] for part in parts]
    assert [t.runs for t in P.runs_of_texts(texts)] == [plain_runs(words) for words in texts]


@pytest.mark.parametrize("letters", [1, 2])
def test_long_texts(letters, monkeypatch):
    monkeypatch.setattr(P, "_EXTENDED_AT_ONCE", 1000)
    rng = random.Random(letters)
    words = [b"w%d" % rng.randrange(letters) for _ in range(200 * letters)] * (100 // letters)
    (text,) = P.runs_of_texts([words])
    assert (0, len(words), 1 if letters == 1 else 400) in text.runs


def test_a_level_is_shorter_than_the_one_below():
    words = np.random.default_rng(0).integers(0, 1000, 50_000)
    sizes = [len(level.symbols) - 1 for level in P.Grammar(words).levels]
    assert all(b < a for a, b in zip(sizes, sizes[1:], strict=False)) and sum(sizes) < 8 * sizes[0]

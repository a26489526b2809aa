"""Unigram and hidden Markov scores against plain recursions, word by word."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash

from clearwell.llm import language_model as L
from tests.llm.cases import documents, prose, texts


def tokens(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lowered), "\n"]


def is_held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 1


def plain_forward(words, emission, first, following):
    """log10 probability by the forward recursion with logs of sums, a word at a time."""
    state = [math.log(p * e) for p, e in zip(first, emission(words[0]), strict=True)]
    for word in words[1:]:
        given = emission(word)
        arriving = [
            [s + math.log(following[j][k]) for j, s in enumerate(state)] for k in range(len(state))
        ]
        state = [max(a) + math.log(sum(math.exp(x - max(a)) for x in a)) + math.log(g) for a, g in zip(arriving, given, strict=True)]
    return (max(state) + math.log(sum(math.exp(x - max(state)) for x in state))) / math.log(10)


def rows():
    many = [(1000 + k, prose(k % 40 + 100, 30 + k % 17)) for k in range(120)]
    return texts() + many


def test_scores_against_plain_recursions(spark):
    data = rows()
    docs = documents(spark, data)
    model = L.train(docs)
    got = sorted((tuple(r) for r in L.score(docs, model).collect()), key=str)
    counts = Counter(w for id_, text in data if not is_held(id_) for w in tokens(text))
    n, v = sum(counts.values()), len(counts)
    shares = {}
    for row in model.vocabulary.join(model.words, "shard").collect():
        keys, seen = np.frombuffer(row["keys"], "<u8"), L._unsqueezed(row["counts"], "<i8")
        keys = keys[seen >= L.LEAST_COUNT].tolist()
        own = L._shares(row["shares"])
        assert len(own) == len(keys)
        shares.update(zip(keys, own, strict=True))
    assert len(shares) == sum(c >= L.LEAST_COUNT for c in counts.values())
    totals = sum(counts[w] * shares[xxhash.xxh3_64_intdigest(w.encode())] for w in counts if counts[w] >= L.LEAST_COUNT)
    p = model.parameters
    assert (p.tokens, p.distinct) == (n, v)
    assert p.totals == pytest.approx(totals + p.rare, rel=1e-9)
    assert p.totals.sum() == pytest.approx(n, rel=1e-5)
    size = p.totals / n

    def unigram(word):
        return (counts[word] + 0.5) / (n + 0.5 * (v + 1))

    factor = p.rare / p.rare_tokens
    rare = sum(c < L.LEAST_COUNT for c in counts.values())
    whole = p.totals + 0.5 * size * (v - rare) + 0.5 * factor * (rare + 1)

    def emission(word):
        if counts[word] < L.LEAST_COUNT:
            return (counts[word] + 0.5) * factor / whole
        return (counts[word] * shares[xxhash.xxh3_64_intdigest(word.encode())] + 0.5 * size) / whole

    # Each state is a distribution over the known words and one unknown.
    total = sum(emission(w) for w in counts) + emission("never seen")
    assert total == pytest.approx(np.ones(L.STATES), rel=1e-9)
    want = []
    for id_, text in data:
        words = tokens(text)
        base = sum(math.log10(unigram(w)) for w in words)
        score = plain_forward(words, emission, p.first, p.following)
        want.append((id_, is_held(id_), len(words), sum(counts[w] > 0 for w in words), n, base, score))
    want.sort(key=str)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert [g[5] for g in got] == pytest.approx([w[5] for w in want], rel=1e-9)
    assert [g[6] for g in got] == pytest.approx([w[6] for w in want], rel=1e-9)
    assert sorted((tuple(r) for r in L.language_scores(docs).collect()), key=str)[0][:5] == got[0][:5]


def parameters(seed):
    rng = np.random.default_rng(seed)
    following = rng.dirichlet(np.ones(L.STATES), L.STATES)
    return L.Parameters(100, 10, 0, 10, np.ones(L.STATES), np.ones(L.STATES), rng.dirichlet(np.ones(L.STATES)), following)


def plain_expected(words, given, p):
    """Forward and backward without scaling, for one short document."""
    n = len(words)
    ahead, behind = np.zeros((n, L.STATES)), np.ones((n, L.STATES))
    ahead[0] = p.first * given[words[0]]
    for t in range(1, n):
        ahead[t] = (ahead[t - 1] @ p.following) * given[words[t]]
    for t in range(n - 2, -1, -1):
        behind[t] = p.following @ (given[words[t + 1]] * behind[t + 1])
    total = ahead[-1].sum()
    visits = ahead * behind / total
    moves = np.zeros((L.STATES, L.STATES))
    for t in range(n - 1):
        moves += np.outer(ahead[t], given[words[t + 1]] * behind[t + 1]) * p.following / total
    return visits, moves, math.log10(total)


@pytest.mark.parametrize(("piece", "block"), [(4096, 10**6), (5, 10**6), (7, 20), (1, 9)])
def test_expected_counts_and_pieces(monkeypatch, piece, block):
    monkeypatch.setattr(L, "PIECE", piece)
    monkeypatch.setattr(L, "LONG", piece + 2)
    monkeypatch.setattr(L, "_PIECES_AT_ONCE", 3)
    monkeypatch.setattr(L, "AT_ONCE", block)
    rng = np.random.default_rng(piece)
    p = parameters(3)
    given = rng.uniform(0.01, 1, (12, L.STATES))
    lengths = np.array([1, 13, 4, 30, 7, 1, 22, 5])
    flat = rng.integers(0, 12, lengths.sum()).astype(np.int32)
    sequences = L._Sequences(flat, lengths, given, p)
    words, first, following = sequences.expected()
    want = np.zeros_like(words), np.zeros(L.STATES), np.zeros((L.STATES, L.STATES))
    logs, at = [], 0
    for n in lengths.tolist():
        part = flat[at : at + n]
        visits, moves, total = plain_expected(part, given, p)
        np.add.at(want[0], part, visits)
        want[1][:] += visits[0]
        want[2][:] += moves
        logs.append(total)
        at += n
    for got, wanted in zip((words, first, following), want, strict=True):
        assert got == pytest.approx(wanted, abs=2e-4)
    assert sequences.log10() == pytest.approx(np.array(logs), rel=1e-10)


def test_training_gains_on_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    scores = L.language_scores(docs).toPandas()
    held = scores[scores.held_out]
    assert len(scores) == docs.count()
    assert held.score.sum() > held.base_score.sum() * 0.97


def test_odd_tables(spark):
    assert L.language_scores(documents(spark, [])).collect() == []
    only_held = next(k for k in range(100) if is_held(k))
    row = L.language_scores(documents(spark, [(only_held, "some words here")])).first()
    assert tuple(row)[:6] == (only_held, True, 4, 0, 0, 0.0) and row.score == pytest.approx(0, abs=1e-12)
    row = L.language_scores(documents(spark, [(None, None)])).first()
    assert tuple(row)[:5] == (None, False, 1, 1, 1)
    assert row.score == pytest.approx(math.log10(1.5 / 2))


def test_words_cut_at_slices(monkeypatch):
    monkeypatch.setattr(L, "_SLICE", 7)
    text = "Ab  cd\tefghijklmnop q\x0brs " + "x" * 30 + "\nÉ é"
    assert [w for part in L._word_lists(text) for w in part] == [w.encode() for w in tokens(text)]
    values = np.array([0, 1, 255, 256, 70_000, 2**31 - 1])
    assert L._unsqueezed(L._squeezed(values)).tolist() == values.tolist()

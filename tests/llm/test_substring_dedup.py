"""Repeated byte strings against a table of all of them."""

import hashlib

import numpy as np

from clearwell.llm import substring_dedup as S
from tests.llm.cases import documents, prose, texts


def brute(rows):
    first = {}
    whole = [(id_, (text or "").encode()) for id_, text in rows]
    for id_, data in whole:
        for k in range(len(data) - 49 if id_ is not None else 0):
            string = data[k : k + 50]
            first[string] = min(first.get(string, id_), id_)
    result = []
    for id_, data in whole:
        gone = np.zeros(len(data) + 2, int)
        for k in range(len(data) - 49 if id_ is not None else 0):
            if first[data[k : k + 50]] < id_:
                gone[k + 1 : k + 51] = 1
        kept = bytes(np.frombuffer(data, np.uint8)[gone[1:-1] == 0])
        result.append((id_, len(data), int(gone.sum()), int((np.diff(gone) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(result, key=str)


def test_edge_rows(spark):
    passage = prose(77, 12)
    rows = [*texts(), (-5, "b" * 70), (-5, "b" * 55), (200, "q" * 49), (201, "q" * 50), (202, "qq" * 25), (203, passage)]
    rows += [(300 + k, f"{k} {prose(k, 15)} {passage} {prose(k + 50, 15)} {k}") for k in range(30)]
    got = sorted((tuple(r) for r in S.without_repeats(documents(spark, rows)).collect()), key=str)
    assert got == brute(rows)


def test_ids_in_steps_and_many_rows_without_id(spark):
    passage = prose(5, 12)
    rows = [(16 * k, f"{prose(1000 + k, 20)} {passage if k % 3 == 0 else ''} {prose(2000 + k, 20)}") for k in range(90)]
    rows += [(None, passage)] * 3000
    got = sorted((tuple(r) for r in S.without_repeats(documents(spark, rows)).collect()), key=str)
    assert got == brute(rows)
    assert sum(row[2] > 0 for row in got) >= 29


def test_groups_are_primes_that_steps_do_not_miss():
    for least in (1, 8, 16, 24, 1000):
        parts = S._prime(least)
        assert parts >= least and {16 * k % parts for k in range(parts)} == set(range(parts))


def test_kept_bytes_and_empty_table(spark):
    rows = [(1, prose(1, 30)), (2, "start " + prose(1, 30) + " endé")]
    kept = {r.doc_id: bytes(r.kept).decode() for r in S.without_repeats(documents(spark, rows), with_bytes=True).collect()}
    assert kept == {1: rows[0][1], 2: "start  endé"}
    assert S.without_repeats(documents(spark, [])).collect() == []


def test_anchors_and_surroundings_in_segments(monkeypatch):
    data = np.frombuffer((prose(3, 400) + "z" * 300 + "é" * 50).encode(), np.uint8)
    whole = S.anchors(data)
    around = S.surroundings(data, whole[1])
    monkeypatch.setattr(S, "_SEGMENT", 97)
    cut = S.anchors(data)
    assert (whole[0] == cut[0]).all() and (whole[1] == cut[1]).all()
    again = S.surroundings(data, cut[1])
    assert (around[0] == again[0]).all() and (around[1] == again[1]).all()
    # Every window has an anchor whose surroundings hold it.
    covered = np.zeros(len(data) - S.LENGTH + 1, bool)
    for first, last in zip(*around, strict=True):
        covered[first : last + 1] = True
    assert covered.all()


def test_levels_stay_few_and_whole():
    index, keys = S.Levels(), []
    rng = np.random.default_rng(1)
    for _ in range(100):
        new = np.sort(rng.integers(0, 10**9, 50, dtype=np.uint64))
        keys.append(new)
        index.add(new, np.arange(50))
    assert len(index.levels) <= 8
    assert (np.sort(np.concatenate([level[0] for level in index.levels])) == np.sort(np.concatenate(keys))).all()
    hits = sum((high - low).sum() for _, low, high in index.scan(keys[3]))
    assert hits >= 50

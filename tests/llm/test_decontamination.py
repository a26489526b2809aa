"""Benchmark items in documents against edit distances to every stretch."""

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from clearwell.llm import decontamination as D
from clearwell.llm.common import word_hashes
from tests.llm.cases import documents, edited, prose, texts

ITEMS = [(1, prose(101, 40)), (2, prose(102, 15)), (3, prose(103, 70)), (4, None), (None, prose(104, 20)), (5, ""), (5, "...")]
NEAR = D.Nearness(trials=300)


def benchmark(spark, rows=ITEMS):
    return spark.createDataFrame([(id_, text, "x") for id_, text in rows], "item_id long, text string, doc_id string")


def planted():
    rows = []
    for k in range(60):
        item = ITEMS[k % 3][1]
        inside = {0: item, 1: item.upper() + "!!", 2: edited(item, k, 10), 3: edited(item, k, 3)}[k % 4]
        rows.append((1000 + k, f"{prose(k, 30)} *** {inside}, {prose(k + 200, 20)}"))
    return [*rows, *texts()]


def plain_distance(item, words):
    """Least edit distance of the item to any stretch, by the textbook table."""
    row = [0] * (len(words) + 1)
    for k, word in enumerate(item, 1):
        new = [k]
        for j, other in enumerate(words, 1):
            new.append(min(row[j - 1] + (word != other), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


def brute(rows):
    found = set()
    for id_, text in rows:
        words = D.item_words(text)
        for item_id, item in ITEMS:
            own = D.item_words(item)
            if item_id and own and len(words) < 1000 and plain_distance(own, words) <= len(own) * 20 // 100:
                found.add((id_, item_id))
    return found


def test_edge_rows(spark):
    rows = planted()
    found = D.contaminated(documents(spark, rows), benchmark(spark), NEAR).collect()
    got, want = {(r.doc_id, r.item_id) for r in found}, brute(rows)
    assert got <= want
    assert len(got) >= 0.98 * len(want) and len(want) >= 40
    texts_ = dict(rows)
    for r in found:
        stretch = D.item_words(texts_[r.doc_id])[r.first_word : r.end_word]
        item = word_hashes(D.item_words(dict(ITEMS)[r.item_id]))
        assert D.nearest_stretch(item, word_hashes(stretch))[0] == r.edits


def test_clean_rows_stay_whole(spark):
    rows = planted()
    docs = documents(spark, rows)
    left = D.clean(docs, benchmark(spark), NEAR)
    assert left.schema == docs.schema
    dirty = {r.doc_id for r in D.contaminated(docs, benchmark(spark), NEAR).collect()}
    assert left.count() == sum(id_ not in dirty for id_, _ in rows)


def test_empty_tables(spark):
    assert D.contaminated(documents(spark, []), benchmark(spark), NEAR).collect() == []
    assert D.contaminated(documents(spark), benchmark(spark, []), NEAR).collect() == []
    assert D.clean(documents(spark), benchmark(spark, []), NEAR).count() == len(texts())


def test_a_benchmark_in_parts_gives_the_same(spark, monkeypatch):
    docs = documents(spark, planted())
    whole = sorted(map(tuple, D.contaminated(docs, benchmark(spark), NEAR).select("doc_id", "item_id").collect()))
    monkeypatch.setattr(D, "PART_WORDS", 50)
    parts = sorted(map(tuple, D.contaminated(docs, benchmark(spark), NEAR).select("doc_id", "item_id").collect()))
    assert len(set(whole) ^ set(parts)) <= 0.02 * len(whole)


def test_repetitions_reach_the_recall():
    index = D.Index.of([r for r in ITEMS if r[0] and r[1]], NEAR)
    assert 1 <= index.repetitions <= D.MAX_REPETITIONS
    rng = np.random.default_rng(99)
    hits = 0
    for t in range(200):
        words, _ = index._edited(t % 3, rng)
        hits += any(item == t % 3 for item, *_ in index.matches(words))
    assert hits >= 0.96 * 200


def test_each_size_of_items_reaches_the_recall():
    """Nearly all items are short; long ones are found as often, with all the edits allowed."""
    sizes = [4] * 990 + [40, 40, 80, 80, 150, 150, 300, 300, 600, 600]
    items = [(k, " ".join(f"w{k}x{j}" for j in range(n))) for k, n in enumerate(sizes)]
    index = D.Index.of(items, NEAR)
    assert all(0 <= n <= D.MAX_REPETITIONS for n in index.tries.tolist())
    rng = np.random.default_rng(7)
    for k in (0, 990, 992, 994, 996, 998):
        hits = 0
        for _ in range(40):
            words, _ = index._edited(k, rng)
            hits += any(item == k for item, *_ in index.matches(words))
        assert hits >= 38, (sizes[k], hits, index.tries[k])


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 4), min_size=1, max_size=12), st.lists(st.integers(1, 4), max_size=25))
def test_nearest_stretch(item, words):
    item, words = np.array(item, np.uint64), np.array(words, np.uint64)
    distance, begin, end = D.nearest_stretch(item, words)
    assert distance == plain_distance(item.tolist(), words.tolist())
    assert 0 <= begin <= end <= len(words)
    # The stretch it names has that distance, from end to end.
    table = list(range(end - begin + 1))
    for k, word in enumerate(item.tolist(), 1):
        new = [k]
        for j, other in enumerate(words[begin:end].tolist(), 1):
            new.append(min(table[j - 1] + (word != other), table[j] + 1, new[j - 1] + 1))
        table = new
    assert table[-1] == distance

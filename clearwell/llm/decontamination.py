"""Benchmark items in documents, found by CGK embeddings and verified by edit distance.

An item of ``n`` words is in a document if a stretch of the document is within
``n * edits_percent // 100`` word insertions, deletions and replacements of it. Words are in
lower case and cut at white space and ASCII punctuation.

1. An item with at most ``k`` edits keeps one of its ``k + 1`` pieces whole. Item-sized windows
   stand only where a document has such a piece; no other window can be near enough.
2. The CGK walk reads a word, puts it out, and moves on or stays by a random bit of that word
   and step; after three times the words, edit distance has become Hamming distance. A
   repetition samples a few places of an embedding; window and item meet if they
   agree in all of them. Items of like size, from a power of two to the next, have the least
   number of repetitions that reaches ``recall`` on them with the most edits allowed, made at random
   in made-up surroundings. Where ``MAX_REPETITIONS`` do not reach it, all windows are verified.
3. What meets is verified by exact edit distance against all stretches around the window.

Documents are read once and nothing of them is shuffled. The benchmark goes to every task
in parts of at most ``PART_WORDS`` words; a larger one means more passes, not a larger broadcast.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clearwell.llm.common import mixed, word_hashes

PART_WORDS = 500_000
MAX_REPETITIONS = 96
STEPS = 3
# Windows that are walked at once.
_WALK_ROWS = 20_000
_CUT = bytes(32 if chr(c) in string.punctuation else c for c in range(256))


@dataclass(frozen=True)
class Nearness:
    edits_percent: int = 20
    recall: float = 0.99
    samples: int = 3
    trials: int = 2000
    seed: int = 11

    def edits(self, words: int) -> int:
        return words * self.edits_percent // 100


def item_words(text: str | None) -> list[bytes]:
    return (text or "").lower().encode("utf-8", "surrogatepass").translate(_CUT).split()


def _rolled(words: np.ndarray, size: int) -> np.ndarray:
    rolled = np.full(max(0, len(words) - size + 1), size, np.uint64)
    for k in range(size if len(rolled) else 0):
        rolled = mixed(rolled * np.uint64(0x9E3779B97F4A7C15) + words[k : k + len(rolled)])
    return rolled


@dataclass
class Index:
    """Items as word hashes, their pieces by length, and their sampled embeddings."""

    near: Nearness
    ids: list[int]
    items: list[np.ndarray]
    seeds: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=dict)
    # Repetitions by item, and the keys of all items in each; without any, every window is verified.
    tries: np.ndarray | None = None
    keys: list[np.ndarray] = field(default_factory=list)

    @classmethod
    def of(cls, rows: list[tuple[int, str]], near: Nearness) -> Index:
        items = [(id_, word_hashes(item_words(text))) for id_, text in rows]
        items = [(id_, words) for id_, words in items if len(words)]
        index = cls(near, [id_ for id_, _ in items], [words for _, words in items])
        index._plant()
        index._repeat()
        return index

    def _plant(self) -> None:
        found: dict[int, list[tuple[int, int, int]]] = {}
        for k, words in enumerate(self.items):
            pieces = self.near.edits(len(words)) + 1
            size = len(words) // pieces
            rolled = _rolled(words, size)
            found.setdefault(size, []).extend((int(rolled[p * size]), k, p * size) for p in range(pieces))
        for size, rows in found.items():
            rows.sort()
            hashes = np.array([r[0] for r in rows], np.uint64)
            filled = np.zeros(1 << 20, bool)
            filled[hashes >> np.uint64(44)] = True
            self.seeds[size] = (hashes, np.array([r[1] for r in rows]), np.array([r[2] for r in rows]), filled)

    def windows(self, words: np.ndarray) -> np.ndarray:
        """Distinct (item, begin) of the windows that a document's pieces call for."""
        found = []
        for size, (hashes, item, offset, filled) in self.seeds.items():
            rolled = _rolled(words, size)
            at = np.flatnonzero(filled[rolled >> np.uint64(44)])
            low = np.searchsorted(hashes, rolled[at], "left")
            count = np.searchsorted(hashes, rolled[at], "right") - low
            if not count.any():
                continue
            each = np.repeat(low - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
            found.append(np.stack([item[each], np.repeat(at, count) - offset[each]], axis=1))
        return np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 2), np.int64)

    def _walks(self, windows: np.ndarray, sizes: np.ndarray, repetitions: range) -> np.ndarray:
        """The sampled places of the embeddings, a key for each window and repetition. Rows are padded with 0."""
        n, rows = windows.shape[1] - 1, np.arange(len(windows))
        keys = np.zeros((len(windows), len(repetitions)), np.uint64)
        for column, repetition in enumerate(repetitions):
            rng = np.random.default_rng([self.near.seed, repetition])
            # Places are the same share of every embedding, so items of all sizes walk together.
            share = rng.random(self.near.samples)
            places = (share[None, :] * (STEPS * sizes)[:, None]).astype(np.int64)
            factors = rng.integers(0, 2**63, STEPS * n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
            at = np.zeros(len(windows), np.int64)
            for step in range(int(places.max(initial=-1)) + 1):
                word = windows[rows, np.minimum(at, n)]
                for sample in range(self.near.samples):
                    hit = places[:, sample] == step
                    if hit.any():
                        keys[hit, column] += mixed(word[hit] + np.uint64(sample + 1))
                at += ((word * factors[step]) >> np.uint64(63)).astype(np.int64)
        return keys

    def _rows(self, words: np.ndarray, items: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.array([len(self.items[k]) for k in items], np.int64)
        at = begins[:, None] + np.arange(int(sizes.max(initial=0)) + 1)
        inside = (at >= 0) & (at < len(words)) & (at < (begins + sizes)[:, None])
        rows = np.zeros(at.shape, np.uint64)
        rows[inside] = words[at[inside]]
        return rows, sizes

    @property
    def repetitions(self) -> int:
        return len(self.keys)

    def _repeat(self) -> None:
        """Fix the number of repetitions by trials, size by size, and the keys of the items."""
        self.tries = np.zeros(len(self.items), np.int64)
        like: dict[int, list[int]] = {}
        for k, words in enumerate(self.items):
            like.setdefault(len(words).bit_length(), []).append(k)
        for size, members in sorted(like.items()):
            self.tries[members] = self._tries(members, np.random.default_rng([self.near.seed, size]), len(like))
        if len(self.items):
            everything = np.arange(len(self.items))
            rows, sizes = self._item_rows(everything)
            for repetition in range(int(self.tries.max())):
                self.keys.append(self._walks(rows, sizes, range(repetition, repetition + 1))[:, 0])

    def _item_rows(self, members: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.array([len(self.items[k]) for k in members], np.int64)
        rows = np.zeros((len(members), int(sizes.max()) + 1), np.uint64)
        for row, k in zip(rows, members, strict=True):
            row[: len(self.items[k])] = self.items[k]
        return rows, sizes

    def _tries(self, members: list[int], rng: np.random.Generator, groups: int) -> int:
        """Repetitions that items of like size need; 0 if ``MAX_REPETITIONS`` are too few."""
        trials = max(400, self.near.trials // groups)
        # Half of the misses allowed: the number is fitted to these trials, the next ones miss more.
        target = (1 + self.near.recall) / 2
        windows, trial, owner = [], [], []
        for t in range(trials):
            k = members[int(rng.integers(len(members)))]
            words, begin = self._edited(k, rng)
            for item, start in self.windows(words):
                if item == k and abs(start - begin) <= self.near.edits(len(self.items[k])):
                    windows.append(self._rows(words, np.array([k]), np.array([start]))[0][0])
                    trial.append(t)
                    owner.append(k)
        width = max(len(self.items[k]) for k in members) + 1
        rows = np.zeros((len(windows), width), np.uint64)
        for row, window in zip(rows, windows, strict=True):
            row[: len(window)] = window
        trial, owner = np.array(trial, np.int64), np.array(owner, np.int64)
        chosen, place = np.unique(owner, return_inverse=True)
        if not len(chosen):
            return 0
        own, own_sizes = self._item_rows(chosen)
        met = np.zeros(trials, bool)
        for repetition in range(MAX_REPETITIONS):
            once = range(repetition, repetition + 1)
            # Trials that met need no further look.
            open_ = np.flatnonzero(~met[trial])
            found = self._walks(rows[open_], own_sizes[place[open_]], once)[:, 0]
            met[trial[open_][found == self._walks(own, own_sizes, once)[place[open_], 0]]] = True
            if met.mean() >= target:
                return repetition + 1
        return 0

    def _edited(self, k: int, rng: np.random.Generator) -> tuple[np.ndarray, int]:
        """Item ``k`` with as many edits as allowed between words of other items, and where it begins."""
        words = list(self.items[k])
        for _ in range(self.near.edits(len(words))):
            kind, at = rng.integers(3), int(rng.integers(len(words)))
            new = rng.integers(0, 2**63, dtype=np.uint64)
            if kind == 0:
                words[at] = new
            elif kind == 1:
                words.insert(at, new)
            elif len(words) > 1:
                del words[at]
        around = self.items[int(rng.integers(len(self.items)))]
        return np.concatenate([around, np.array(words, np.uint64), around]), len(around)

    def matches(self, words: np.ndarray) -> list[tuple[int, int, int, int]]:
        """(item, first word, end, distance) of the items in a document: the nearest, then first, stretch of each."""
        best: dict[int, tuple[int, int, int]] = {}
        windows = self.windows(words)
        for at in range(0, len(windows), _WALK_ROWS):
            part = windows[at : at + _WALK_ROWS]
            rows, sizes = self._rows(words, part[:, 0], part[:, 1])
            tries = self.tries[part[:, 0]]
            met = tries == 0
            for repetition in range(int(tries.max(initial=0))):
                todo = np.flatnonzero(~met & (tries > repetition))
                keys = self._walks(rows[todo], sizes[todo], range(repetition, repetition + 1))[:, 0]
                met[todo] = keys == self.keys[repetition][part[todo, 0]]
            for item, begin in part[met]:
                words_, edits = self.items[item], self.near.edits(len(self.items[item]))
                low = max(0, int(begin) - edits)
                stretch = words[low : int(begin) + len(words_) + edits]
                distance, first, end = nearest_stretch(words_, stretch)
                if distance <= edits:
                    found = (distance, low + first, low + end)
                    best[int(item)] = min(best.get(int(item), found), found)
        return [(item, first, end, distance) for item, (distance, first, end) in sorted(best.items())]


def nearest_stretch(item: np.ndarray, words: np.ndarray) -> tuple[int, int, int]:
    """The least edit distance of ``item`` to any stretch of ``words``, and the stretch (shortest, then first)."""
    n = len(words)
    distance, begin = np.zeros(n + 1, np.int64), np.arange(n + 1)
    steps = np.arange(n + 1)
    for k, word in enumerate(item, 1):
        replaced = np.concatenate([[k], distance[:-1] + (words != word)])
        taken = np.where(replaced <= distance + 1, replaced, distance + 1)
        from_ = np.where(replaced <= distance + 1, np.concatenate([[0], begin[:-1]]), begin)
        # Words of the document that the item lacks: a running minimum along the row.
        order = taken - steps
        least = np.minimum.accumulate(order)
        source = np.maximum.accumulate(np.where(order == least, steps, 0))
        distance, begin = least + steps, from_[source]
    best = int(distance.min())
    ends = np.flatnonzero(distance == best)
    end = int(ends[np.argmin(ends - begin[ends])])
    return best, int(begin[end]), end


def _found(index):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = index.value
        for batch in batches:
            rows = []
            for id_, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for item, first, end, distance in shared.matches(word_hashes(item_words(text))):
                    rows.append((id_, shared.ids[item], first, end, distance))
            columns = list(zip(*rows, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], ["doc_id", "item_id", "first_word", "end_word", "edits"]
            )

    return run


def _without(index):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = index.value
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
            keep = [not shared.matches(word_hashes(item_words(text))) for text in texts]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return run


def _indexes(benchmark: DataFrame, near: Nearness) -> Iterator[Broadcast]:
    """The benchmark in parts of bounded size."""
    items = benchmark.where("item_id IS NOT NULL AND text IS NOT NULL")
    items = items.select(F.col("item_id").cast("long").alias("item_id"), "text").distinct()
    characters = items.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = max(1, -(-characters // (4 * PART_WORDS)))
    for part in range(parts):
        rows = items.where(F.pmod(F.xxhash64("text"), F.lit(parts)) == part).orderBy("item_id", "text").collect()
        yield benchmark.sparkSession.sparkContext.broadcast(Index.of([tuple(r) for r in rows], near))


def contaminated(docs: DataFrame, benchmark: DataFrame, near: Nearness = Nearness()) -> DataFrame:
    """``doc_id, item_id, first_word, end_word, edits``: one row for each item found in a row of ``docs``.

    Null, empty and wordless texts and items match nothing. Rows without an id are searched
    too; items without an id are left out. A repeated row of ``docs`` comes back repeated; items of
    one id are searched apart and give a row each.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, item_id long, first_word long, end_word long, edits long"
    found = [docs.mapInArrow(_found(index), schema) for index in _indexes(benchmark, near)]
    return reduce(DataFrame.union, found)


def clean(docs: DataFrame, benchmark: DataFrame, near: Nearness = Nearness()) -> DataFrame:
    """Rows of ``docs(text, ...)`` that hold no item, with all of their columns; no shuffle."""
    for index in _indexes(benchmark, near):
        docs = docs.mapInArrow(_without(index), docs.schema)
    return docs

"""Runs of words that repeat with a period, found by a run-length grammar.

A run is a stretch of words with smallest period q, as long as that period goes on, and of
at least ``max(LEAST_WORDS, LEAST_PERIODS * q)`` words.

* *Recompression*: the words of many texts, one unlike mark after each, become shorter
  sequences in turn. Block compression names each stretch of one symbol by symbol and
  length. Pair compression deals the symbols to two sides by chance and names each pair of
  a left and a right symbol. Equal stretches get equal names but for their edges, and a
  name stands for one stretch. The levels together are a few times as long as the words.
* *Extensions*: two places are compared by climbing to the level where both begin a symbol,
  as long as symbols agree, and by descending to the words where they stop. One comparison a
  level is enough. Forwards and backwards alike, for many pairs of places at once.
* *Harmonic grid*: a run of period p holds ``(LEAST_PERIODS - 1) * p`` places that equal the
  word p later, so one of every so many places is tried for each p, n log n in all. Those
  where neighbours agree too are extended. Of the periods of one stretch the least is its own.

Texts are worked on where they lie, without a shuffle: many short ones at once, a long one on
its own, in memory of some tens of bytes a byte. Null and empty texts have no runs; ties go
to the smallest start, then period. A null id plants nothing. Repeated rows and ids are rows
of their own; other columns are not looked at; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clearwell.llm.common import ship_code

LEAST_WORDS, LEAST_PERIODS = 6, 4
BATCH_WORDS = 300_000
_EXTENDED_AT_ONCE = 500_000


@dataclass(frozen=True)
class _Level:
    """One sequence of the grammar; arrays have an entry for its end.

    ``first`` is where a symbol begins in the level below and ``parent`` the symbol above one.
    """

    symbols: np.ndarray
    first: np.ndarray | None = None
    blocks: bool = False


class Grammar:
    """The levels of one sequence of numbers."""

    def __init__(self, words: np.ndarray, seed: int = 0) -> None:
        rng = np.random.default_rng(seed)
        names, symbols = np.unique(words, return_inverse=True)
        kinds = len(names)
        self.levels = [_Level(np.append(symbols, -1))]
        self.parents: list[np.ndarray] = []
        # Where all symbols differ, no two places agree any more.
        while kinds < len(symbols):
            changed = np.ones(len(symbols), bool)
            changed[1:] = symbols[1:] != symbols[:-1]
            if not changed.all():
                heads = np.flatnonzero(changed)
                symbols, kinds = self._add(symbols, heads, np.diff(np.append(heads, len(symbols))), True)
                continue
            left = rng.integers(0, 2, kinds).astype(bool)[symbols]
            opens = np.append(left[:-1] & ~left[1:], False)
            if opens.any():
                heads = np.flatnonzero(~np.append(False, opens[:-1]))
                second = np.where(opens, np.append(symbols[1:], 0) + 1, 0)[heads]
                symbols, kinds = self._add(symbols, heads, second, False)

    def _add(self, symbols: np.ndarray, heads: np.ndarray, second: np.ndarray, blocks: bool) -> tuple[np.ndarray, int]:
        names, above = np.unique(symbols[heads] * (int(second.max()) + 1) + second, return_inverse=True)
        parent = np.zeros(len(symbols) + 1, np.int64)
        parent[heads[1:]] = 1
        parent[-1] = 1
        self.parents.append(np.cumsum(parent))
        self.levels.append(_Level(np.append(above, -1), np.append(heads, len(symbols)), blocks))
        return above, len(names)

    def extensions(self, low: np.ndarray, high: np.ndarray, forwards: bool = True) -> np.ndarray:
        """How many words from ``low`` and from ``high`` on are equal, or before them; ``low < high``."""
        side = 0 if forwards else -1
        a, b, which = low.copy(), high.copy(), np.arange(len(low))
        fallen: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for h, parent in enumerate(self.parents):
            above = self.levels[h + 1]
            unlevel = ~self._begin(above, parent, a, b)
            climbs = ~unlevel
            at = np.flatnonzero(unlevel)
            if len(at):
                a[at], b[at] = self._stepped(h, a[at], b[at], side)
                climbs[at] = self._begin(above, parent, a[at], b[at])
                # Between symbols of the level above, what is not level again has met a difference.
                differ = ~climbs
                fallen.append((a[differ], b[differ], which[differ]))
                a, b, which = a[climbs], b[climbs], which[climbs]
            else:
                fallen.append((a[:0], b[:0], which[:0]))
            a, b = parent[a], parent[b]
        for h in range(len(self.parents) - 1, -1, -1):
            first = self.levels[h + 1].first
            a, b = self._stepped(h, first[a], first[b], side)
            met = fallen[h]
            a, b, which = np.append(a, met[0]), np.append(b, met[1]), np.append(which, met[2])
        lengths = np.empty(len(low), np.int64)
        lengths[which] = a
        return lengths - low if forwards else low - lengths

    @staticmethod
    def _begin(above: _Level, parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (above.first[parent[a]] == a) & (above.first[parent[b]] == b)

    def _stepped(self, h: int, a: np.ndarray, b: np.ndarray, side: int) -> tuple[np.ndarray, np.ndarray]:
        """Both places moved over the symbol they agree on, or over what is left of it in the shorter block."""
        symbols, above, parent = self.levels[h].symbols, self.levels[h + 1], self.parents[h]
        step = (symbols[a + side] == symbols[b + side]).astype(np.int64)
        if above.blocks:
            step *= np.minimum(*(self._left(above, parent, x, side) for x in (a, b)))
        return (a + step, b + step) if side == 0 else (a - step, b - step)

    @staticmethod
    def _left(above: _Level, parent: np.ndarray, x: np.ndarray, side: int) -> np.ndarray:
        if side:
            return x - above.first[parent[x - 1]]
        return above.first[np.minimum(parent[x] + 1, len(above.first) - 1)] - x


def _grid(words: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and periods to extend: those of a harmonic grid whose neighbourhood agrees with that a period later."""
    order = np.argsort(-lengths, kind="stable")
    starts, lengths = starts[order], lengths[order]
    places, periods, held = [], [], 0
    longest = int(lengths[0]) if len(lengths) else 0
    for p in range(1, longest // LEAST_PERIODS + 1):
        n = int(np.searchsorted(-lengths, -max(LEAST_WORDS, LEAST_PERIODS * p), "right"))
        if not n:
            break
        step = (LEAST_PERIODS - 1) * p
        points = (lengths[:n] - p + step - 1) // step
        total = np.cumsum(points)
        at = np.repeat(starts[:n] - (total - points) * step, points) + np.arange(total[-1]) * step
        at = at[words[at] == words[at + p]]
        if len(at):
            # Of three places in a row that agree, one is next to this.
            beside = words[at + 1] == words[np.minimum(at + 1 + p, len(words) - 1)]
            beside |= (at > 0) & (words[at - 1] == words[at - 1 + p])
            at = at[beside]
        if len(at):
            places.append(at)
            periods.append(np.full(len(at), p))
            held += len(at)
        if held >= _EXTENDED_AT_ONCE:
            yield np.concatenate(places), np.concatenate(periods)
            places, periods, held = [], [], 0
    if held:
        yield np.concatenate(places), np.concatenate(periods)


def find_runs(words: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Rows ``(start, length, period)`` of all runs, by start and period.

    ``words`` holds the texts at ``starts``; a number of its own after each keeps them apart.
    """
    found = np.empty((0, 3), np.int64)
    grammar = None
    for places, periods in _grid(words, starts, lengths):
        grammar = grammar or Grammar(words)
        after = grammar.extensions(places, places + periods)
        before = grammar.extensions(places, places + periods, False)
        runs = np.stack([places - before, before + after + periods, periods], axis=1)
        runs = runs[runs[:, 1] >= np.maximum(LEAST_WORDS, LEAST_PERIODS * periods)]
        found = np.concatenate([found, runs])
        found = found[np.lexsort(found.T[[2, 1, 0]])]
        # Equal stretches: the first has the least period.
        again = (found[1:, :2] == found[:-1, :2]).all(axis=1)
        found = found[np.append(True, ~again)] if len(found) else found
    return found[np.lexsort((found[:, 2], found[:, 0]))]


# Texts.


class _Numbers(dict):
    """Numbers things in the order in which they are asked for."""

    def __missing__(self, key: bytes) -> int:
        self[key] = number = len(self)
        return number


def split_words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split()


def planted(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words, for one id in ten with an end that repeats."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


@dataclass(frozen=True)
class TextRuns:
    words: list[bytes]
    runs: list[tuple[int, int, int]]

    def strongest(self) -> tuple[int, int, int] | None:
        """The run with the greatest length over period; the first of equal ones."""
        best = None
        for start, length, period in self.runs:
            if best is None or length * best[2] > best[1] * period:
                best = (start, length, period)
        return best

    def kept(self) -> list[bytes]:
        """The words that no run holds after its first period."""
        if not self.runs:
            return self.words
        change = np.zeros(len(self.words) + 1, np.int64)
        for start, length, period in self.runs:
            change[start + period] += 1
            change[start + length] -= 1
        return [word for word, dropped in zip(self.words, np.cumsum(change).tolist(), strict=False) if not dropped]


def runs_of_texts(texts: list[list[bytes]]) -> list[TextRuns]:
    numbers = _Numbers()
    lengths = np.array([len(words) for words in texts], np.int64)
    starts = np.cumsum(lengths + 1) - lengths - 1
    sequence = np.empty(int((lengths + 1).sum()), np.int64)
    for start, words in zip(starts.tolist(), texts, strict=True):
        sequence[start : start + len(words)] = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
    sequence[starts + lengths] = len(numbers) + np.arange(len(texts))
    runs = find_runs(sequence, starts, lengths)
    owner = np.searchsorted(starts, runs[:, 0], "right") - 1
    runs[:, 0] -= starts[owner]
    ends = np.searchsorted(owner, np.arange(len(texts)), "right").tolist()
    rows, result, at = [tuple(row) for row in runs.tolist()], [], 0
    for words, end in zip(texts, ends, strict=True):
        result.append(TextRuns(words, rows[at:end]))
        at = end
    return result


def _in_groups(rows: Iterator[tuple], words_of: Callable[[tuple], list[bytes]]) -> Iterator[tuple[list[tuple], list[TextRuns]]]:
    """Rows in groups of about ``BATCH_WORDS`` words, with the runs of their texts."""
    held: list[tuple] = []
    texts: list[list[bytes]] = []
    size = 0
    for row in rows:
        held.append(row)
        texts.append(words_of(row))
        size += len(texts[-1]) + 1
        if size >= BATCH_WORDS:
            yield held, runs_of_texts(texts)
            held, texts, size = [], [], 0
    if held:
        yield held, runs_of_texts(texts)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns), strict=True)


_PLANTED = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_runs", pa.int64()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("period", pa.int64()),
        ("exponent_milli", pa.int64()),
        ("runs_sha256", pa.string()),
        ("collapsed_sha256", pa.string()),
    ]
)


def _planted_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, found in _in_groups(_rows(batches), lambda row: planted(row[0], split_words(row[1]))):
        out = []
        for (doc_id, _), text in zip(rows, found, strict=True):
            best = text.strongest() or (None, None, None)
            milli = 1000 * best[1] // best[2] if text.runs else None
            listed = "".join(f"{start},{length},{period}\n" for start, length, period in text.runs)
            digests = [hashlib.sha256(data).hexdigest() for data in (listed.encode(), b" ".join(text.kept()))]
            out.append((doc_id, len(text.runs), *best, milli, *digests))
        yield pa.RecordBatch.from_arrays(
            [pa.array(column, field.type) for column, field in zip(zip(*out, strict=True), _PLANTED, strict=True)],
            schema=_PLANTED,
        )


def planted_runs(documents: DataFrame) -> DataFrame:
    """Runs of each text after planting: their number, the strongest one, digests of all and of what is kept."""
    ship_code(documents.sparkSession)
    rows = documents.select(F.col("doc_id").cast("long"), "text")
    ddl = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long"
    return rows.mapInArrow(_planted_rows, f"{ddl}, runs_sha256 string, collapsed_sha256 string")


def _run_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, found in _in_groups(_rows(batches), lambda row: split_words(row[1])):
        owners = np.repeat(np.arange(len(rows)), [len(text.runs) for text in found])
        runs = np.array([run for text in found for run in text.runs], np.int64).reshape(-1, 3)
        ids = pa.array([row[0] for row in rows], pa.int64()).take(pa.array(owners))
        yield pa.RecordBatch.from_arrays([ids, *map(pa.array, runs.T)], ["doc_id", "start", "length", "period"])


def periodic_runs(documents: DataFrame) -> DataFrame:
    """A row for each run of each text as it is: number of its first word, words, period."""
    ship_code(documents.sparkSession)
    rows = documents.select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(_run_rows, "doc_id long, start long, length long, period long")


def _collapsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = batch.schema.names.index("text")
        texts: list[str | None] = []
        for rows, found in _in_groups(zip(batch.column(at).to_pylist()), lambda row: split_words(row[0])):
            for (text,), runs in zip(rows, found, strict=True):
                texts.append(b" ".join(runs.kept()).decode("utf-8", "surrogatepass") if runs.runs else text)
        columns = list(batch.columns)
        columns[at] = pa.array(texts, batch.schema.field(at).type)
        yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)


def without_repetitions(documents: DataFrame) -> DataFrame:
    """All columns and rows; a text with runs keeps their first periods, its words joined by blanks."""
    ship_code(documents.sparkSession)
    return documents.mapInArrow(_collapsed, documents.schema)

"""Packing into as few sequences as possible by linear grouping.

The plan needs the number of pieces of each length and nothing else, so it is made on the
driver from at most ``capacity`` counts, whatever the corpus:

1. Large pieces, longest first, are cut into ``GROUPS`` groups of equal cardinality, and
   each is rounded up to the longest of its group.
2. The best configurations (what one sequence holds) of these few sizes come from the
   linear program of minimal sequences, solved by column generation: a knapsack over the
   current prices finds the next configuration. Whole parts of its solution are used;
   pieces left over by rounding down join the small ones.
3. Actual pieces take the places of their group in order, which leaves more room than
   planned, and the small ones fill it: longest first, each into the fullest sequence
   that has room, new sequences last. Sequences of one fill are handled together, so
   this too is arithmetic on counts.

The plan says where the pieces of ranks a..b among those of one length go. Ranks are
made by windows over (length, salt), so that a length that a third of all pieces share is
still many tasks, and a last map looks each piece up.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clearwell.llm.common import stored
from clearwell.llm.tokens import pieces

CAPACITY = 4096
GROUPS = 24
# Pieces of at least this part of the capacity are large.
LARGE_PART = 8


@dataclass(frozen=True)
class Plan:
    """Row k: of ``length[k]``, ranks from ``rank[k]`` on, ``count[k]`` pieces, ``each[k]`` to a
    sequence from ``sequence[k]`` on, the first at ``offset[k]``. Sorted by length and rank."""

    length: np.ndarray
    rank: np.ndarray
    count: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    each: np.ndarray
    sequences: int


def configurations(sizes: list[int], demand: list[int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Configurations (pieces of each size) and whole numbers of uses, none above its demand."""
    n = len(sizes)
    patterns = [[capacity // s if i == k else 0 for k in range(n)] for i, s in enumerate(sizes)]
    basis = np.array(patterns, float).T
    demands = np.array(demand, float)
    for _ in range(60 * n):
        prices = np.linalg.solve(basis.T, np.ones(n))
        value, chosen = _knapsack(sizes, prices, capacity)
        if value <= 1 + 1e-9:
            break
        direction, level = np.linalg.solve(basis, chosen), np.linalg.solve(basis, demands)
        ratio = np.where(direction > 1e-9, level / np.where(direction > 1e-9, direction, 1), np.inf)
        leaving = int(ratio.argmin())
        if not np.isfinite(ratio[leaving]):
            break
        basis[:, leaving] = chosen
    level = np.floor(np.maximum(np.linalg.solve(basis, demands), 0) + 1e-6).astype(int)
    left, used = np.array(demand), []
    for column, uses in zip(np.rint(basis.T).astype(int), level, strict=True):
        fits = column > 0
        uses = min(int(uses), int((left[fits] // column[fits]).min(initial=uses)))
        if uses > 0:
            left -= uses * column
            used.append((tuple(column.tolist()), uses))
    return used


def _knapsack(sizes: list[int], prices: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The most valuable configuration."""
    best, choice = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    sizes_ = np.array(sizes)
    for room in range(int(sizes_.min()), capacity + 1):
        fits = np.flatnonzero(sizes_ <= room)
        values = prices[fits] + best[room - sizes_[fits]]
        k = int(values.argmax())
        best[room], choice[room] = best[room - 1], -1
        if values[k] > best[room - 1] + 1e-12:
            best[room], choice[room] = values[k], fits[k]
    chosen, room = np.zeros(len(sizes)), capacity
    while room > 0:
        if choice[room] < 0:
            room -= 1
        else:
            chosen[choice[room]] += 1
            room -= sizes[choice[room]]
    return float(best[capacity]), chosen


class _Packing:
    """The plan while it grows. ``free[r]`` has runs (first sequence, how many) with r free places."""

    def __init__(self, counts: dict[int, int], capacity: int) -> None:
        self.capacity, self.counts = capacity, dict(counts)
        self.taken = dict.fromkeys(counts, 0)
        self.rows: list[tuple[int, int, int, int, int, int]] = []
        self.free: dict[int, list[tuple[int, int]]] = {}
        self.open = np.zeros(capacity + 1, bool)
        self.sequences = 0

    def put(self, length: int, count: int, sequence: int, offset: int, each: int, rank: int | None = None) -> None:
        if rank is None:
            rank = self.taken[length]
            self.taken[length] += count
        self.rows.append((length, rank, count, sequence, offset, each))

    def leave(self, free: int, first: int, count: int) -> None:
        if free > 0 and count > 0:
            self.free.setdefault(free, []).append((first, count))
            self.open[free] = True

    def fill(self, length: int, left: int, first: int, count: int, free: int) -> int:
        """Put pieces into a run of sequences with ``free`` places; the number of pieces that are left."""
        each = free // length
        whole = min(count, left // each)
        if whole:
            self.put(length, whole * each, first, self.capacity - free, each)
            self.leave(free - each * length, first, whole)
            left -= whole * each
        if whole < count:
            if 0 < left:
                self.put(length, left, first + whole, self.capacity - free, each)
                self.leave(free - left * length, first + whole, 1)
                left, whole = 0, whole + 1
            self.leave(free, first + whole, count - whole)
        return left

    def best_fit(self, length: int, left: int) -> None:
        while left:
            more = np.flatnonzero(self.open[length:])
            if not len(more):
                break
            free = length + int(more[0])
            runs, self.open[free] = self.free.pop(free), False
            for k, (first, count) in enumerate(runs):
                if not left:
                    for rest in runs[k:]:
                        self.leave(free, *rest)
                    break
                left = self.fill(length, left, first, count, free)
        if left:
            each = self.capacity // length
            new = -(-left // each)
            self.sequences += new
            self.fill(length, left, self.sequences - new, new, self.capacity)

    def large(self, groups_: int, least: int) -> None:
        """Configurations of grouped large pieces, with actual pieces in their places."""
        lengths = sorted((n for n in self.counts if n >= least), reverse=True)
        total = sum(self.counts[n] for n in lengths)
        if not total:
            return
        ends = np.cumsum([self.counts[n] for n in lengths])
        begins = ends - [self.counts[n] for n in lengths]
        bounds = sorted({total * g // groups_ for g in range(groups_ + 1)})
        sizes = [lengths[int(np.searchsorted(ends, b, "right"))] for b in bounds[:-1]]
        # Groups of one size are one size.
        starts: dict[int, list[int]] = {}
        for size, low, high in zip(sizes, bounds[:-1], bounds[1:], strict=True):
            starts.setdefault(size, [low, high])[1] = high
        sizes = list(starts)
        used = configurations(sizes, [high - low for low, high in starts.values()], self.capacity)
        following = [low for low, _ in starts.values()]
        for pattern, uses in used:
            slots = []
            for k, times in enumerate(pattern):
                for _ in range(times):
                    slots.append(following[k])
                    following[k] += uses
            # Runs of sequences whose pieces all have the same lengths.
            cuts = {0, uses}
            for slot in slots:
                inner = ends[(ends > slot) & (ends < slot + uses)]
                cuts.update((inner - slot).tolist())
            order = sorted(cuts)
            for low, high in zip(order[:-1], order[1:], strict=True):
                offset = 0
                for slot in slots:
                    k = int(np.searchsorted(ends, slot + low, "right"))
                    first = self.sequences + low
                    self.put(lengths[k], high - low, first, offset, 1, int(slot + low - begins[k]))
                    offset += lengths[k]
                self.leave(self.capacity - offset, self.sequences + low, high - low)
            self.sequences += uses
        # What is left of each group, by length: ranks from `following` to the end of the group.
        for (_, high), low in zip(starts.values(), following, strict=True):
            while low < high:
                k = int(np.searchsorted(ends, low, "right"))
                count = int(min(high, ends[k]) - low)
                self.rest.append((lengths[k], int(low - begins[k]), count))
                low += count

    rest: list[tuple[int, int, int]]

    def run(self, groups_: int, least: int) -> Plan:
        self.rest = []
        self.large(groups_, least)
        small = [(n, 0, count) for n, count in self.counts.items() if n < least]
        for length, rank, count in sorted([*self.rest, *small], key=lambda r: (-r[0], r[1])):
            self.taken[length] = rank
            self.best_fit(length, count)
        rows = np.array(sorted(self.rows), np.int64).reshape(-1, 6)
        return Plan(*rows.T, sequences=self.sequences)


def make_plan(counts: dict[int, int], capacity: int = CAPACITY, groups_: int = GROUPS) -> Plan:
    """Where the pieces of each length go; ``counts`` has at most ``capacity`` lengths."""
    counts = {int(n): int(c) for n, c in counts.items() if c > 0}
    if any(not 0 < n <= capacity for n in counts):
        raise ValueError(f"a piece must have 1 to {capacity} tokens")
    return _Packing(counts, capacity).run(groups_, max(1, capacity // LARGE_PART))


def _placed(plan, length_at: int, rank_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = plan.value
        lengths = np.unique(p.length)
        begin = np.searchsorted(p.length, lengths)
        end = np.searchsorted(p.length, lengths, "right")
        for batch in batches:
            length = batch.column(length_at).to_numpy()
            rank = batch.column(rank_at).to_numpy()
            row = np.zeros(len(length), np.int64)
            for k in np.unique(np.searchsorted(lengths, length)):
                own = length == lengths[k]
                row[own] = begin[k] + np.searchsorted(p.rank[begin[k] : end[k]], rank[own], "right") - 1
            nth = rank - p.rank[row]
            sequence = p.sequence[row] + nth // p.each[row]
            offset = p.offset[row] + nth % p.each[row] * length
            kept = [c for k, c in enumerate(batch.columns) if k != rank_at]
            names = [c for k, c in enumerate(batch.schema.names) if k != rank_at]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(sequence), pa.array(offset)], [*names, "sequence_id", "offset"]
            )

    return run


def placed(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``cut(doc_id, piece, length, ...)`` with ``sequence_id`` and ``offset``. ``cut`` is read several times."""
    spark = cut.sparkSession
    counts = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}  # at most `capacity` rows
    plan = spark.sparkContext.broadcast(make_plan(counts, capacity))
    salts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    salted = cut.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)))
    before = salted.groupBy("length", "_salt").agg(F.count("*").alias("_n"))
    before = before.selectExpr(
        "length", "_salt", "sum(_n) OVER (PARTITION BY length ORDER BY _salt) - _n AS _before"
    )
    order = "row_number() OVER (PARTITION BY length, _salt ORDER BY doc_id, piece) - 1"
    ranked = salted.withColumn("_rank", F.expr(order)).join(before, ["length", "_salt"])
    ranked = ranked.select(*cut.columns, F.expr("_rank + _before").alias("_rank"))
    names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema)
    run = _placed(plan, cut.columns.index("length"), len(cut.columns))
    return ranked.mapInArrow(run, f"{names}, sequence_id long, offset long")


def packed(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` of every piece of ``docs``.

    A null or empty text is one piece, its end id alone. Rows without an id and repeated rows are
    packed like any other. Other columns are ignored.
    """
    return placed(stored(pieces(docs, tokenizer, capacity), "pieces"), capacity)

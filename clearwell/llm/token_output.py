"""Packed id matrices: best fit, longest first, by a segment tree over free capacities.

Pieces (overlong documents are cut without loss) are dealt at random to groups of about
``GROUP_TOKENS`` ids, each packed by one task: small enough to hold, large enough that the
one half-filled sequence a group may end with does not matter. A row of the output is one
sequence: its ids padded to the capacity, cumulative segment lengths, and positions that
start anew with each segment.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clearwell.llm.common import groups, stored
from clearwell.llm.tokens import pieces

CAPACITY = 4096
GROUP_TOKENS = 2_000_000
PAD_ID = 0


class CapacityTree:
    """A segment tree over 0..capacity: how many bins have each number of free places."""

    def __init__(self, capacity: int) -> None:
        self._leaves = 1 << capacity.bit_length()
        self._count = [0] * (2 * self._leaves)

    def add(self, free: int, by: int = 1) -> None:
        node = free + self._leaves
        while node:
            self._count[node] += by
            node >>= 1

    def least(self, need: int) -> int | None:
        """The smallest free capacity of at least ``need`` that a bin has."""
        node = need + self._leaves
        if self._count[node]:
            return need
        while node > 1:
            if not node & 1 and self._count[node + 1]:
                node += 1
                while node < self._leaves:
                    node = 2 * node if self._count[2 * node] else 2 * node + 1
                return node - self._leaves
            node >>= 1
        return None


def best_fit_decreasing(lengths: list[int], capacity: int) -> list[list[int]]:
    """Numbers of the pieces in each bin, in the order they were put there."""
    tree, bins, with_free = CapacityTree(capacity), [], {}
    for k in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        free = tree.least(lengths[k])
        if free is None:
            bins.append([])
            bin_, free = len(bins) - 1, capacity
        else:
            bin_ = with_free[free].pop()
            tree.add(free, -1)
        bins[bin_].append(k)
        free -= lengths[k]
        if free:
            tree.add(free)
            with_free.setdefault(free, []).append(bin_)
    return bins


_SCHEMA = pa.schema(
    [
        ("sequence_id", pa.int64()),
        ("n_tokens", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())),
        ("pieces", pa.list_(pa.int32())),
        ("cumulative_lengths", pa.list_(pa.int32())),
        ("ids", pa.binary()),
        ("positions", pa.binary()),
    ]
)


def _sequences(capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, ["packing_group"]):
            number = group.column("packing_group")[0].as_py()
            lengths = group.column("length").to_pylist()
            docs, cuts, ids = (group.column(c) for c in ("doc_id", "piece", "ids"))
            rows = []
            for k, members in enumerate(best_fit_decreasing(lengths, capacity)):
                own = [lengths[m] for m in members]
                matrix = np.full(capacity, PAD_ID, "<u2")
                matrix[: sum(own)] = np.frombuffer(b"".join(ids[m].as_py() for m in members), "<u2")
                positions = np.zeros(capacity, "<u2")
                positions[: sum(own)] = np.concatenate([np.arange(n) for n in own])
                rows.append(
                    {
                        "sequence_id": (number << 32) + k,
                        "n_tokens": sum(own),
                        "doc_ids": [docs[m].as_py() for m in members],
                        "pieces": [cuts[m].as_py() for m in members],
                        "cumulative_lengths": [0, *np.cumsum(own).tolist()],
                        "ids": matrix.tobytes(),
                        "positions": positions.tobytes(),
                    }
                )
                if len(rows) == 256:
                    yield pa.RecordBatch.from_pylist(rows, _SCHEMA)
                    rows = []
            yield pa.RecordBatch.from_pylist(rows, _SCHEMA)

    return run


def packed_matrices(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """One row a sequence: ``sequence_id, n_tokens, doc_ids, pieces, cumulative_lengths, ids, positions``.

    ``ids`` are ``capacity`` little-endian uint16, padded with ``PAD_ID`` beyond ``n_tokens``; ``positions``,
    as many, count from 0 in each segment. Every id of every document, and its end id, is in exactly
    one segment. A null or empty text is one segment, its end id. Rows without an id are packed too.
    """
    cut = stored(pieces(docs, tokenizer, capacity, with_ids=True), "id-pieces")
    total = cut.agg(F.sum("length")).first()[0] or 0
    number = max(1, -(-total // GROUP_TOKENS))
    key = F.pmod(F.xxhash64("doc_id", "piece", "start", "ids"), F.lit(number)).alias("packing_group")
    dealt = cut.select(key, "doc_id", "piece", "length", "ids").repartition("packing_group")
    dealt = dealt.sortWithinPartitions("packing_group", "doc_id", "piece")
    schema = (
        "sequence_id long, n_tokens long, doc_ids array<long>, pieces array<int>, "
        "cumulative_lengths array<int>, ids binary, positions binary"
    )
    return dealt.mapInArrow(_sequences(capacity), schema)


def write_matrices(docs: DataFrame, tokenizer: str, path: str, capacity: int = CAPACITY) -> None:
    """The rows of ``packed_matrices`` as Parquet; a repeated run replaces them."""
    packed_matrices(docs, tokenizer, capacity).write.mode("overwrite").parquet(path)

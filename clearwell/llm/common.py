"""What the operators share: scratch tables, word shingles, grouped streams of rows, components.

A *scratch table* is a Parquet folder under ``spark.checkpoint.dir`` (see
``clearwell.session.shared_folder``); it cuts the lineage, so a lost executor
costs the tasks since the last table and never a whole job.
"""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clearwell.session import shared_folder

# Odd multiplier and finaliser constants of the public splitmix64 generator.
_GOLDEN, _MIX_1, _MIX_2 = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB
_LOWER_ASCII = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


_shipped: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Send this package to the executors, once a session; they need not have it installed."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = Path(__file__).resolve().parents[1]
        target = Path(tempfile.mkdtemp(prefix="clearwell-code-"), package.name)
        context.addPyFile(shutil.make_archive(str(target), "zip", package.parent, package.name))
        _shipped.add(context.applicationId)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, label: str, more: Iterable[DataFrame] = ()) -> DataFrame:
    """The rows of ``df``, and of each of ``more`` in turn, written to the shared folder and read back."""
    path = shared_folder(df.sparkSession, label)
    df.write.parquet(path)
    for further in more:
        further.write.mode("append").parquet(path)
    # Scratch data ends with the application.
    folder = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_stored(df: DataFrame) -> None:
    """Delete the files of a table that ``stored`` made and nothing reads any more."""
    jvm = df.sparkSession._jvm
    for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


# Words and shingles.


def words_of(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case, as UTF-8; none for a null text."""
    return text.encode("utf-8", "surrogatepass").translate(_LOWER_ASCII).split() if text else []


def mixed(values: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: every bit of the result depends on every bit of the value."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(_MIX_1)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(_MIX_2)
    return values ^ (values >> np.uint64(31))


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct 64-bit shingles of ``size`` words; the whole sequence if it is shorter."""
    n = len(hashes)
    if not n:
        return hashes
    size = min(size, n)
    rolled = np.full(n - size + 1, size, np.uint64)
    for k in range(size):
        rolled = mixed(rolled * np.uint64(_GOLDEN) + hashes[k : n - size + 1 + k])
    return np.unique(rolled)


def multipliers(count: int, seed: int = 1) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 2**63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def minhash(values: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """For each factor, the least upper half of ``value * factor``; needs at least one value."""
    best = np.full(len(factors), 2**32 - 1, np.uint64)
    for at in range(0, len(values), 1024):
        np.minimum(best, ((values[at : at + 1024, None] * factors) >> np.uint64(32)).min(axis=0), out=best)
    return best.astype(np.uint32)


# Rows that arrive sorted by a key, group by group.


def groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of equal ``keys`` from sorted batches. A group must fit in memory: its size is the caller's bound."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows, bool)
        for column in columns:
            change[1:] |= column[1:] != column[:-1]
        starts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        first = tuple(c[0] for c in columns)
        if held and first != last:
            yield pa.Table.from_batches(held)
            held = []
        for begin, end in zip(starts[:-1], starts[1:], strict=True):
            if begin:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(begin, end - begin))
        last = tuple(c[-1] for c in columns)
    if held:
        yield pa.Table.from_batches(held)


class Forest:
    """Union-find over 0..n-1 with numpy labels."""

    def __init__(self, n: int) -> None:
        self.label = np.arange(n)
        self.parts = n

    def join(self, a: int, others: np.ndarray) -> np.ndarray:
        """Unite ``a`` with each of ``others``; those that were in another part, one a part."""
        at = self.label[a]
        old, first = np.unique(self.label[others], return_index=True)
        new = old != at
        if new.any():
            self.label[np.isin(self.label, old[new])] = at
            self.parts -= int(new.sum())
        return others[first[new]]


def block_pairs(block: str, blocks: str) -> F.Column:
    """The pairs (i, j), i <= j, of blocks that the rows of one block take part in."""
    return F.expr(
        f"transform(sequence(0, {blocks} - 1), k -> struct(least(k, {block}) AS i, greatest(k, {block}) AS j))"
    )


# Connected components.


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """``(id, component)`` of every node of ``edges(a, b)``; a component is named by its least id.

    Alternating large and small stars: every round is an aggregate with map-side
    combining and one join on it, so a hub of any degree is never one row and AQE
    can split its side of the join. The rounds grow with the logarithm of the
    longest path. Self-loops and repeated edges do no harm; null ends are ignored.
    """
    # Each row says: a larger node `u` hangs below a smaller node `v`.
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = stored(edges, label)
    while True:
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        others = large.join(small, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        following = stored(others.union(small).distinct(), label)
        drop_stored(edges)
        edges = following
        if edges.join(edges.select(F.col("u").alias("v")).distinct(), "v", "left_semi").isEmpty():
            break
    roots = edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).union(roots)

"""Session settings, shuffle sizing and the shared scratch folder."""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MB = 1024 * 1024
# Shuffle bytes one reduce task should handle; AQE merges smaller partitions.
TARGET_PARTITION_BYTES = 128 * MB
# Compressed columnar files grow when their rows are shuffled.
SHUFFLE_INFLATION = 3

_INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
_SCAN_SPLIT = "spark.sql.files.maxPartitionBytes"
_MIN_PARTITION_SIZE = "spark.sql.adaptive.coalescePartitions.minPartitionSize"
_ADVISORY_SIZE = "spark.sql.adaptive.advisoryPartitionSizeInBytes"

_RUNTIME_CONF = {
    # The day of a "...Z" timestamp must not depend on the machine.
    "spark.sql.session.timeZone": "UTC",
    # A sum that does not fit its type must fail, not turn into NULL.
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The state of a stream grows with its ids and must not fill the heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}

_local_scratch: tempfile.TemporaryDirectory | None = None


def build_session(
    app: str = "clearwell",
    master: str | None = None,
    input_bytes: int | None = None,
    **conf: str,
) -> SparkSession:
    """A session with the library's settings; ``input_bytes`` sizes its shuffles."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**_RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = pin(builder.getOrCreate())
    if input_bytes:
        widen_shuffles(spark, input_bytes)
    return spark


def pin(spark: SparkSession) -> SparkSession:
    """Apply the settings results depend on to a session someone else made."""
    for key, value in _RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def initial_partitions(input_bytes: int, most: int | None = None) -> int:
    """Shuffle partitions an input needs; ``most`` bounds them, and partitions grow instead."""
    wanted = max(1, math.ceil(input_bytes * SHUFFLE_INFLATION / TARGET_PARTITION_BYTES))
    return min(wanted, most) if most else wanted


def widen_shuffles(
    spark: SparkSession, input_bytes: int, most: int | None = None, scan_split_bytes: int | None = None
) -> int:
    """Raise the first number of shuffle partitions to what the input needs.

    AQE merges partitions but cannot split those of an aggregation, so the
    starting number has to grow with the data. It is never lowered. Every map task
    writes a block for each partition: where that is too many, ``most`` bounds the
    partitions, or ``scan_split_bytes`` makes fewer and larger map tasks.
    """
    floor = int(spark.conf.get(_INITIAL_PARTITIONS, None) or spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = initial_partitions(input_bytes, most)
    if wanted > floor:
        spark.conf.set(_INITIAL_PARTITIONS, str(wanted))
    if scan_split_bytes:
        spark.conf.set(_SCAN_SPLIT, str(scan_split_bytes))
    return max(wanted, floor)


@contextmanager
def _restored(spark: SparkSession, *keys: str) -> Iterator[None]:
    before = {key: spark.conf.get(key, None) for key in keys}
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


@contextmanager
def widened_shuffles(spark: SparkSession, input_bytes: int | None) -> Iterator[None]:
    """``widen_shuffles`` for the actions of one block."""
    with _restored(spark, _INITIAL_PARTITIONS, _SCAN_SPLIT):
        if input_bytes:
            widen_shuffles(spark, input_bytes)
        yield


def write_piece_bytes(spark: SparkSession, input_bytes: int | None) -> int:
    """Shuffled bytes one writing task should get: enough for a good file, yet work for all cores.

    A small batch into many folders costs by the file, so it too is spread over all cores.
    """
    if not input_bytes:
        return TARGET_PARTITION_BYTES
    share = input_bytes * SHUFFLE_INFLATION // (2 * spark.sparkContext.defaultParallelism)
    return max(16 * 1024, min(share, 256 * MB))


def planned_bytes(df: DataFrame) -> int | None:
    """Size of the rows by the optimizer's estimate, from file lengths alone; None if it has none."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return size if size < 2**60 else None


@contextmanager
def write_sizes(spark: SparkSession, input_bytes: int | None = None) -> Iterator[None]:
    """Partition sizes that suit a write into many folders.

    A folder with more rows than a piece is cut over several tasks. Small batches
    may use all cores: such a write costs by the file, not by the byte, and by
    default AQE would leave all folders to one task.
    """
    with _restored(spark, _ADVISORY_SIZE, _MIN_PARTITION_SIZE):
        spark.conf.set(_ADVISORY_SIZE, str(write_piece_bytes(spark, input_bytes)))
        spark.conf.set(_MIN_PARTITION_SIZE, "16k")
        yield


def folder_bytes(spark: SparkSession, path: str, pattern: str | None = None) -> int:
    """Total length of the files under ``path``, or those of one name pattern; their content is not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    files = (files.option("pathGlobFilter", pattern) if pattern else files).load(path)
    return files.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("bytes")).first()["bytes"]


def hadoop_path(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path as it knows it."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new, empty path that every executor can reach.

    It lies under ``spark.checkpoint.dir``. Only a local session may go without
    that setting; it then gets a temporary folder that ends with the process.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder shared by all executors")
        global _local_scratch
        if _local_scratch is None:
            _local_scratch = tempfile.TemporaryDirectory(prefix="clearwell-")
        root = _local_scratch.name
    return f"{root.rstrip('/')}/clearwell/{label}-{uuid.uuid4().hex}"

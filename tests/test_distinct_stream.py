"""Ids once, in time or late, over micro-batches and replays."""

from datetime import timedelta
from pathlib import Path

from pyspark.sql.types import IntegerType, StringType, StructType, TimestampType

from clearwell.sources import readers
from clearwell.streaming import distinct

SCHEMA = StructType().add("id", StringType()).add("n", IntegerType()).add("ts", TimestampType())


def _land(spark, tmp_path, *rows):
    df = spark.createDataFrame(rows, "id string, n int, ts string").selectExpr("id", "n", "cast(ts as timestamp) ts")
    df.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))


def _take(spark, tmp_path, **more):
    stream = readers.stream_source(spark, str(tmp_path / "in"), "parquet", SCHEMA)
    out = str(tmp_path / "out")
    distinct.append_distinct(stream, out, str(tmp_path / "checkpoint"), ("id",), "ts", timedelta(hours=1), **more)
    rows = distinct.distinct_rows(spark, out, SCHEMA).collect()
    return sorted((r["id"] or "", r["n"], r["_kind"]) for r in rows)


def _counts(spark, tmp_path):
    return {r["kind"]: r["rows"] for r in distinct.arrivals(spark, str(tmp_path / "out"), SCHEMA).collect()}


def test_late_rows_are_kept_and_repeated_ones_counted(spark, tmp_path):
    _land(spark, tmp_path, ("a", 1, "2024-01-01 10:00:00"), ("a", 2, "2024-01-01 09:59:00"), ("b", 3, "2024-01-01 12:00:00"))
    assert _take(spark, tmp_path) == [("a", 2, "in_time"), ("b", 3, "in_time")]
    late = [("c", 4, "2024-01-01 08:00:00"), ("a", 5, "2024-01-01 08:00:00"), ("d", 6, "2024-01-01 11:30:00")]
    _land(spark, tmp_path, *late, (None, 7, "2024-01-01 12:00:00"), (None, 7, "2024-01-01 12:00:00"), ("e", 8, None))
    want = [("", 7, "in_time")] * 2 + [("a", 2, "in_time"), ("b", 3, "in_time"), ("c", 4, "late")]
    want += [("d", 6, "in_time"), ("e", 8, "in_time")]
    assert _take(spark, tmp_path) == want
    assert _counts(spark, tmp_path) == {"in_time": 6, "late": 1, "duplicate": 2}
    # The last micro-batch once more, as after a crash: nothing changes.
    for name in ("1", ".1.crc"):
        (Path(tmp_path) / "checkpoint/commits" / name).unlink()
    assert _take(spark, tmp_path) == want
    assert _counts(spark, tmp_path) == {"in_time": 6, "late": 1, "duplicate": 2}


def test_a_horizon_bounds_what_is_read(spark, tmp_path):
    _land(spark, tmp_path, ("a", 1, "2024-01-01 10:00:00"), ("b", 1, "2024-01-20 10:00:00"), ("x", 1, None))
    _take(spark, tmp_path)
    _land(spark, tmp_path, ("a", 2, "2024-01-20 10:00:00"), ("b", 2, "2024-01-21 10:00:00"), ("x", 2, "2024-01-20 10:00:00"))
    got = _take(spark, tmp_path, horizon=timedelta(days=2))
    assert got == [("a", 1, "in_time"), ("a", 2, "in_time"), ("b", 1, "in_time"), ("x", 1, "in_time")]


def test_a_hot_id_is_one_row(spark, tmp_path):
    rows = spark.range(20_000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' ELSE cast(id AS string) END AS id", "cast(id AS int) n", "timestamp'2024-01-01 00:00:00' ts"
    )
    rows.write.parquet(str(tmp_path / "in"))
    assert len(_take(spark, tmp_path)) == 20_000 - 6_667 + 1
    assert _counts(spark, tmp_path)["duplicate"] == 6_666

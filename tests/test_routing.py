import json
import os
import urllib.parse
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from clearwell.functions import keys
from clearwell.operators import routing

DAY = datetime(2024, 3, 5, 23, 59, tzinfo=UTC)


def _route(spark, *uploads):
    df = spark.createDataFrame(list(uploads), "original_key string, size bigint")
    return [r.asDict() for r in routing.route(df, DAY, "r1").collect()]


@pytest.mark.parametrize(
    ("key", "fmt", "reader"),
    [
        ("uploads/harvest.csv", "csv", "csv"),
        ("uploads/HARVEST.CSV", "csv", "csv"),
        ("uploads/soil.json", "json", "json"),
        ("uploads/soil.jsonl", "json", "jsonl"),
        ("uploads/beds.parquet", "parquet", "parquet"),
        ("uploads/deep/x.csv.gz", "csv", "csv"),
        ("uploads/x.jsonl.GZ", "json", "jsonl"),
        ("uploads/a b c.CSV", "csv", "csv"),
    ],
)
def test_accepted(spark, key, fmt, reader):
    (verdict,) = _route(spark, (key, 77))
    assert verdict == {
        "original_key": key,
        "size": 77,
        "status": "triggered",
        "reason": None,
        "format": fmt,
        "reader": reader,
        "organized_key": f"raw/{fmt}/year=2024/month=03/day=05/{os.path.basename(key)}",
        "run_id": "r1",
    }


@pytest.mark.parametrize(
    ("key", "size", "reason"),
    [
        ("uploads/plan.xlsx", 31, "unsupported_extension"),
        ("uploads/plan.xlsx", 0, "unsupported_extension"),
        ("uploads/nothing.csv", 0, "empty_file"),
        ("uploads/.csv", 5, "unsupported_extension"),
        ("up.loads/noext", 5, "unsupported_extension"),
        ("uploads/folder.csv/", 5, "unsupported_extension"),
        ("uploads/x.gz", 5, "unknown_format"),
        ("uploads/x.txt.gz", 5, "unknown_format"),
        ("uploads/x.parquet.gz", 5, "unknown_format"),
        (None, 5, "malformed_notification"),
    ],
)
def test_skipped(spark, key, size, reason):
    (verdict,) = _route(spark, (key, size))
    assert (verdict["status"], verdict["reason"]) == ("skipped", reason)
    assert verdict["organized_key"] is verdict["format"] is verdict["run_id"] is None


def test_notifications(spark):
    def record(key, **more):
        return {"eventName": "Put", "s3": {"bucket": {"name": "b"}, "object": {"key": key, **more}}}

    two = json.dumps({"Records": [record("uploads/a+b%20c.CSV", size=7, eTag="x"), record("uploads/n.json")]})
    df = spark.createDataFrame([(two,), ("{}",), ('{"Records": []}',), ("not json",), (None,)], "value string")
    rows = routing.decode_keys(routing.read_notifications(df)).collect()
    assert {(r["bucket"], r["original_key"], r["size"]) for r in rows} == {
        ("b", "uploads/a b c.CSV", 7),
        ("b", "uploads/n.json", 0),
        (None, None, 0),
    }
    assert sorted(r["malformed"] for r in rows if r["malformed"] is not None) == ["", "not json"]
    assert {r["reason"] for r in routing.route(df_rows(spark, rows)).collect()} == {None, "malformed_notification"}


def df_rows(spark, rows):
    return spark.createDataFrame([(r["original_key"], r["size"] or 1) for r in rows], "original_key string, size bigint")


KEYS = [
    "uploads/a+b%20c.CSV", "bad%zz.json", "mix%41%zz%2Fx.csv", "100%", "%", "%%41", "x%4", "plain.csv", "%E2%82%AC.csv",
    "a.b.c", "..csv", ".a.csv", "...", "a.", "a..csv", "d.ir/file", "d/.hidden.json", "a/b/", "", "x.tar.GZ", "ü.JSON",
]


def test_keys_like_the_standard_library(spark):
    df = spark.createDataFrame([(k,) for k in KEYS], "k string")
    for key, decoded, ext, base in df.select(
        "k", keys.decoded_key(F.col("k")), keys.extension(F.col("k")), keys.base_name(F.col("k"))
    ).collect():
        assert decoded == urllib.parse.unquote_plus(key)
        assert ext == os.path.splitext(key.lower())[1]
        assert base == os.path.basename(key)


def test_summary_collisions_and_prefix(spark):
    df = spark.createDataFrame(
        [("uploads/a.csv", 1), ("uploads/x/a.csv", 2), ("uploads/b.csv", 0), ("other/c.csv", 3)],
        "original_key string, size bigint",
    )
    verdicts = routing.route(df, DAY)
    assert {tuple(r) for r in routing.routing_summary(verdicts).collect()} == {
        ("triggered", None, "csv", 3),
        ("skipped", "empty_file", None, 1),
    }
    assert [tuple(r) for r in routing.raw_key_collisions(verdicts).collect()] == [
        ("raw/csv/year=2024/month=03/day=05/a.csv", 2)
    ]
    assert routing.under_prefix(df).count() == 3

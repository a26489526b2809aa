from pathlib import Path

import pytest
from pyspark.sql import functions as F

from clearwell.operators import shape
from clearwell.sinks import catalog, writers
from clearwell.sources import readers

SCHEMA = "`id` bigint, `date` string"


@pytest.fixture
def dated(spark):
    days = ["2024-01-05", "2024-01-05", "2024-01-31", "2024-11-02", None]
    df = spark.createDataFrame(list(enumerate(days)), "id bigint, date string")
    return shape.add_date_partitions(df)


def _data_files(path):
    return [p for p in Path(path).rglob("*.parquet")]


def test_clean_round_trip_keeps_padded_months(spark, dated, tmp_path):
    path = str(tmp_path / "clean")
    writers.write_clean(dated, path)
    back = readers.read_partitioned(spark, path, SCHEMA)
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, dated.collect()), key=str)
    assert (tmp_path / "clean/year=2024/month=01/day=05").is_dir()
    assert (tmp_path / "clean/year=__HIVE_DEFAULT_PARTITION__").is_dir()
    assert len(_data_files(path)) == 4


def test_append_doubles_and_overwrite_replaces_folders(spark, dated, tmp_path):
    path = str(tmp_path / "clean")
    writers.write_clean(dated, path)
    writers.write_clean(dated, path)
    assert readers.read_partitioned(spark, path, SCHEMA).count() == 10
    writers.write_clean(dated.filter("month = '01'"), path, mode="overwrite")
    assert readers.read_partitioned(spark, path, SCHEMA).count() == 3 + 2 + 2


def test_large_folders_are_cut(spark, tmp_path):
    df = spark.range(100).select("id", F.lit("2024-01-01").alias("date"))
    path = str(tmp_path / "clean")
    writers.write_clean(shape.add_date_partitions(df), path, max_records_per_file=10)
    assert len(_data_files(path)) == 10


def test_quarantine_layouts(spark, dated, tmp_path):
    path = str(tmp_path / "bad")
    writers.write_quarantine(dated, path, "csv")
    assert (tmp_path / "bad/source=csv/year=2024/month=01/day=31").is_dir()
    writers.write_quarantine(dated, path + "-flat", partitioned=False, mode="overwrite")
    assert spark.read.parquet(path + "-flat").columns == dated.columns
    writers.write_quarantine(dated.filter(F.lit(False)), path + "-none", "csv")
    assert _data_files(path + "-none") == []


def test_batch_folder_is_replaced_as_a_whole(spark, dated, tmp_path):
    path = str(tmp_path / "table")
    for rows in (dated, dated.filter("month = '11'")):
        writers.write_batch(rows, path, "b1", ("year", "month", "day"))
    writers.write_batch(dated, path, "b2", ("year", "month", "day"))
    back = readers.read_partitioned(spark, path, SCHEMA, (writers.BATCH, "year", "month", "day"))
    counts = {r[writers.BATCH]: r["count"] for r in back.groupBy(writers.BATCH).count().collect()}
    assert counts == {"b1": 1, "b2": 5}


def test_report(spark, tmp_path):
    report = spark.range(3)
    writers.write_report(report, path=str(tmp_path / "r"))
    assert spark.read.parquet(str(tmp_path / "r")).count() == 3
    writers.write_report(report, table="clearwell_report")
    assert readers.read_table(spark, "clearwell_report").count() == 3
    with pytest.raises(ValueError, match="path or a table"):
        writers.write_report(report)


def test_table_over_a_folder(spark, dated, tmp_path, caplog):
    path = tmp_path / "clean"
    database = catalog.ensure_database(spark, catalog.database_name("data-lake", "dev"), str(tmp_path / "db"))
    assert database == "data_lake_dev_db"
    table = f"{database}.events"
    writers.write_clean(dated.filter("month = '01'"), str(path))
    catalog.register_table(spark, table, str(path), SCHEMA)
    assert readers.read_table(spark, table).count() == 3
    assert {r["month"] for r in spark.table(table).collect()} == {"01"}

    newer = dated.filter("month = '11'").withColumn("note", F.lit("n"))
    writers.write_clean(newer, str(path))
    assert catalog.add_columns(spark, table, newer.dtypes) == ["note"]
    assert catalog.add_columns(spark, table, newer.dtypes) == []
    catalog.refresh_table(spark, table)
    assert {r["id"]: r["note"] for r in spark.table(table).collect()} == {0: None, 1: None, 2: None, 3: "n"}

    # A folder that went away stays defined and is reported.
    seen = catalog.partition_folders(spark, str(path))
    assert {r[0] for r in seen.collect()} == {
        "year=2024/month=01/day=05", "year=2024/month=01/day=31", "year=2024/month=11/day=02",
    }
    gone = "year=2024/month=01/day=31"
    catalog.refresh_table(spark, table, seen.filter(F.col("partition") != gone))
    assert "1 partitions have no files" in caplog.text
    stale = catalog.stale_partitions(spark, table, seen.filter(F.col("partition") != gone))
    assert [r[0] for r in stale.collect()] == [gone]

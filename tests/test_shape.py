import re
from datetime import UTC, datetime

import pytest

from clearwell.contracts import EVENTS, ORDERS, Contract, ContractError, contract_for
from clearwell.functions.names import tidy_names
from clearwell.operators import shape


@pytest.mark.parametrize(
    ("raw", "tidy"),
    [("Unit Colour", "unit_colour"), ("ship-to", "ship_to"), ("SKUCode", "skucode"), ("lot_nr", "lot_nr"),
     (" v.w ", "v_w"), ("P  Q", "p__q")],
)
def test_names(spark, raw, tidy):
    df = spark.createDataFrame([("x",)], [raw])
    assert shape.normalize_names(df).columns == [tidy]


def test_names_that_fall_together(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["A B", "a-b", "a_b_2"])
    with pytest.raises(ContractError, match="a_b"):
        shape.normalize_names(df)
    assert shape.normalize_names(df, "suffix").columns == ["a_b", "a_b_3", "a_b_2"]
    with pytest.raises(ValueError, match="on_collision"):
        tidy_names(["A", "a"], "drop")


@pytest.mark.parametrize(("values", "n"), [("xyxzxy", 3), ("pq", 2), ("kkkk", 1)])
def test_dedup(spark, values, n):
    assert shape.deduplicate(spark.createDataFrame([(v,) for v in values], ["v"])).count() == n


def test_dedup_counts_nulls_and_maps_as_equal(spark):
    rows = [({"a": 1, "b": None}, None), ({"b": None, "a": 1}, None), ({"a": 2}, None)]
    df = spark.createDataFrame(rows, "m map<string,int>, x string")
    copies = {row["m"]["a"]: row["_copies"] for row in shape.count_copies(df).collect()}
    assert copies == {1: 2, 2: 1}
    assert shape.duplicate_count(df).first().asDict() == {"raw_count": 3, "distinct_count": 2, "duplicate_count": 1}


def test_duplicate_count_of_nothing(spark):
    empty = spark.createDataFrame([], "a int")
    assert tuple(shape.duplicate_count(empty).first()) == (0, 0, 0)


def test_drop_all_null(spark):
    rows = [(None, None, 5), (None, None, None), ("", None, None), (None, False, None), (None, None, None)]
    df = spark.createDataFrame(rows, "tag string, open boolean, size int")
    assert sorted(map(str, shape.drop_all_null_rows(df).collect())) == sorted(
        ["Row(tag=None, open=None, size=5)", "Row(tag='', open=None, size=None)", "Row(tag=None, open=False, size=None)"]
    )


def _date(df):
    row = df.first()
    return row["year"], row["month"], row["day"]


@pytest.mark.parametrize("name", ["created_at", "timestamp", "event_time", "date", "updated_at"])
def test_date_columns(spark, name):
    dated = shape.add_date_partitions(spark.createDataFrame([("2021-12-09 23:00:01",)], [name]))
    assert dated.columns == [name, "year", "month", "day"]
    assert _date(dated) == ("2021", "12", "09")


def test_first_date_column_wins_even_when_null(spark):
    df = spark.createDataFrame([("2019-08-30", None)], "timestamp string, created_at string")
    assert _date(shape.add_date_partitions(df)) == (None, None, None)
    assert _date(shape.add_date_partitions(df, "timestamp")) == ("2019", "08", "30")


def test_date_of_bad_text_and_of_the_run(spark):
    assert _date(shape.add_date_partitions(spark.createDataFrame([("soon",)], ["date"]))) == (None, None, None)
    df = spark.createDataFrame([(1,)], ["id"])
    assert _date(shape.add_date_partitions(df, run_ts=datetime(2023, 12, 31, 23, 59, tzinfo=UTC))) == ("2023", "12", "31")
    assert re.fullmatch(r"\d{4}", _date(shape.add_date_partitions(df))[0])


def test_utc_decides_the_day(spark):
    df = spark.createDataFrame([("2024-01-15T23:30:00-02:00",)], ["timestamp"])
    assert _date(shape.add_date_partitions(df)) == ("2024", "01", "16")


CONTRACT = Contract("t", {"id": "string", "weight": "double", "qty": "int", "note": "string"}, not_null=("id",))


def test_contract_casts_adds_and_keeps(spark):
    df = spark.createDataFrame([("x1", "12", 7, "0.25")], "extra string, qty string, id int, weight string")
    typed = shape.apply_contract(df, CONTRACT, count_failures=True)
    assert typed.dtypes == [
        ("id", "string"), ("weight", "double"), ("qty", "int"), ("note", "string"), ("extra", "string"),
        ("_cast_failures", "int"),
    ]
    assert tuple(typed.first()) == ("7", 0.25, 12, None, "x1", 0)


@pytest.mark.parametrize(
    ("text", "value", "failures"),
    [("abc", None, 1), ("", None, 1), (None, None, 0), (" 4 ", 4, 0), ("2.0", 2, 0), ("99999999999", None, 1)],
)
def test_bad_casts_become_null(spark, text, value, failures):
    df = spark.createDataFrame([("a", text)], "id string, qty string")
    row = shape.apply_contract(df, CONTRACT, count_failures=True).first()
    assert (row["qty"], row["_cast_failures"]) == (value, failures)


def test_missing_required_column(spark):
    df = spark.createDataFrame([(1,)], "qty int")
    assert "id" not in shape.apply_contract(df, CONTRACT).columns
    with pytest.raises(ContractError, match="id"):
        shape.apply_contract(df, CONTRACT, strict=True)


def test_impossible_cast_names_the_column(spark):
    df = spark.sql("SELECT 'a' AS id, timestamp_ntz'2024-01-01 00:00:00' AS qty")
    with pytest.raises(ContractError, match="qty is timestamp_ntz"):
        shape.apply_contract(df, CONTRACT)


def test_contract_registry():
    assert contract_for("orders") is ORDERS
    assert contract_for("events") is EVENTS
    other = contract_for("parquet_dump")
    assert (other.columns, other.not_null, other.positive) == ({}, (), ())


def test_union_keeps_values_of_both_types(spark):
    left = spark.sql("SELECT 1 AS id, timestamp'2024-01-15 10:30:00' AS at, 'l' AS only_left")
    right = spark.sql("SELECT 'no time' AS at, 2 AS id")
    rows = shape.union_by_name(left, right).orderBy("id").collect()
    assert [tuple(r) for r in rows] == [(1, "2024-01-15 10:30:00", "l"), (2, "no time", None)]


def test_date_range_over_years(spark):
    days = ["2022-12-31", "2023-01-01", "2023-06-15", "2024-02-29", "2024-03-01"]
    df = shape.add_date_partitions(spark.createDataFrame([(d,) for d in days], ["date"]))
    got = [r["date"] for r in shape.date_range(df, "2023-01-01", "2024-02-29").orderBy("date").collect()]
    assert got == days[1:4]
    with pytest.raises(ValueError, match="yyyy-mm-dd"):
        shape.date_range(df, "2023-1-1", "2024-02-29")


def test_distinct_dates(spark):
    df = shape.add_date_partitions(spark.createDataFrame([("2024-01-01",), ("2024-01-01",), (None,)], "date string"))
    assert shape.distinct_dates(df).count() == 2

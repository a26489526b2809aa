"""Stored reports and profiles against those of all rows at once."""

from pathlib import Path

import pytest

from clearwell.contracts import ORDERS
from clearwell.plans import batch, incremental, reports

FIELDS = "order_id string, customer_id string, quantity string, total_amount string, status string, created_at string"


def write(spark, lake, name, rows):
    """Rows of (customer, amount, status, day)."""
    values = [(f"{name}-{k}", who, "1", amount, status, day) for k, (who, amount, status, day) in enumerate(rows)]
    batch.run_batch(spark.createDataFrame(values, FIELDS), ORDERS, lake, name)


MARCH = [("c1", "0.1", "paid", "2024-03-01 10:00:00"), ("c1", "0.2", "paid", "2024-03-01 11:00:00"),
         ("c2", "5", "cancelled", "2024-03-01 12:00:00"), ("c2", "7.25", "paid", "2024-03-02 12:00:00"),
         ("c2", "1", None, "2024-03-02 12:00:00"), ("c9", "2", "paid", None)]
APRIL = [("c1", "3", "paid", "2024-04-09 10:00:00"), ("c3", "1e300", "paid", "2024-04-09 11:00:00")]
LATE = [("c1", "0.3", "paid", "2024-03-01 23:00:00"), ("c4", "9", "paid", "2024-03-31 00:00:00")]


@pytest.fixture
def lake(spark, tmp_path):
    write(spark, str(tmp_path), "a", MARCH)
    write(spark, str(tmp_path), "b", APRIL)
    return str(tmp_path)


def same_report(spark, lake):
    full = reports.daily_revenue(batch.clean_rows(spark, lake, ORDERS), digits=2)
    kept = incremental.kept_daily_revenue(spark, lake)
    assert kept.columns == full.columns
    wanted = [tuple(row) for row in full.collect()]
    assert [tuple(row) for row in kept.collect()] == wanted
    return wanted


def test_only_the_months_of_a_late_batch(spark, lake):
    months = incremental.refresh_daily_revenue(spark, lake)
    assert ("2024", "03") in months and ("2024", "04") in months
    assert len(same_report(spark, lake)) >= 3
    april = sorted(p.name for p in Path(lake).rglob("result/year=2024/month=04/*.parquet"))
    write(spark, lake, "c", LATE)
    assert incremental.refresh_daily_revenue(spark, lake) == [("2024", "03")]
    assert sorted(p.name for p in Path(lake).rglob("result/year=2024/month=04/*.parquet")) == april
    same_report(spark, lake)
    assert incremental.refresh_daily_revenue(spark, lake) == []


def test_a_batch_written_again_is_taken_back(spark, lake):
    incremental.refresh_daily_revenue(spark, lake)
    write(spark, lake, "b", [("c5", "4", "paid", "2024-05-01 00:00:00")])
    assert incremental.refresh_daily_revenue(spark, lake) == [("2024", "04"), ("2024", "05")]
    assert not [row for row in same_report(spark, lake) if row[1] == "04"]


@pytest.mark.parametrize("first", [True, False])
def test_compacted_batches_are_known(spark, lake, first):
    if first:
        incremental.refresh_daily_revenue(spark, lake)
    batch.compact(spark, lake, ORDERS)
    batch.compact(spark, lake, ORDERS)
    assert (incremental.refresh_daily_revenue(spark, lake) == []) == first
    same_report(spark, lake)
    write(spark, lake, "a", LATE)
    assert ("2024", "03") in incremental.refresh_daily_revenue(spark, lake)
    same_report(spark, lake)


@pytest.mark.parametrize("step", ["store_partials", "done", "_write_months"])
def test_a_run_that_ends_early_is_made_good(spark, lake, monkeypatch, step):
    incremental.refresh_daily_revenue(spark, lake)
    write(spark, lake, "a", LATE)

    def lost(*_):
        raise OSError("lost")

    monkeypatch.setattr(incremental if step.startswith("_") else incremental.Kept, step, lost)
    with pytest.raises(OSError):
        incremental.refresh_daily_revenue(spark, lake)
    monkeypatch.undo()
    incremental.refresh_daily_revenue(spark, lake)
    same_report(spark, lake)


def test_other_settings_are_refused(spark, lake):
    incremental.refresh_daily_revenue(spark, lake)
    with pytest.raises(ValueError, match="other settings"):
        incremental.refresh_daily_revenue(spark, lake, cancelled="gone")


def test_nothing_there(spark, tmp_path):
    lake = str(tmp_path)
    assert incremental.refresh_daily_revenue(spark, lake) == []
    assert incremental.kept_daily_revenue(spark, lake).collect() == []
    assert incremental.refresh_profile(spark, lake, ORDERS) == []
    assert incremental.kept_profile(spark, lake, ORDERS).collect() == []


def test_profile_over_batches(spark, tmp_path):
    lake = str(tmp_path)
    for part in range(3):
        rows = [(f"c{k % 700}", str(k + 1), "paid", "2024-03-01 00:00:00") for k in range(part * 1000, part * 1000 + 1500)]
        write(spark, lake, f"p{part}", rows)
        assert incremental.refresh_profile(spark, lake, ORDERS) == [f"p{part}"]
    found = {row.column_name: row for row in incremental.kept_profile(spark, lake, ORDERS).collect()}
    assert found["total_amount"].row_count == found["total_amount"].filled_count == 4500
    assert found["unit_price"].filled_count == 0 and found["unit_price"].quantiles is None
    assert abs(found["customer_id"].distinct_count - 700) <= 0.04 * 700
    assert abs(found["total_amount"].distinct_count - 3500) <= 0.04 * 3500
    values = sorted(row.total_amount for row in batch.clean_rows(spark, lake, ORDERS).collect())
    for share, value in zip((0.05, 0.25, 0.5, 0.75, 0.95), found["total_amount"].quantiles, strict=True):
        assert abs(sum(v <= value for v in values) / len(values) - share) <= 0.03
    batch.compact(spark, lake, ORDERS)
    assert incremental.refresh_profile(spark, lake, ORDERS) == []
    write(spark, lake, "p0", [("c1", "1", "paid", "2024-03-01 00:00:00")])
    assert incremental.refresh_profile(spark, lake, ORDERS) == ["p0"]
    found = {row.column_name: row for row in incremental.kept_profile(spark, lake, ORDERS).collect()}
    assert found["order_id"].row_count == 3001

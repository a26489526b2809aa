from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clearwell.operators import quality

DDL = "id string, owner string, qty int, amount double"


def _split(spark, rows, not_null=("id",), positive=("amount",), ddl="id string, amount double"):
    clean, bad = quality.split_quarantine(spark.createDataFrame(rows, ddl), not_null, positive)
    return clean, bad


def test_null_id(spark):
    clean, bad = _split(spark, [("k", 0.5), (None, 7.25), ("m", 3.0), (None, None)])
    assert sorted(r["id"] for r in clean.collect()) == ["k", "m"]
    assert [r["_quarantine_reason"] for r in bad.collect()] == ["null:id"] * 2
    assert "_quarantine_reason" not in clean.columns


def test_not_positive(spark):
    clean, bad = _split(spark, [("k", -0.0), ("m", 1e-9), ("n", -3.5), ("o", 8.0)])
    assert sorted(r["id"] for r in clean.collect()) == ["m", "o"]
    assert {(r["id"], r["_quarantine_reason"]) for r in bad.collect()} == {
        ("k", "non_positive:amount"), ("n", "non_positive:amount"),
    }


def test_all_good_and_no_rules(spark):
    clean, bad = _split(spark, [(str(n), n + 0.5) for n in range(7)])
    assert (clean.count(), bad.count()) == (7, 0)
    clean, bad = _split(spark, [(None, None), (None, -1.0)], (), ())
    assert (clean.count(), bad.count()) == (2, 0)


def test_null_amount_is_clean_and_not_lost(spark):
    clean, bad = _split(spark, [("q", None)])
    assert (clean.count(), bad.count()) == (1, 0)


def test_rules_on_absent_columns_are_skipped(spark):
    clean, bad = _split(spark, [("a", 1.0)], ("id", "nope"), ("amount", "neither"))
    assert (clean.count(), bad.count()) == (1, 0)


def _expected(row):
    record = dict(zip(("id", "owner", "qty", "amount"), row, strict=True))
    for name in ("id", "owner"):
        if record[name] is None:
            return f"null:{name}"
    for name in ("qty", "amount"):
        if record[name] is not None and record[name] <= 0:
            return f"non_positive:{name}"
    return None


ROW = st.tuples(
    st.sampled_from([None, "a", "b"]),
    st.sampled_from([None, "o"]),
    st.sampled_from([None, -1, 0, 1]),
    st.sampled_from([None, -0.5, 0.0, 2.5]),
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(ROW, min_size=1, max_size=60))
def test_every_row_is_on_one_side_with_its_first_failure(spark, rows):
    df = spark.createDataFrame([(*row, n) for n, row in enumerate(rows)], f"{DDL}, n int")
    clean, bad = quality.split_quarantine(df, ("id", "owner"), ("qty", "amount"))
    got = {r["n"]: None for r in clean.collect()} | {r["n"]: r["_quarantine_reason"] for r in bad.collect()}
    assert got == {n: _expected(row) for n, row in enumerate(rows)}
    assert clean.count() + bad.count() == len(rows)


def _metrics(spark, raw, clean, bad):
    return quality.frame_metrics(*[spark.range(n) for n in (raw, clean, bad)]).first()


def test_metrics(spark):
    row = _metrics(spark, 9, 7, 2)
    assert (row["raw_count"], row["clean_count"], row["quarantine_count"]) == (9, 7, 2)
    assert (row["pass_rate_pct"], row["below_threshold"]) == (77.78, True)
    row = _metrics(spark, 0, 0, 0)
    assert (row["raw_count"], row["pass_rate_pct"]) == (0, 0.0)
    assert _metrics(spark, 32, 29, 3)["pass_rate_pct"] == 90.62
    row = _metrics(spark, 6, 6, 0)
    assert (row["pass_rate_pct"], row["below_threshold"]) == (100.0, False)


def test_metrics_of_marked_rows(spark):
    df = spark.createDataFrame([("a", 1.0), (None, 2.0), ("b", None)], "id string, amount double")
    marked = quality.mark_failures(df, ("id",), ("amount",))
    assert tuple(quality.quality_metrics(marked).first()) == (3, 2, 1, 66.67, True)
    assert tuple(quality.quality_metrics(marked.limit(0)).first()) == (0, 0, 0, 0.0, True)


def test_alert_line(spark, caplog):
    assert not _metrics(spark, 10, 8, 2)["below_threshold"]
    low = _metrics(spark, 100, 79, 21).asDict()
    quality.log_verdict("orders", low)
    assert "79.00% is below 80%" in caplog.text


def test_reason_histogram(spark):
    _, bad = _split(spark, [(None, 1.0), (None, -1.0), ("a", 0.0)])
    got = {tuple(r) for r in quality.reason_histogram(bad).collect()}
    assert got == {("null:id", 2), ("non_positive:amount", 1)}


def test_profile(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), (None, 3), ("b", 4)], "s string, `odd.name` int")
    for exact in (True, False):
        rows = {r["column_name"]: r for r in quality.profile(df, exact=exact).collect()}
        assert (rows["s"]["filled_count"], rows["s"]["distinct_count"], rows["s"]["completeness"]) == (3, 2, 0.75)
        assert rows["odd.name"]["uniqueness"] == 1.0
    empty = quality.profile(df.filter(F.lit(False))).first()
    assert (empty["row_count"], empty["completeness"], empty["uniqueness"]) == (0, None, None)

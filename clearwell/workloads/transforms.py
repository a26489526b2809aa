"""The row operators on the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clearwell.contracts import Contract
from clearwell.operators import quality, shape
from clearwell.workloads import shapes
from clearwell.workloads.registry import Tables, query
from clearwell.workloads.shapes import SQL_DATE_PARTS, SQL_FAULTY_CUSTOMERS

_NOT_NULL, _POSITIVE = ("customer_id",), ("balance",)


@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def normalize_names(t: Tables) -> DataFrame:
    messy = t["customer"].toDF("C CustKey", " c_name ", "C-NATIONKEY", "c.acctbal", "C_mktSegment")
    return shape.normalize_names(messy)


@query("SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
def dedup_rows(t: Tables) -> DataFrame:
    return shape.deduplicate(t["lineitem"].select("l_orderkey", "l_linenumber"))


@query("""
    SELECT CAST(sum(n) AS BIGINT) AS raw_count, count(*) AS distinct_count,
        CAST(sum(n - 1) AS BIGINT) AS duplicate_count
    FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)
""")
def duplicate_count(t: Tables) -> DataFrame:
    return shape.duplicate_count(t["lineitem"].select("l_orderkey", "l_linenumber"))


@query("""
    SELECT c_name, c_acctbal FROM (
        SELECT CASE WHEN c_custkey % 10 <> 0 THEN c_name END AS c_name,
            CASE WHEN c_custkey % 5 <> 0 THEN c_acctbal END AS c_acctbal
        FROM customer)
    WHERE c_name IS NOT NULL OR c_acctbal IS NOT NULL
""")
def drop_all_null(t: Tables) -> DataFrame:
    key = F.col("c_custkey")
    gappy = t["customer"].select(
        F.when(key % 10 != 0, F.col("c_name")).alias("c_name"),
        F.when(key % 5 != 0, F.col("c_acctbal")).alias("c_acctbal"),
    )
    return shape.drop_all_null_rows(gappy)


_TYPED = Contract(
    "typed_orders",
    columns={"order_id": "string", "customer_id": "int", "amount": "double", "channel": "string", "placed_at": "timestamp"},
    not_null=("order_id",),
)


def _as_text(t: Tables) -> DataFrame:
    key = F.col("o_orderkey")
    money = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    moment = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    return t["orders"].select(
        F.col("o_orderpriority").alias("priority"),
        key.cast("string").alias("order_id"),
        F.when(key % 89 == 0, "?").otherwise(F.col("o_custkey").cast("string")).alias("customer_id"),
        F.when(key % 97 == 0, F.concat(F.lit("x"), money)).otherwise(money).alias("amount"),
        F.when(key % 83 == 0, "soon").otherwise(moment).alias("placed_at"),
    )


_SQL_AS_TEXT = """
    text_rows AS (
        SELECT o_orderpriority AS priority, CAST(o_orderkey AS VARCHAR) AS order_id,
            CASE WHEN o_orderkey % 89 = 0 THEN '?' ELSE CAST(o_custkey AS VARCHAR) END AS customer_id,
            CASE WHEN o_orderkey % 97 = 0 THEN 'x' ELSE '' END
                || CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS VARCHAR) AS amount,
            CASE WHEN o_orderkey % 83 = 0 THEN 'soon'
                 ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS placed_at
        FROM orders
    ),
    typed AS (
        SELECT order_id, TRY_CAST(customer_id AS INTEGER) AS customer_id, TRY_CAST(amount AS DOUBLE) AS amount,
            CAST(NULL AS VARCHAR) AS channel, TRY_CAST(placed_at AS TIMESTAMP) AS placed_at, priority
        FROM text_rows
    )"""


@query(f"WITH {_SQL_AS_TEXT} SELECT * FROM typed")
def apply_contract(t: Tables) -> DataFrame:
    typed = shape.apply_contract(_as_text(t), _TYPED)
    return typed.withColumn("placed_at", F.col("placed_at").cast("timestamp_ntz"))


@query(f"""
    WITH {_SQL_AS_TEXT}
    SELECT failures, count(*) AS orders FROM (
        SELECT CASE WHEN customer_id IS NULL THEN 1 ELSE 0 END + CASE WHEN amount IS NULL THEN 1 ELSE 0 END
            + CASE WHEN placed_at IS NULL THEN 1 ELSE 0 END AS failures
        FROM typed)
    GROUP BY failures
""")
def cast_failures(t: Tables) -> DataFrame:
    counted = shape.apply_contract(_as_text(t), _TYPED, count_failures=True)
    return counted.groupBy(F.col(shape.CAST_FAILURES).alias("failures")).agg(F.count(F.lit(1)).alias("orders"))


@query(f"""
    SELECT CAST(o_orderkey AS VARCHAR) AS order_id, o_orderdate AS created_at, {SQL_DATE_PARTS.format("o_orderdate")}
    FROM orders
""")
def date_partitions(t: Tables) -> DataFrame:
    return shapes.orders(t).select("order_id", "created_at", "year", "month", "day")


@query(f"""
    SELECT event_id, {SQL_DATE_PARTS.format("event_time")} FROM (
        SELECT event_id, CASE WHEN event_id % 17 <> 0 THEN ts END AS event_time FROM events)
""")
def event_date_partitions(t: Tables) -> DataFrame:
    """Times given as text, some of them no times; those get no date."""
    event_time = F.when(F.col("event_id") % 17 == 0, "n/a").otherwise(F.col("ts").cast("string"))
    rows = t["events"].select("event_id", event_time.alias("event_time"))
    return shape.add_date_partitions(rows).drop("event_time")


@query(f"SELECT DISTINCT {SQL_DATE_PARTS.format('o_orderdate')} FROM orders")
def distinct_dates(t: Tables) -> DataFrame:
    return shape.distinct_dates(shapes.orders(t))


@query("""
    SELECT s_name AS name, CAST(s_nationkey AS VARCHAR) AS nation, s_acctbal AS balance, CAST(NULL AS VARCHAR) AS segment
    FROM supplier
    UNION ALL
    SELECT c_name, 'N' || CAST(c_nationkey AS VARCHAR), c_acctbal, c_mktsegment FROM customer
""")
def union_by_name(t: Tables) -> DataFrame:
    """A number and a text column of one name become text; an absent column is NULL."""
    suppliers = t["supplier"].select(
        F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"), F.col("s_acctbal").alias("balance")
    )
    customers = t["customer"].select(
        F.col("c_mktsegment").alias("segment"),
        F.col("c_acctbal").alias("balance"),
        F.concat(F.lit("N"), F.col("c_nationkey").cast("string")).alias("nation"),
        F.col("c_name").alias("name"),
    )
    return shape.union_by_name(suppliers, customers)


@query(f"""
    WITH {SQL_FAULTY_CUSTOMERS}
    SELECT customer_id, c_name, balance FROM marked WHERE _quarantine_reason IS NULL
""")
def clean_rows(t: Tables) -> DataFrame:
    return quality.split_quarantine(shapes.faulty_customers(t), _NOT_NULL, _POSITIVE)[0]


@query(f"WITH {SQL_FAULTY_CUSTOMERS} SELECT * FROM marked WHERE _quarantine_reason IS NOT NULL")
def quarantine_rows(t: Tables) -> DataFrame:
    return quality.split_quarantine(shapes.faulty_customers(t), _NOT_NULL, _POSITIVE)[1]


@query(f"""
    WITH {SQL_FAULTY_CUSTOMERS}
    SELECT _quarantine_reason, count(*) AS count FROM marked WHERE _quarantine_reason IS NOT NULL GROUP BY 1
""")
def quarantine_reasons(t: Tables) -> DataFrame:
    return quality.reason_histogram(quarantine_rows(t))


_SQL_QUALITY = f"""
    WITH {SQL_FAULTY_CUSTOMERS},
    counts AS (
        SELECT count(*) AS raw_count, count(*) FILTER (_quarantine_reason IS NULL) AS clean_count,
            count(_quarantine_reason) AS quarantine_count
        FROM marked
    )
    SELECT *, round_even(CAST(clean_count AS DOUBLE) / raw_count * 100, 2) AS pass_rate_pct,
        round_even(CAST(clean_count AS DOUBLE) / raw_count * 100, 2) < 80 AS below_threshold
    FROM counts
"""


@query(_SQL_QUALITY)
def quality_metrics(t: Tables) -> DataFrame:
    return quality.quality_metrics(quality.mark_failures(shapes.faulty_customers(t), _NOT_NULL, _POSITIVE))


@query(_SQL_QUALITY)
def frame_metrics(t: Tables) -> DataFrame:
    raw = shapes.faulty_customers(t)
    return quality.frame_metrics(raw, *quality.split_quarantine(raw, _NOT_NULL, _POSITIVE))


@query("""
    WITH faulty AS (
        SELECT o_custkey, o_orderpriority, CASE WHEN o_orderkey % 6 <> 0 THEN o_orderstatus END AS o_orderstatus
        FROM orders
    ),
    stats AS (
        SELECT 'o_custkey' AS column_name, count(*) AS row_count, count(o_custkey) AS filled_count,
            count(DISTINCT o_custkey) AS distinct_count FROM faulty
        UNION ALL
        SELECT 'o_orderpriority', count(*), count(o_orderpriority), count(DISTINCT o_orderpriority) FROM faulty
        UNION ALL
        SELECT 'o_orderstatus', count(*), count(o_orderstatus), count(DISTINCT o_orderstatus) FROM faulty
    )
    SELECT *, CAST(filled_count AS DOUBLE) / row_count AS completeness,
        CAST(distinct_count AS DOUBLE) / filled_count AS uniqueness
    FROM stats
""")
def column_profile(t: Tables) -> DataFrame:
    rows = t["orders"].select(
        "o_custkey",
        "o_orderpriority",
        F.when(F.col("o_orderkey") % 6 != 0, F.col("o_orderstatus")).alias("o_orderstatus"),
    )
    return quality.profile(rows, exact=True)

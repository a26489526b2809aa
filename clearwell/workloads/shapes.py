"""The test tables in the shape of the order and event contracts, and broken copies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clearwell.contracts import Contract
from clearwell.operators.shape import add_date_partitions
from clearwell.workloads.registry import Tables

ORDER_TYPES = {
    "o_orderkey": "bigint",
    "o_custkey": "bigint",
    "o_orderstatus": "string",
    "o_totalprice": "double",
    "o_orderdate": "timestamp_ntz",
    "o_orderpriority": "string",
}
STORED_ORDERS = Contract("stored_orders", columns=ORDER_TYPES)

COUNTRIES = ("NO", "NZ", "PT", "KE", "CL")
DEVICES = ("tv", "watch", "kiosk")

# SQL twin of the date parts of a column.
SQL_DATE_PARTS = """
    CAST(year({0}) AS VARCHAR) AS year,
    lpad(CAST(month({0}) AS VARCHAR), 2, '0') AS month,
    lpad(CAST(day({0}) AS VARCHAR), 2, '0') AS day"""


def pick(index: Column, values: tuple[str, ...]) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def sql_pick(index: str, values: tuple[str, ...]) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    return f"([{listed}])[CAST({index} AS INTEGER) + 1]"


def orders(t: Tables) -> DataFrame:
    """Clean orders as the reports expect them; ``F`` stands for cancelled."""
    shaped = t["orders"].select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("o_totalprice").alias("total_amount"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderdate").alias("created_at"),
    )
    return add_date_partitions(shaped)


def events(t: Tables) -> DataFrame:
    """Clean events; a user's day stands for a session."""
    label = F.get_json_object("props", "$.k").cast("int")
    shaped = t["events"].select(
        F.col("event_id").cast("string").alias("event_id"),
        F.col("user_id").cast("string").alias("user_id"),
        "event_type",
        F.concat_ws("-", F.col("user_id").cast("string"), F.to_date("ts").cast("string")).alias("session_id"),
        pick(label % len(DEVICES), DEVICES).alias("device"),
        pick(F.col("user_id") % len(COUNTRIES), COUNTRIES).alias("country"),
        F.col("ts").alias("timestamp"),
    )
    return add_date_partitions(shaped)


SQL_EVENTS = f"""
    SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS user_id, event_type,
        CAST(user_id AS VARCHAR) || '-' || CAST(CAST(ts AS DATE) AS VARCHAR) AS session_id,
        {sql_pick(f"CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) % {len(DEVICES)}", DEVICES)} AS device,
        {sql_pick(f"user_id % {len(COUNTRIES)}", COUNTRIES)} AS country, ts
    FROM events"""


def messy_orders(t: Tables) -> DataFrame:
    """Orders as a careless upload: text only, odd names, copies, gaps, bad values.

    Every 9th order comes twice and every 101st row is empty.
    """
    key = F.col("o_orderkey")

    def every(n: int) -> Column:
        return key % n == 0

    rows = t["orders"].withColumn("copy", F.explode(F.sequence(F.lit(1), F.when(every(9), 2).otherwise(1))))
    text = {
        "Order ID": F.when(~every(50), key.cast("string")),
        " Customer-ID": F.col("o_custkey").cast("string"),
        "PRODUCT.NAME": F.col("o_orderpriority"),
        "quantity": F.when(every(97), "x1")
        .when(every(31), "0")
        .when(~every(29), (key % 7 + 1).cast("string")),
        "Total Amount": F.when(every(41), "-1.5").otherwise(
            F.col("o_totalprice").cast("decimal(18,2)").cast("string")
        ),
        "Status": F.col("o_orderstatus"),
        "Created-At": F.when(~every(53), F.date_format("o_orderdate", "yyyy-MM-dd 00:00:00")),
        "Note": F.concat(F.lit("n"), (key % 3).cast("string")),
    }
    return rows.select(*[F.when(~every(101), value).alias(name) for name, value in text.items()])


# The same rows after names, duplicates, types, dates and rules.
SQL_MARKED_ORDERS = f"""
    filled AS (SELECT * REPLACE (CASE WHEN o_orderkey % 101 <> 0 THEN o_orderkey END AS o_orderkey),
        CASE WHEN o_orderkey % 9 = 0 THEN 2 ELSE 1 END AS copies FROM orders),
    text_rows AS (
        SELECT
            CASE WHEN o_orderkey % 50 <> 0 THEN CAST(o_orderkey AS VARCHAR) END AS order_id,
            CASE WHEN o_orderkey IS NOT NULL THEN CAST(o_custkey AS VARCHAR) END AS customer_id,
            CASE WHEN o_orderkey IS NOT NULL THEN o_orderpriority END AS product_name,
            CASE WHEN o_orderkey % 97 = 0 THEN 'x1' WHEN o_orderkey % 31 = 0 THEN '0'
                 WHEN o_orderkey % 29 <> 0 THEN CAST(o_orderkey % 7 + 1 AS VARCHAR) END AS quantity,
            CASE WHEN o_orderkey % 41 = 0 THEN '-1.5'
                 WHEN o_orderkey IS NOT NULL THEN CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS VARCHAR)
                 END AS total_amount,
            CASE WHEN o_orderkey IS NOT NULL THEN o_orderstatus END AS status,
            CASE WHEN o_orderkey % 53 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d 00:00:00') END AS created_at,
            'n' || CAST(o_orderkey % 3 AS VARCHAR) AS note,
            copies
        FROM filled
    ),
    deduped AS (
        SELECT order_id, customer_id, product_name, quantity, total_amount, status, created_at, note,
            CAST(sum(copies) AS BIGINT) AS copies
        FROM text_rows GROUP BY ALL
    ),
    typed AS (
        SELECT order_id, customer_id, product_name, TRY_CAST(quantity AS INTEGER) AS quantity,
            CAST(NULL AS DOUBLE) AS unit_price, TRY_CAST(total_amount AS DOUBLE) AS total_amount, status,
            TRY_CAST(created_at AS TIMESTAMP) AS created_at, note, copies,
            CASE WHEN quantity IS NOT NULL AND TRY_CAST(quantity AS INTEGER) IS NULL THEN 1 ELSE 0 END AS failures,
            coalesce(order_id, customer_id, product_name, quantity, total_amount, status, created_at, note) IS NULL
                AS blank
        FROM deduped
    ),
    ruled AS (
        SELECT *, {SQL_DATE_PARTS.format("created_at")},
            CASE WHEN blank THEN NULL
                 WHEN order_id IS NULL THEN 'null:order_id'
                 WHEN customer_id IS NULL THEN 'null:customer_id'
                 WHEN quantity <= 0 THEN 'non_positive:quantity'
                 WHEN total_amount <= 0 THEN 'non_positive:total_amount' END AS reason
        FROM typed
    ),
    marked AS (
        SELECT *, CASE WHEN blank THEN 'blank' WHEN reason IS NULL THEN 'clean' ELSE 'quarantine' END AS zone
        FROM ruled
    )"""
MESSY_EXTRAS = "`note` string"


def faulty_customers(t: Tables) -> DataFrame:
    """Customers where every 50th has no id; some balances are not positive."""
    return t["customer"].select(
        F.when(F.col("c_custkey") % 50 != 0, F.col("c_custkey")).alias("customer_id"),
        "c_name",
        F.col("c_acctbal").alias("balance"),
    )


SQL_FAULTY_CUSTOMERS = """
    faulty AS (
        SELECT CASE WHEN c_custkey % 50 <> 0 THEN c_custkey END AS customer_id, c_name, c_acctbal AS balance
        FROM customer
    ),
    marked AS (
        SELECT *, CASE WHEN customer_id IS NULL THEN 'null:customer_id'
                       WHEN balance <= 0 THEN 'non_positive:balance' END AS _quarantine_reason
        FROM faulty
    )"""

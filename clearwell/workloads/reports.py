"""The reports on the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clearwell.plans import reports
from clearwell.workloads import shapes
from clearwell.workloads.registry import Tables, query
from clearwell.workloads.shapes import SQL_DATE_PARTS, SQL_EVENTS

CANCELLED = "F"
_DAY = SQL_DATE_PARTS.format("o_orderdate")
_REVENUE = "CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE)"


@query(f"""
    SELECT {_DAY}, count(*) AS total_orders, {_REVENUE} AS daily_revenue,
        {_REVENUE} / count(o_totalprice) AS avg_order_value, count(DISTINCT o_custkey) AS unique_customers
    FROM orders WHERE o_orderstatus <> 'F' GROUP BY 1, 2, 3
""")
def daily_revenue(t: Tables) -> DataFrame:
    return reports.daily_revenue(shapes.orders(t), CANCELLED, digits=2)


@query(f"""
    SELECT {_DAY}, {_REVENUE} AS revenue FROM orders WHERE o_orderstatus <> 'F' GROUP BY 1, 2, 3
""")
def revenue_by_day(t: Tables) -> DataFrame:
    return reports.revenue_by_day(shapes.orders(t), CANCELLED, digits=2)


@query("""
    SELECT p_name AS product_name, count(*) AS order_count,
        CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS units_sold,
        CAST(sum(CAST(l_extendedprice AS DECIMAL(18, 2))) AS DOUBLE) AS total_revenue
    FROM lineitem JOIN part ON l_partkey = p_partkey
    WHERE l_linestatus = 'F'
    GROUP BY p_name ORDER BY total_revenue DESC, product_name LIMIT 10
""")
def top_products(t: Tables) -> DataFrame:
    """Line items are added up per part before the join, so a best-seller is one row in it."""
    lines = t["lineitem"].select(
        "l_partkey",
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("total_amount"),
        F.col("l_linestatus").alias("status"),
    )
    per_part = reports.product_totals(lines, "l_partkey", completed="F", digits=2)
    names = t["part"].select(F.col("p_partkey").alias("l_partkey"), F.col("p_name").alias("product_name"))
    return reports.top_of_totals(per_part.join(names, "l_partkey"), digits=2)


_FINE = "CAST(o_orderkey % 1000 AS DOUBLE) / 1000000 + o_orderkey % 7"
_FINE_SUM = f"CAST(sum(CAST({_FINE} AS DECIMAL(30, 6))) AS DOUBLE)"


@query(f"""
    SELECT {_DAY}, {_FINE_SUM} AS revenue FROM orders WHERE o_orderstatus <> 'F' GROUP BY 1, 2, 3
""")
def fine_revenue(t: Tables) -> DataFrame:
    """Amounts with six decimal places lose none of them."""
    amount = (F.col("order_id").cast("bigint") % 1000).cast("double") / 1000000 + F.col("order_id").cast("bigint") % 7
    return reports.revenue_by_day(shapes.orders(t).withColumn("total_amount", amount), CANCELLED, digits=6)


@query("""
    SELECT o_orderstatus AS status, count(*) AS order_count,
        CAST(round(sum(CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderkey % 5 = 1 THEN 1e15 ELSE o_totalprice END)
            / 1e12) AS BIGINT) AS thousand_billions
    FROM orders GROUP BY 1
""")
def wide_revenue(t: Tables) -> DataFrame:
    """Very large amounts and missing ones fail no report, whatever digits are asked for."""
    key = F.col("order_id").cast("bigint")
    amount = F.when(key % 5 == 1, 1e15).when(key % 5 != 0, F.col("total_amount"))
    orders = shapes.orders(t).withColumn("total_amount", amount).withColumn("quantity", F.lit(1))
    rows = orders.withColumn("product", F.col("status")).withColumn("status", F.lit("all"))
    totals = reports.product_totals(rows, "product", completed="all", digits=6)
    billions = F.round(F.col("total_revenue") / 1e12).cast("bigint").alias("thousand_billions")
    return totals.select(F.col("product").alias("status"), "order_count", billions)


@query("""
    SELECT o_orderpriority AS product_name, count(*) AS order_count, CAST(sum(o_orderkey % 5) AS BIGINT) AS units_sold,
        CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS total_revenue
    FROM orders WHERE o_orderstatus = 'F' GROUP BY 1 ORDER BY total_revenue DESC, product_name LIMIT 3
""")
def top_products_by_name(t: Tables) -> DataFrame:
    rows = t["orders"].select(
        F.col("o_orderpriority").alias("product_name"),
        (F.col("o_orderkey") % 5).alias("quantity"),
        F.col("o_totalprice").alias("total_amount"),
        F.col("o_orderstatus").alias("status"),
    )
    return reports.top_products(rows, completed="F", k=3, digits=2)


@query("""
    SELECT CAST(o_custkey AS VARCHAR) AS customer_id, count(*) AS total_orders,
        CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS lifetime_value,
        min(o_orderdate) AS first_order, max(o_orderdate) AS last_order
    FROM orders GROUP BY o_custkey
""")
def customer_history(t: Tables) -> DataFrame:
    return reports.customer_history(shapes.orders(t), digits=2)


@query("""
    SELECT o_orderstatus AS status, count(*) AS count,
        round(count(*) * CAST(100 AS DOUBLE) / CAST(sum(count(*)) OVER () AS DOUBLE), 2) AS pct
    FROM orders GROUP BY o_orderstatus
""")
def status_breakdown(t: Tables) -> DataFrame:
    return reports.status_breakdown(shapes.orders(t))


@query("""
    SELECT event_type, count(*) AS event_count, count(DISTINCT user_id) AS unique_users
    FROM events GROUP BY event_type
""")
def event_distribution(t: Tables) -> DataFrame:
    return reports.event_distribution(shapes.events(t))


@query(f"""
    WITH e AS ({SQL_EVENTS})
    SELECT country, device, count(*) AS sessions FROM e WHERE event_type = 'view' GROUP BY country, device
""")
def traffic(t: Tables) -> DataFrame:
    return reports.traffic(shapes.events(t), view="view")


@query(f"""
    WITH e AS ({SQL_EVENTS}),
    f AS (
        SELECT session_id,
            max(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) AS has_view,
            max(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS has_click,
            max(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS has_purchase
        FROM e GROUP BY session_id
    )
    SELECT CAST(sum(has_view) AS BIGINT) AS views, CAST(sum(has_click) AS BIGINT) AS clicks,
        CAST(sum(has_purchase) AS BIGINT) AS purchases,
        round(CAST(sum(has_purchase) AS DOUBLE) * 100 / nullif(CAST(sum(has_view) AS DOUBLE), 0), 2)
            AS conversion_rate_pct
    FROM f
""")
def funnel(t: Tables) -> DataFrame:
    return reports.funnel(shapes.events(t), view="view")


@query("""
    SELECT order_id, status FROM (
        SELECT CAST(o_orderkey AS VARCHAR) AS order_id,
            CASE WHEN o_orderkey % 11 <> 0 THEN o_orderstatus END AS status
        FROM orders)
    WHERE status <> 'F'
""")
def not_cancelled_orders(t: Tables) -> DataFrame:
    """An order without a status is neither cancelled nor not cancelled."""
    key = F.col("o_orderkey")
    rows = t["orders"].select(
        key.cast("string").alias("order_id"), F.when(key % 11 != 0, F.col("o_orderstatus")).alias("status")
    )
    return reports.not_cancelled(rows, CANCELLED)

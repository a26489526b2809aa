"""Reports over clean orders and events.

Each takes contract-shaped rows and returns a lazy DataFrame. Values that mean
"cancelled", "completed" or "viewed" are parameters. Sums of money are plain
sums; with ``digits`` they are exact to so many decimal places and do not change with
the order rows arrive in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clearwell.functions.values import DATE_PARTS, exact_sum


def _rows() -> Column:
    return F.count(F.lit(1))


def not_cancelled(orders: DataFrame, cancelled: str = "cancelled") -> DataFrame:
    """Orders with a known status other than ``cancelled``."""
    return orders.filter(F.col("status") != cancelled)


def daily_revenue(orders: DataFrame, cancelled: str = "cancelled", digits: int | None = None) -> DataFrame:
    """Orders, revenue, average value and customers per day."""
    amount = F.col("total_amount")
    totals = (
        not_cancelled(orders, cancelled)
        .groupBy(*DATE_PARTS)
        .agg(
            _rows().alias("total_orders"),
            exact_sum(amount, digits).alias("daily_revenue"),
            F.count(amount).alias("amounts"),
            F.count_distinct("customer_id").alias("unique_customers"),
        )
    )
    return totals.select(
        *DATE_PARTS,
        "total_orders",
        "daily_revenue",
        F.try_divide(F.col("daily_revenue"), F.col("amounts").cast("double")).alias("avg_order_value"),
        "unique_customers",
    ).orderBy(*DATE_PARTS)


def revenue_by_day(orders: DataFrame, cancelled: str = "cancelled", digits: int | None = None) -> DataFrame:
    """Revenue per day."""
    revenue = exact_sum(F.col("total_amount"), digits).alias("revenue")
    return not_cancelled(orders, cancelled).groupBy(*DATE_PARTS).agg(revenue).orderBy(*DATE_PARTS)


def product_totals(orders: DataFrame, key: str, completed: str = "completed", digits: int | None = None) -> DataFrame:
    """Order count, units and revenue of completed orders per value of ``key``."""
    return (
        orders.filter(F.col("status") == completed)
        .groupBy(key)
        .agg(
            _rows().alias("order_count"),
            F.sum(F.col("quantity").cast("bigint")).alias("units_sold"),
            exact_sum(F.col("total_amount"), digits).alias("total_revenue"),
        )
    )


def top_of_totals(totals: DataFrame, k: int = 10, digits: int | None = None) -> DataFrame:
    """The ``k`` best-selling product names of per-product totals.

    Totals of products that share a name are added up. Equal revenues are ranked
    by name, which is a rule the report needs to be the same on every run.
    """
    return (
        totals.groupBy("product_name")
        .agg(
            F.sum("order_count").alias("order_count"),
            F.sum("units_sold").alias("units_sold"),
            exact_sum(F.col("total_revenue"), digits).alias("total_revenue"),
        )
        .orderBy(F.desc("total_revenue"), "product_name")
        .limit(k)
    )


def top_products(orders: DataFrame, completed: str = "completed", k: int = 10, digits: int | None = None) -> DataFrame:
    """The ``k`` products with the highest revenue."""
    return (
        product_totals(orders, "product_name", completed, digits)
        .orderBy(F.desc("total_revenue"), "product_name")
        .limit(k)
    )


def customer_history(orders: DataFrame, digits: int | None = None) -> DataFrame:
    """Orders, value, first and last order of each customer, best first.

    The customer id breaks ties; it also lets the sort split equal values.
    """
    return (
        orders.groupBy("customer_id")
        .agg(
            _rows().alias("total_orders"),
            exact_sum(F.col("total_amount"), digits).alias("lifetime_value"),
            F.min("created_at").alias("first_order"),
            F.max("created_at").alias("last_order"),
        )
        .orderBy(F.desc("lifetime_value"), "customer_id")
    )


def status_breakdown(orders: DataFrame) -> DataFrame:
    """Orders per status and their share in percent.

    The total is a one-row subquery over the grouped counts, whose shuffle it
    reuses; an empty window would pull all groups into one task.
    """
    counts = orders.groupBy("status").agg(_rows().alias("count"))
    total = counts.agg(F.sum("count").cast("double")).scalar()
    return counts.select("status", "count", F.round(F.col("count") * F.lit(100.0) / total, 2).alias("pct"))


def event_distribution(events: DataFrame) -> DataFrame:
    """Events and users per event type, most frequent first."""
    return (
        events.groupBy("event_type")
        .agg(_rows().alias("event_count"), F.count_distinct("user_id").alias("unique_users"))
        .orderBy(F.desc("event_count"), "event_type")
    )


def traffic(events: DataFrame, view: str = "page_view") -> DataFrame:
    """Page views per country and device; the column is called sessions."""
    return (
        events.filter(F.col("event_type") == view)
        .groupBy("country", "device")
        .agg(_rows().alias("sessions"))
        .orderBy(F.desc("sessions"), "country", "device")
    )


def funnel(
    events: DataFrame,
    view: str = "page_view",
    click: str = "click",
    purchase: str = "purchase",
) -> DataFrame:
    """Sessions with a view, a click, a purchase, and purchases per 100 views.

    The steps are counted apart: a session may buy without a view, so the rate can
    exceed 100. It is NULL without views.
    """

    def seen(event_type: str) -> Column:
        return F.max(F.when(F.col("event_type") == event_type, 1).otherwise(0))

    sessions = events.groupBy("session_id").agg(
        seen(view).alias("has_view"), seen(click).alias("has_click"), seen(purchase).alias("has_purchase")
    )
    totals = sessions.agg(
        F.sum("has_view").alias("views"), F.sum("has_click").alias("clicks"), F.sum("has_purchase").alias("purchases")
    )
    rate = F.col("purchases").cast("double") * 100.0 / F.nullif(F.col("views").cast("double"), F.lit(0.0))
    return totals.select("views", "clicks", "purchases", F.round(rate, 2).alias("conversion_rate_pct"))

"""Marts. Revenue means item plus shipping value of orders in the revenue status."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartloom.functions import exact_sum
from cartloom.operators import agg_dropna


def _of_status(df: DataFrame, status: str) -> DataFrame:
    return df.filter(F.col("order_status") == status)


def _order_revenue(fact_orders: DataFrame, keys: list[str], status: str) -> DataFrame:
    return agg_dropna(
        _of_status(fact_orders, status),
        keys,
        exact_sum("total_order_value").alias("revenue"),
        F.expr("count(order_id) as orders"),
    )


def build_mart_revenue_by_day(fact_orders: DataFrame, status: str = "delivered") -> DataFrame:
    return _order_revenue(fact_orders, ["order_date"], status)


def build_mart_revenue_by_month(fact_orders: DataFrame, status: str = "delivered") -> DataFrame:
    return _order_revenue(fact_orders, ["order_year", "order_month"], status)


def build_mart_revenue_by_category(
    fact_order_items: DataFrame, status: str = "delivered"
) -> DataFrame:
    """Items of unknown products have no category and are left out."""
    return agg_dropna(
        _of_status(fact_order_items, status),
        ["product_category_name"],
        exact_sum("item_total").alias("revenue"),
        F.expr("count(order_id) as items_sold"),
    )


def build_mart_payment_method_summary(fact_payments: DataFrame) -> DataFrame:
    """All valid payments, whatever the order's status."""
    return agg_dropna(
        fact_payments,
        ["payment_type"],
        exact_sum("payment_value").alias("total_value"),
        F.expr("count(order_id) as transaction_count"),
    )


def build_mart_order_status_daily(fact_orders: DataFrame) -> DataFrame:
    return agg_dropna(
        fact_orders, ["order_date", "order_status"], F.expr("count(order_id) as order_count")
    )


def build_mart_top_products(
    fact_order_items: DataFrame, status: str = "delivered", limit: int | None = None
) -> DataFrame:
    """Products by revenue, highest first, ties by product id; ``limit`` keeps the head only."""
    sold = agg_dropna(
        _of_status(fact_order_items, status),
        ["product_id", "product_category_name"],
        exact_sum("item_total").alias("revenue"),
        F.expr("count(order_id) as quantity"),
    ).orderBy(F.desc("revenue"), F.asc("product_id"))
    return sold if limit is None else sold.limit(limit)


def build_mart_customer_geo(
    fact_orders: DataFrame, dim_customers: DataFrame, status: str = "delivered"
) -> DataFrame:
    """Revenue, orders and buying customers per place; ``dim_customers`` has one row per customer.

    Orders are reduced to one row per customer before the join. So a customer with very many
    orders is no burden, and counting rows counts distinct customers.
    """
    per_customer = _order_revenue(fact_orders, ["customer_id"], status)
    places = dim_customers.select("customer_id", "customer_city", "customer_state")
    return agg_dropna(
        per_customer.join(places, "customer_id", "inner"),
        ["customer_state", "customer_city"],
        exact_sum("revenue").alias("revenue"),
        F.expr("sum(orders) as orders"),
        F.expr("count(customer_id) as unique_customers"),
    )

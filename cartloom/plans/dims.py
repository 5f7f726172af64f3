"""Dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame

from cartloom.functions import calendar_columns
from cartloom.operators import daily_calendar, dedupe_first


def build_dim_customers(customers: DataFrame, unique: bool = False) -> DataFrame:
    """One row per customer. ``unique`` tells that the input has no repeats (staged tables)."""
    return customers if unique else dedupe_first(customers, "customer_id")


def build_dim_products(products: DataFrame, unique: bool = False) -> DataFrame:
    """One row per product. ``unique`` tells that the input has no repeats (staged tables)."""
    return products if unique else dedupe_first(products, "product_id")


def build_dim_date(orders: DataFrame) -> DataFrame:
    """One row per day between the first and the last purchase; no rows without valid dates."""
    if "order_purchase_timestamp" not in orders.columns:
        orders = orders.selectExpr("cast(null as timestamp_ntz) as order_purchase_timestamp")
    days = daily_calendar(orders, "order_purchase_timestamp")
    parts = calendar_columns("date")
    return days.selectExpr("date", *[f"{sql} as {name}" for name, sql in parts.items()])

"""Staging: raw tables cleaned one to one. Columns a builder does not name pass through."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartloom.functions import (
    clip_non_negative,
    date_parts,
    missing_to_null,
    normalize_text,
    parse_timestamp,
)
from cartloom.operators import dedupe_first, impute_median
from cartloom.schemas import ORDER_TIMESTAMPS, PRODUCT_MEASURES
from cartloom.sinks.scratch import written_once


def clean_orders(df: DataFrame, timestamp_format: str | None = None) -> DataFrame:
    """First row per order, all statuses kept; timestamps parsed, date parts added."""
    orders = dedupe_first(df, "order_id")
    present = [c for c in ORDER_TIMESTAMPS if c in df.columns]
    if not present:
        return orders
    parsed = {c: F.expr(parse_timestamp(c, timestamp_format)) for c in present}
    orders = orders.withColumns(parsed)
    if "order_purchase_timestamp" not in present:
        return orders
    parts = date_parts("order_purchase_timestamp")
    return orders.selectExpr("*", *[f"{sql} as {name}" for name, sql in parts.items()])


def clean_customers(df: DataFrame) -> DataFrame:
    """First row per customer; city in lower case, state in upper case."""
    customers = dedupe_first(df, "customer_id")
    cases = {"customer_city": "lower", "customer_state": "upper"}
    return customers.withColumns(
        {c: normalize_text(c, case) for c, case in cases.items() if c in df.columns}
    )


def clean_products(df: DataFrame, median_method: str = "exact") -> DataFrame:
    """First row per product; category normalised, missing measures set to their median.

    The median is that of the deduplicated rows. For an exact one these are written once to a
    working folder, which feeds both the median and the result.
    """
    products = dedupe_first(df, "product_id")
    if "product_category_name" in df.columns:
        category = normalize_text("product_category_name")
        products = products.withColumn("product_category_name", category)
    measures = [c for c in PRODUCT_MEASURES if c in df.columns]
    if measures and median_method == "exact":
        products = written_once(products, "products")
    return impute_median(products, measures, median_method)


def clean_payments(df: DataFrame) -> DataFrame:
    """Payments of a known value from zero up; one row stays one transaction."""
    payments = df.filter(f"{missing_to_null('payment_value')} >= 0")
    if "payment_type" in df.columns:
        payments = payments.withColumn("payment_type", normalize_text("payment_type"))
    if "payment_installments" in df.columns:
        several = f"coalesce({missing_to_null('payment_installments')} > 1, false)"
        payments = payments.withColumn("is_installment", F.expr(several))
    return payments


def clean_order_items(df: DataFrame) -> DataFrame:
    """Missing and negative amounts become zero; the item total is added."""
    amounts = [c for c in ("price", "shipping_charges") if c in df.columns]
    items = df.withColumns({c: F.expr(clip_non_negative(c)) for c in amounts})
    if len(amounts) == 2:
        items = items.withColumn("item_total", F.expr("price + shipping_charges"))
    return items

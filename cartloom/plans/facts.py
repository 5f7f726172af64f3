"""Facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartloom.functions import exact_sum, missing_to_null
from cartloom.operators import agg_dropna, hot_keys, salted_join, with_row_salt
from cartloom.operators.skew import ROW_SALT


def build_payment_summary(payments: DataFrame) -> DataFrame:
    """Payments per order: value, distinct types, installments and flags.

    Types are counted in two steps (per order and type, then per order), so no task gathers
    the types of an order with very many payments.
    """
    installments = f"max({missing_to_null('payment_installments')})"
    return agg_dropna(
        payments,
        ["order_id"],
        exact_sum("payment_value").alias("total_payment_value"),
        F.expr("count(distinct payment_type) as payment_methods_count"),
        F.expr(f"{installments} as max_installments"),
        F.expr("coalesce(bool_or(payment_type = 'voucher'), false) as has_voucher"),
        F.expr("coalesce(bool_or(payment_type = 'credit_card'), false) as has_credit_card"),
        F.expr(f"coalesce({installments} > 1, false) as is_installment"),
    )


def build_fact_orders(
    orders: DataFrame, order_items: DataFrame, payments: DataFrame
) -> DataFrame:
    """One row per order with its item and payment totals.

    Items and payments are reduced to one row per order before the joins, so the joins neither
    multiply rows nor meet a skewed key.
    """
    item_totals = agg_dropna(
        order_items,
        ["order_id"],
        exact_sum("price").alias("total_item_revenue"),
        exact_sum("shipping_charges").alias("total_shipping_cost"),
        F.expr("count(product_id) as item_count"),
    )
    joined = orders.join(item_totals, "order_id", "left").join(
        build_payment_summary(payments), "order_id", "left"
    )
    revenue = "coalesce(total_item_revenue, 0D)"
    shipping = "coalesce(total_shipping_cost, 0D)"
    paid = "coalesce(total_payment_value, 0D)"
    return joined.selectExpr(
        *[f"`{c}`" for c in orders.columns],
        f"{revenue} as total_item_revenue",
        f"{shipping} as total_shipping_cost",
        "coalesce(item_count, 0L) as item_count",
        f"{paid} as total_payment_value",
        "coalesce(payment_methods_count, 0L) as payment_methods_count",
        "max_installments",
        "coalesce(has_voucher, false) as has_voucher",
        "coalesce(has_credit_card, false) as has_credit_card",
        "coalesce(is_installment, false) as is_installment",
        f"{revenue} + {shipping} as total_order_value",
        f"{paid} - ({revenue} + {shipping}) as payment_diff",
    )


def build_fact_order_items(
    order_items: DataFrame,
    orders: DataFrame,
    products: DataFrame,
    hot: dict[str, dict | list] | None = None,
) -> DataFrame:
    """One row per item of a known order, with order context and product category.

    The items are the large side of both joins, and one order or product may own much of them.
    Such keys are found by a sketch of the key columns (or given as ``hot``) and spread over tasks.
    """
    has_category = "product_category_name" in products.columns
    keys = ["order_id", "product_id"] if has_category else ["order_id"]
    if hot is None:
        hot = hot_keys(order_items, keys)
    items = with_row_salt(order_items) if any(hot.values()) else order_items
    context = orders.select(
        "order_id", "customer_id", "order_status", "order_purchase_timestamp", "order_date"
    )
    fact = salted_join(items, context, "order_id", "inner", hot.get("order_id"))
    if has_category:
        categories = products.select("product_id", "product_category_name")
        fact = salted_join(fact, categories, "product_id", "left", hot.get("product_id"))
    # The items' own columns first, as they were.
    base = order_items.columns
    return fact.select(*base, *[c for c in fact.columns if c not in [*base, ROW_SALT]])


def build_fact_payments(payments: DataFrame) -> DataFrame:
    """One row per valid payment: the staged table as it is."""
    return payments

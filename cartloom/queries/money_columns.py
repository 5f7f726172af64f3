"""Sums of money in registered queries: compared to six places, as engines add in their own order."""

from __future__ import annotations

_ORDERS = ("total_item_revenue", "total_shipping_cost", "total_order_value", "total_payment_value", "payment_diff")

MONEY_COLUMNS: dict[str, tuple[str, ...]] = {
    "payment_summary": ("total_payment_value",),
    "fact_orders": _ORDERS,
    "csv_roundtrip": _ORDERS,
    "fact_orders_no_payments": _ORDERS,
    "marts_no_items": ("revenue",),
    "mart_revenue_by_day": ("revenue",),
    "mart_revenue_by_month": ("revenue",),
    "mart_revenue_by_category": ("revenue",),
    "mart_payment_method_summary": ("total_value",),
    "mart_top_products": ("revenue",),
    "mart_customer_geo": ("revenue",),
    "top_products_k": ("revenue",),
    "profile_delivered_totals": ("total_order_value", "total_payment_value"),
    "snapshot_rerun": ("total_value",),
    "publish_replace": ("total_value",),
}

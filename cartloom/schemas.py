"""Column contracts of the raw tables and of the published facts."""

from __future__ import annotations

# Only the columns the builders name. Any other column passes through as a string.
RAW_CONTRACTS: dict[str, dict[str, str]] = {
    "orders": {
        "order_id": "string",
        "customer_id": "string",
        "order_status": "string",
        "order_purchase_timestamp": "string",
        "order_approved_at": "string",
        "order_delivered_timestamp": "string",
        "order_estimated_delivery_date": "string",
    },
    "order_items": {
        "order_id": "string",
        "product_id": "string",
        "price": "double",
        "shipping_charges": "double",
    },
    "customers": {
        "customer_id": "string",
        "customer_city": "string",
        "customer_state": "string",
    },
    "products": {
        "product_id": "string",
        "product_category_name": "string",
        "product_weight_g": "double",
        "product_length_cm": "double",
        "product_height_cm": "double",
        "product_width_cm": "double",
    },
    "payments": {
        "order_id": "string",
        "payment_type": "string",
        "payment_installments": "double",
        "payment_value": "double",
    },
}

# Raw tables whose cleaning keeps the first row per key, so their file order must be known.
KEYED_TABLES = {"orders": "order_id", "customers": "customer_id", "products": "product_id"}

# Texts that a CSV reader of the dataframe kind takes as missing.
NA_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)

# Column names of timestamps, measures and marts.
ORDER_TIMESTAMPS = (
    "order_purchase_timestamp",
    "order_approved_at",
    "order_delivered_timestamp",
    "order_estimated_delivery_date",
)

PRODUCT_MEASURES = (
    "product_weight_g",
    "product_length_cm",
    "product_height_cm",
    "product_width_cm",
)

# Columns the published facts must have.
REQUIRED_FACT_COLUMNS = {
    "fact_orders": (
        "order_id",
        "customer_id",
        "order_status",
        "order_purchase_timestamp",
        "order_date",
        "total_item_revenue",
        "total_shipping_cost",
        "total_order_value",
        "total_payment_value",
        "payment_diff",
        "item_count",
    ),
    "fact_order_items": (
        "order_id",
        "product_id",
        "customer_id",
        "order_status",
        "order_purchase_timestamp",
        "order_date",
        "price",
        "shipping_charges",
        "item_total",
        "product_category_name",
    ),
    "fact_payments": (
        "order_id",
        "payment_type",
        "payment_installments",
        "payment_value",
        "is_installment",
    ),
}

MART_TABLES = (
    "mart_revenue_by_day",
    "mart_revenue_by_month",
    "mart_revenue_by_category",
    "mart_payment_method_summary",
    "mart_order_status_daily",
    "mart_top_products",
    "mart_customer_geo",
)

# Tables that are published in an order; every written copy is sorted anew.
PUBLISHED_ORDER = {"mart_top_products": ["revenue desc", "product_id asc"]}

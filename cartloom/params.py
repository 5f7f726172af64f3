"""Job parameters: paths, run date, business rules and write switches."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field, replace

# The order statuses the staging rules accept.
VALID_ORDER_STATUSES = (
    "delivered",
    "shipped",
    "canceled",
    "processing",
    "invoiced",
    "unavailable",
    "approved",
    "created",
)

# Where each raw table lies below the raw folder.
RAW_FILES = {
    "orders": "orders/orders.csv",
    "order_items": "order_items/order_items.csv",
    "customers": "customers/customers.csv",
    "payments": "payments/payments.csv",
    "products": "products/products.csv",
}


@dataclass(frozen=True)
class JobParams:
    raw_base: str = "data/raw"
    staging_base: str = "data/staging/ecommerce"
    warehouse_base: str = "data/warehouse/ecommerce"
    run_date: str = "auto"
    raw_files: dict[str, str] = field(default_factory=lambda: dict(RAW_FILES))
    revenue_status: str = "delivered"
    valid_order_statuses: tuple[str, ...] = VALID_ORDER_STATUSES
    timestamp_format: str | None = None
    csv_multi_line: bool = False
    median_method: str = "exact"
    write_partitioned: bool = True
    write_latest: bool = True
    publish_enabled: bool = False
    publish_database: str = ""
    publish_format: str | None = None
    publish_options: dict[str, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        # "auto" is fixed once, so a run that passes midnight keeps one date.
        if self.run_date == "auto":
            object.__setattr__(self, "run_date", dt.date.today().isoformat())
        else:
            dt.date.fromisoformat(self.run_date)

    def raw_path(self, table: str) -> str:
        if table not in self.raw_files:
            raise KeyError(f"Unknown raw table '{table}'")
        return f"{self.raw_base.rstrip('/')}/{self.raw_files[table]}"

    def with_(self, **changes) -> JobParams:
        return replace(self, **changes)

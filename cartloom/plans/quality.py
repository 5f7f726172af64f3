"""Data-quality rules.

A table's rules run as one aggregate over that table and give one row per rule:
(layer, table, rule, column, violations). Rows with violations above zero fail the layer.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartloom.params import JobParams
from cartloom.schemas import MART_TABLES, REQUIRED_FACT_COLUMNS

SHOWN_VALUES = 20


class DataQualityError(ValueError):
    """A layer broke at least one rule. ``details`` has the whole frames behind the message."""

    def __init__(self, message: str, details: dict[str, DataFrame] | None = None):
        super().__init__(message)
        self.details = details or {}


@dataclass(frozen=True)
class Rule:
    name: str
    column: str
    count: str


def not_null(column: str) -> Rule:
    return Rule("not_null", column, f"count_if(`{column}` is null)")


def non_negative(column: str) -> Rule:
    return Rule("non_negative", column, f"count_if(`{column}` < 0)")


def unique(*columns: str) -> Rule:
    """Rows beyond the first per key; null keys count as equal."""
    if len(columns) == 1:
        # On the bare column, the count can use a partitioning by that key.
        key = f"`{columns[0]}`"
        keys = f"count(distinct {key}) - coalesce(max(if({key} is null, 1, 0)), 0)"
    else:
        # A struct is never null itself.
        keys = f"count(distinct struct({', '.join(f'`{c}`' for c in columns)}))"
    return Rule("unique", ",".join(columns), f"count(1) - {keys}")


def allowed_values(column: str, allowed: tuple[str, ...]) -> Rule:
    """Null is not allowed, and an empty list allows nothing."""
    return Rule("allowed_values", column, f"count_if({_not_allowed(column, allowed)})")


def not_empty() -> Rule:
    return Rule("not_empty", "*", "if(count(1) = 0, 1, 0)")


def _not_allowed(column: str, allowed: tuple[str, ...]) -> str:
    if not allowed:
        return "true"
    quoted = (v.replace("\\", "\\\\").replace("'", "\\'") for v in allowed)
    values = ", ".join(f"'{v}'" for v in quoted)
    return f"not coalesce(`{column}` in ({values}), false)"


def invalid_values(df: DataFrame, column: str, allowed: tuple[str, ...]) -> DataFrame:
    """Every value that is not allowed, null included, with its number of rows."""
    bad = df.filter(_not_allowed(column, allowed))
    return bad.groupBy(column).agg(F.expr("count(1) as rows"))


def check_table(df: DataFrame, layer: str, table: str, rules: list[Rule]) -> DataFrame:
    counted = df.agg(
        *[F.expr(f"cast({r.count} as bigint) as r{i}") for i, r in enumerate(rules)]
    )
    rows = ", ".join(
        f"struct('{layer}' as layer, '{table}' as `table`, '{r.name}' as rule,"
        f" '{r.column}' as `column`, r{i} as violations)"
        for i, r in enumerate(rules)
    )
    return counted.selectExpr(f"inline(array({rows}))")


def check_not_empty(df: DataFrame, layer: str, table: str) -> DataFrame:
    """Looks for a single row instead of counting the table."""
    return check_table(df.selectExpr("1").limit(1), layer, table, [not_empty()])


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def staging_rules(valid_statuses: tuple[str, ...]) -> dict[str, list[Rule]]:
    return {
        "orders": [
            not_null("order_id"),
            unique("order_id"),
            not_null("customer_id"),
            allowed_values("order_status", valid_statuses),
        ],
        "customers": [not_null("customer_id"), unique("customer_id")],
        "products": [not_null("product_id"), unique("product_id")],
        "payments": [not_null("order_id"), non_negative("payment_value")],
        "order_items": [
            not_null("order_id"),
            not_null("product_id"),
            non_negative("price"),
            non_negative("shipping_charges"),
        ],
    }


def warehouse_rules() -> dict[str, list[Rule]]:
    return {
        "fact_orders": [
            not_null("order_id"),
            unique("order_id"),
            not_null("customer_id"),
            non_negative("total_order_value"),
        ],
        "fact_order_items": [
            not_null("order_id"),
            not_null("product_id"),
            non_negative("item_total"),
        ],
        "fact_payments": [not_null("order_id"), non_negative("payment_value")],
        "dim_customers": [not_null("customer_id"), unique("customer_id")],
        "dim_products": [not_null("product_id"), unique("product_id")],
    }


def validate_staging(tables: dict[str, DataFrame], params: JobParams) -> DataFrame:
    rules = staging_rules(params.valid_order_statuses)
    return _union([check_table(tables[t], "staging", t, r) for t, r in rules.items()])


def validate_warehouse(
    warehouse: dict[str, DataFrame], marts: dict[str, DataFrame]
) -> DataFrame:
    """Facts, the two keyed dimensions, and at least one row in every mart."""
    checks = [
        check_table(warehouse[t], "warehouse", t, r) for t, r in warehouse_rules().items()
    ]
    checks += [check_not_empty(df, "mart", t) for t, df in marts.items()]
    return _union(checks)


def enforce(violations: DataFrame, details: dict[str, DataFrame] | None = None) -> None:
    """Raise if any rule is broken. ``details`` maps "table.column" to frames worth quoting."""
    broken = violations.filter(F.col("violations") > 0).collect()  # at most one row per rule
    if not broken:
        return
    messages, quoted = [], {}
    for row in broken:
        place = f"{row.table}.{row.column}"
        message = f"{row.layer} {place}: {row.violations} violations of {row.rule}"
        if row.rule == "allowed_values" and details and place in details:
            values = details[place]
            shown, every = [r[0] for r in values.limit(SHOWN_VALUES).collect()], values.count()
            quoted[place] = values
            message += f", such as {shown}" + (f" and {every - len(shown)} more values" if every > len(shown) else "")
        messages.append(message)
    raise DataQualityError("; ".join(messages), quoted)


def missing_columns(df: DataFrame, columns: tuple[str, ...]) -> list[str]:
    return [c for c in columns if c not in df.columns]


def require_columns(table: str, df: DataFrame, columns: tuple[str, ...]) -> None:
    missing = missing_columns(df, columns)
    if missing:
        raise DataQualityError(f"{table} is missing required columns: {missing}")


def output_rules(table: str, df: DataFrame) -> list[Rule]:
    """Rules for a published table; rules on columns that are absent are left out."""
    if table in MART_TABLES:
        amounts = [c for c in df.columns if "revenue" in c.lower() or c.lower() == "total_value"]
        return [non_negative(c) for c in amounts]
    present = {
        "fact_orders": (["order_id"], ["order_id"], []),
        "fact_order_items": (["order_id", "product_id"], [], []),
        "fact_payments": (["order_id"], [], ["payment_value"]),
        "dim_customers": (["customer_id"], ["customer_id"], []),
        "dim_products": (["product_id", "product_category_name"], ["product_id"], []),
        "dim_date": ([], ["date_id" if "date_id" in df.columns else "date"], []),
    }
    filled, key, positive = present[table]
    rules = [not_null(c) for c in filled if c in df.columns]
    if key and not missing_columns(df, tuple(key)):
        rules.append(unique(*key))
    return rules + [non_negative(c) for c in positive if c in df.columns]


def check_output(tables: dict[str, DataFrame]) -> DataFrame:
    """Violations over published tables. Missing required columns are an error at once."""
    for table, columns in REQUIRED_FACT_COLUMNS.items():
        if table in tables:
            require_columns(table, tables[table], columns)
    checks = []
    for table, df in tables.items():
        if table in MART_TABLES:
            checks.append(check_not_empty(df, "output", table))
        rules = output_rules(table, df)
        if rules:
            checks.append(check_table(df, "output", table, rules))
    return _union(checks)

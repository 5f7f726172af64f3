"""The batch job, raw to marts, and the check of its published output."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from cartloom.operators import top_values
from cartloom.params import JobParams
from cartloom.plans import dims, facts, marts, profile, quality, staging
from cartloom.schemas import MART_TABLES
from cartloom.sinks import Attempt, publish, run_together, save_parquet
from cartloom.sources import extract_all, read_latest


@dataclass(frozen=True)
class JobResult:
    metrics: DataFrame
    published: list[str]


@dataclass(frozen=True)
class OutputReport:
    """Violations and profiles; profiles are named "<table>.<part>"."""

    violations: DataFrame
    profiles: dict[str, DataFrame]


@dataclass(frozen=True)
class OutputView:
    """What to profile in a published table."""

    keys: tuple[str, ...] = ()
    numbers: tuple[str, ...] = ()
    frequency: str | None = None
    top: int | None = None


# The columns that the published tables are profiled by.
OUTPUT_VIEWS = {
    "fact_orders": OutputView(
        keys=("order_id",),
        numbers=(
            "total_item_revenue",
            "total_shipping_cost",
            "total_order_value",
            "total_payment_value",
            "payment_diff",
            "item_count",
        ),
        frequency="order_status",
    ),
    "fact_order_items": OutputView(
        numbers=("price", "shipping_charges", "item_total"),
        frequency="product_category_name",
        top=10,
    ),
    "fact_payments": OutputView(numbers=("payment_value",), frequency="payment_type"),
    "dim_customers": OutputView(keys=("customer_id",), frequency="customer_state", top=10),
    "dim_products": OutputView(keys=("product_id",), frequency="product_category_name", top=10),
    "dim_date": OutputView(),
    **{mart: OutputView() for mart in MART_TABLES},
}


def build_staging(raw: dict[str, DataFrame], params: JobParams) -> dict[str, DataFrame]:
    return {
        "orders": staging.clean_orders(raw["orders"], params.timestamp_format),
        "customers": staging.clean_customers(raw["customers"]),
        "products": staging.clean_products(raw["products"], params.median_method),
        "payments": staging.clean_payments(raw["payments"]),
        "order_items": staging.clean_order_items(raw["order_items"]),
    }


def build_warehouse(staged: dict[str, DataFrame]) -> dict[str, DataFrame]:
    orders, items = staged["orders"], staged["order_items"]
    return {
        "dim_customers": dims.build_dim_customers(staged["customers"], unique=True),
        "dim_products": dims.build_dim_products(staged["products"], unique=True),
        "dim_date": dims.build_dim_date(orders),
        "fact_payments": facts.build_fact_payments(staged["payments"]),
        "fact_order_items": facts.build_fact_order_items(items, orders, staged["products"]),
        "fact_orders": facts.build_fact_orders(orders, items, staged["payments"]),
    }


def build_marts(warehouse: dict[str, DataFrame], params: JobParams) -> dict[str, DataFrame]:
    orders, items = warehouse["fact_orders"], warehouse["fact_order_items"]
    status = params.revenue_status
    return {
        "mart_revenue_by_day": marts.build_mart_revenue_by_day(orders, status),
        "mart_revenue_by_month": marts.build_mart_revenue_by_month(orders, status),
        "mart_revenue_by_category": marts.build_mart_revenue_by_category(items, status),
        "mart_payment_method_summary": marts.build_mart_payment_method_summary(
            warehouse["fact_payments"]
        ),
        "mart_order_status_daily": marts.build_mart_order_status_daily(orders),
        "mart_top_products": marts.build_mart_top_products(items, status),
        "mart_customer_geo": marts.build_mart_customer_geo(
            orders, warehouse["dim_customers"], status
        ),
    }


# Rows that cleaning drops for their content, counted apart by reason.
DROPPED = {
    "payments": {
        "dropped_negative": "payment_value < 0",
        "dropped_missing": "payment_value is null or isnan(payment_value)",
    }
}


def counted(
    spark: SparkSession, tables: dict[str, DataFrame], step: str, extra: dict[str, dict[str, str]] | None = None
) -> list[tuple[str, str, int]]:
    """Rows per table, and those that meet the extra conditions, as results of queries.

    A query's result holds every row once, whatever tasks ran again; a count kept in accumulators
    need not. Rows of Parquet files come from their footers.
    """

    def count(table: str, df: DataFrame) -> list[tuple[str, str, int]]:
        conditions = {step: "true", **(extra or {}).get(table, {})}
        measures = ["count(1)"] + [f"count_if({c})" for c in list(conditions.values())[1:]]
        row = df.selectExpr(*[f"{m} as `{name}`" for m, name in zip(measures, conditions, strict=True)]).first()
        return [(table, name, row[name]) for name in conditions]

    return [one for rows in run_together(spark, [lambda t=t, d=d: count(t, d) for t, d in tables.items()]) for one in rows]


def materialise(spark: SparkSession, tables: dict[str, DataFrame], folder: str) -> dict[str, DataFrame]:
    """Write the tables to a shared folder and read them back.

    Rules and later layers then start from files: nothing is computed twice, and losing
    executors costs no more than the stage they were in.
    """
    run_together(
        spark,
        [lambda d=df, n=name: save_parquet(d, f"{folder}/{n}") for name, df in tables.items()],
    )
    return {
        name: spark.read.schema(df.schema).parquet(f"{folder}/{name}")
        for name, df in tables.items()
    }


# Warehouse tables that are staged tables as they are: their rows are no step of their own.
AS_STAGED = ("dim_customers", "dim_products", "fact_payments")


def run(
    spark: SparkSession, params: JobParams, raw: dict[str, DataFrame] | None = None
) -> JobResult:
    """Run the whole job. Each layer is written once, checked there, and put in place only after all its rules held."""
    raw = extract_all(spark, params) if raw is None else raw
    staging_attempt, warehouse_attempt = Attempt(spark, params.staging_base, params), Attempt(spark, params.warehouse_base, params)
    keeps = params.write_partitioned or params.write_latest
    try:
        rows = counted(spark, raw, "read", DROPPED)
        staged = staging_attempt.write(build_staging(raw, params))
        statuses = quality.invalid_values(
            staged["orders"], "order_status", params.valid_order_statuses
        )
        quality.enforce(
            quality.validate_staging(staged, params), {"orders.order_status": statuses}
        )
        staged = staging_attempt.publish()
        rows += counted(spark, staged, "built")

        warehouse = warehouse_attempt.write(build_warehouse(staged))
        mart_tables = warehouse_attempt.write(build_marts(warehouse, params))
        quality.enforce(quality.validate_warehouse(warehouse, mart_tables))
        ready = warehouse_attempt.publish()
        rows += counted(spark, {t: df for t, df in ready.items() if t not in AS_STAGED}, "built")
        if keeps:
            rows += counted(spark, {**staged, **ready}, "written")
        published = publish(ready, params)
        return JobResult(spark.createDataFrame(rows, "table string, step string, rows bigint"), published)
    finally:
        staging_attempt.drop()
        warehouse_attempt.drop()


def profile_table(table: str, df: DataFrame, params: JobParams) -> dict[str, DataFrame]:
    """The profiles of one published table, by part."""
    view = OUTPUT_VIEWS[table]
    keys = list(view.keys)
    if table == "dim_date":
        keys = ["date_id" if "date_id" in df.columns else "date"]
    profiles = profile.table_overview(table, df, keys)
    if view.numbers:
        profiles["describe"] = profile.describe(df, list(view.numbers))
    if view.frequency in df.columns:
        profiles[view.frequency] = top_values(df, view.frequency, view.top)
    if table == "fact_orders":
        profiles["revenue_totals"] = profile.revenue_totals(df, params.revenue_status)
    if table == "dim_date" and "date" in df.columns:
        profiles["range"] = profile.date_range(df)
    return profiles


def profile_published(
    spark: SparkSession, params: JobParams, only: tuple[str, ...] = tuple(OUTPUT_VIEWS)
) -> DataFrame:
    """All profiles of the published tables in one frame; the tables are scanned side by side."""

    def one(table: str) -> DataFrame:
        df, view = read_latest(spark, params.warehouse_base, table), OUTPUT_VIEWS[table]
        keys = view.keys or (("date_id" if "date_id" in df.columns else "date",) if table == "dim_date" else ())
        sold = table == "fact_orders"
        return profile.profile_rows(
            table,
            df,
            keys,
            view.numbers,
            view.frequency,
            view.top,
            ("total_order_value", "total_payment_value") if sold else (),
            f"order_status = '{params.revenue_status}'" if sold else "true",
            "date" if table == "dim_date" else None,
        )

    return reduce(DataFrame.unionByName, run_together(spark, [lambda t=table: one(t) for table in only]))


def check_published(
    spark: SparkSession, params: JobParams, only: tuple[str, ...] = tuple(OUTPUT_VIEWS)
) -> OutputReport:
    """Rules and profiles over the latest copies; raises if a rule is broken."""
    tables = {table: read_latest(spark, params.warehouse_base, table) for table in only}
    violations = quality.check_output(tables)
    quality.enforce(violations)
    profiles = {
        f"{table}.{part}": frame
        for table, df in tables.items()
        for part, frame in profile_table(table, df, params).items()
    }
    return OutputReport(violations, profiles)

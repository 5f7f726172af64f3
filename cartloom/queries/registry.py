"""One query per table, operator group and sink, over the whole benchmark tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartloom.functions import exact_sum
from cartloom.operators import (
    INGEST_ORDER,
    agg_dropna,
    dedupe_first,
    exact_quantiles,
    impute_median,
    ingest_numbers,
    row_numbers,
    top_values,
)
from cartloom.operators.skew import salted_join, with_row_salt
from cartloom.params import JobParams
from cartloom.plans import dims, facts, job, marts, profile, quality, staging
from cartloom.queries.money_columns import MONEY_COLUMNS
from cartloom.schemas import REQUIRED_FACT_COLUMNS
from cartloom.sinks import drop_scratch, latest_path, load_warehouse, publish, scratch_folder, snapshot_path
from cartloom.sources import extract_all, raw_from_benchmark, read_csv_table
from cartloom.sources.benchmark_tables import RAW_SQL, read_benchmark

PARAMS = JobParams(run_date="2024-01-02")

Query = Callable[[SparkSession, str], DataFrame]


def _raw(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return raw_from_benchmark(spark, folder, (table,))[table]


# Staging


def stg_orders(spark: SparkSession, folder: str) -> DataFrame:
    return staging.clean_orders(_raw(spark, folder, "orders"))


def stg_customers(spark: SparkSession, folder: str) -> DataFrame:
    return staging.clean_customers(_raw(spark, folder, "customers"))


def stg_products(spark: SparkSession, folder: str) -> DataFrame:
    return staging.clean_products(_raw(spark, folder, "products"))


def stg_payments(spark: SparkSession, folder: str) -> DataFrame:
    return staging.clean_payments(_raw(spark, folder, "payments"))


def stg_order_items(spark: SparkSession, folder: str) -> DataFrame:
    return staging.clean_order_items(_raw(spark, folder, "order_items"))


def dedupe_first_orders(spark: SparkSession, folder: str) -> DataFrame:
    orders = read_benchmark(spark, folder, "orders")
    return dedupe_first(orders, "o_custkey", order_by="o_orderkey")


def median_impute(spark: SparkSession, folder: str) -> DataFrame:
    orders = read_benchmark(spark, folder, "orders")
    gap = F.col("o_orderkey") % 5 == 0
    gaps = orders.select(
        F.col("o_orderkey").alias("order_id"),
        F.when(~gap, F.col("o_totalprice")).alias("total_price"),
        F.when(gap, F.col("o_custkey").cast("double")).alias("customer_number"),
    )
    return impute_median(gaps, ["total_price", "customer_number"])


def quantiles_exact(spark: SparkSession, folder: str) -> DataFrame:
    items = read_benchmark(spark, folder, "lineitem")
    measures = ["l_quantity", "l_extendedprice", "l_discount"]
    quantiles = exact_quantiles(items, measures, [0.0, 0.1, 0.25, 0.5, 0.9, 1.0])
    return quantiles.withColumn("quantile", F.round("quantile", 6))


# Warehouse


def _with_late_copies(df: DataFrame, changed: str) -> DataFrame:
    """The table with a second, differing copy of every row that a keep-first step has to drop."""
    first = df.withColumn(INGEST_ORDER, F.lit(0))
    late = df.withColumns({changed: F.lit("late copy"), INGEST_ORDER: F.lit(1)})
    return late.unionByName(first)


def dim_customers(spark: SparkSession, folder: str) -> DataFrame:
    return dims.build_dim_customers(_with_late_copies(stg_customers(spark, folder), "customer_city"))


def dim_products(spark: SparkSession, folder: str) -> DataFrame:
    return dims.build_dim_products(_with_late_copies(stg_products(spark, folder), "product_category_name"))


def fact_order_items_salted(spark: SparkSession, folder: str) -> DataFrame:
    """The item facts over the salted join: a third of the items get one product, spread as a hot key."""
    items = with_row_salt(_raw(spark, folder, "order_items"))
    skewed = staging.clean_order_items(items.withColumn("product_id", F.expr("if(order_id % 3 = 0, 7, product_id)")))
    joined = salted_join(skewed, stg_products(spark, folder), "product_id", "left", hot=["7", None])
    return joined.select("order_id", "product_id", "price", "product_category_name")


def dim_date(spark: SparkSession, folder: str) -> DataFrame:
    return dims.build_dim_date(stg_orders(spark, folder))


def payment_summary(spark: SparkSession, folder: str) -> DataFrame:
    return facts.build_payment_summary(stg_payments(spark, folder))


def fact_orders(spark: SparkSession, folder: str) -> DataFrame:
    return facts.build_fact_orders(
        stg_orders(spark, folder), stg_order_items(spark, folder), stg_payments(spark, folder)
    )


def fact_order_items(spark: SparkSession, folder: str) -> DataFrame:
    return facts.build_fact_order_items(
        stg_order_items(spark, folder), stg_orders(spark, folder), stg_products(spark, folder)
    )


def fact_payments(spark: SparkSession, folder: str) -> DataFrame:
    return facts.build_fact_payments(stg_payments(spark, folder))


# Marts


def mart_revenue_by_day(spark: SparkSession, folder: str) -> DataFrame:
    return marts.build_mart_revenue_by_day(fact_orders(spark, folder))


def mart_revenue_by_month(spark: SparkSession, folder: str) -> DataFrame:
    return marts.build_mart_revenue_by_month(fact_orders(spark, folder))


def mart_revenue_by_category(spark: SparkSession, folder: str) -> DataFrame:
    return marts.build_mart_revenue_by_category(fact_order_items(spark, folder))


def mart_payment_method_summary(spark: SparkSession, folder: str) -> DataFrame:
    return marts.build_mart_payment_method_summary(fact_payments(spark, folder))


def mart_order_status_daily(spark: SparkSession, folder: str) -> DataFrame:
    return marts.build_mart_order_status_daily(fact_orders(spark, folder))


def mart_top_products(spark: SparkSession, folder: str) -> DataFrame:
    return marts.build_mart_top_products(fact_order_items(spark, folder))


def mart_customer_geo(spark: SparkSession, folder: str) -> DataFrame:
    return marts.build_mart_customer_geo(
        fact_orders(spark, folder), dim_customers(spark, folder)
    )


def top_products_k(spark: SparkSession, folder: str) -> DataFrame:
    return marts.build_mart_top_products(fact_order_items(spark, folder), limit=25)


# Data quality


def _staged(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return job.build_staging(raw_from_benchmark(spark, folder), PARAMS)


def dq_staging(spark: SparkSession, folder: str) -> DataFrame:
    return quality.validate_staging(_staged(spark, folder), PARAMS)


def dq_raw(spark: SparkSession, folder: str) -> DataFrame:
    """The staging rules on the uncleaned tables, with a shorter list of statuses."""
    raw = raw_from_benchmark(spark, folder)
    return quality.validate_staging(raw, PARAMS.with_(valid_order_statuses=("delivered",)))


def dq_invalid_values(spark: SparkSession, folder: str) -> DataFrame:
    return quality.invalid_values(_raw(spark, folder, "orders"), "order_status", ("delivered",))


def dq_warehouse(spark: SparkSession, folder: str) -> DataFrame:
    """The warehouse and mart rules over facts that are written once, as in the job."""
    work = scratch_folder(spark, "warehouse")
    staged = job.materialise(spark, _staged(spark, folder), f"{work}/staging")
    warehouse = job.materialise(spark, job.build_warehouse(staged), f"{work}/warehouse")
    found = quality.validate_warehouse(warehouse, job.build_marts(warehouse, PARAMS))
    return _kept(spark, found, work)


def _kept(spark: SparkSession, small: DataFrame, work: str) -> DataFrame:
    """A frame of one row per rule or snapshot, kept while its working folder is dropped."""
    result = spark.createDataFrame(small.collect(), small.schema)
    drop_scratch(spark, work)
    return result


def dq_unique_composite(spark: SparkSession, folder: str) -> DataFrame:
    items = read_benchmark(spark, folder, "lineitem")
    rules = [quality.unique("l_orderkey", "l_partkey")]
    shipped = read_benchmark(spark, folder, "events")
    return quality.check_table(items, "benchmark", "lineitem", rules).unionByName(
        quality.check_table(
            shipped, "benchmark", "events", [quality.unique("user_id", "event_type")]
        )
    )


def dq_required_columns(spark: SparkSession, folder: str) -> DataFrame:
    """Columns that raw tables lack to be published facts, beside their rows."""
    raw = raw_from_benchmark(spark, folder)
    pairs = {"fact_orders": "orders", "fact_order_items": "order_items", "fact_payments": "payments"}
    frames = []
    for fact, table in pairs.items():
        missing = quality.missing_columns(raw[table], REQUIRED_FACT_COLUMNS[fact])
        frames.append(
            raw[table]
            .agg(F.expr("count(1) as rows"))
            .select(
                F.lit(fact).alias("table"), "rows", F.lit(",".join(missing)).alias("missing")
            )
        )
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


# Profiles


def profile_shape(spark: SparkSession, folder: str) -> DataFrame:
    raw = raw_from_benchmark(spark, folder)
    return profile.table_shape({table: df.drop(INGEST_ORDER) for table, df in raw.items()})


def profile_nulls(spark: SparkSession, folder: str) -> DataFrame:
    return profile.null_counts(fact_orders(spark, folder))


def profile_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return profile.duplicate_count(stg_payments(spark, folder), ["order_id", "payment_type"])


def _rounded(described: DataFrame) -> DataFrame:
    measures = ("mean", "std", "min", "q25", "q50", "q75", "max")
    return described.withColumns({c: F.round(c, 6) for c in measures})


def profile_numeric(spark: SparkSession, folder: str) -> DataFrame:
    columns = [
        "total_item_revenue",
        "total_shipping_cost",
        "total_order_value",
        "total_payment_value",
        "payment_diff",
        "item_count",
    ]
    return _rounded(profile.describe(fact_orders(spark, folder), columns))


def profile_numeric_items(spark: SparkSession, folder: str) -> DataFrame:
    columns = ["price", "shipping_charges", "item_total"]
    return _rounded(profile.describe(stg_order_items(spark, folder), columns))


def profile_numeric_payments(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(profile.describe(fact_payments(spark, folder), ["payment_value"]))


def profile_frequency(spark: SparkSession, folder: str) -> DataFrame:
    return top_values(stg_orders(spark, folder), "order_status")


def profile_frequency_payments(spark: SparkSession, folder: str) -> DataFrame:
    return top_values(fact_payments(spark, folder), "payment_type")


def profile_top10(spark: SparkSession, folder: str) -> DataFrame:
    return top_values(fact_order_items(spark, folder), "product_category_name", 10)


def profile_top10_states(spark: SparkSession, folder: str) -> DataFrame:
    return top_values(dim_customers(spark, folder), "customer_state", 10)


def profile_delivered_totals(spark: SparkSession, folder: str) -> DataFrame:
    return profile.revenue_totals(fact_orders(spark, folder))


def profile_date_range(spark: SparkSession, folder: str) -> DataFrame:
    return profile.date_range(dim_date(spark, folder))


# Sources, sinks and the whole job


def csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """All raw tables written as CSV and read under their contracts, up to fact_orders."""
    base = scratch_folder(spark, "csv")
    for table, df in raw_from_benchmark(spark, folder).items():
        (
            df.drop(INGEST_ORDER)
            .write.option("header", True)
            .option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False)
            .csv(f"{base}/{table}")
        )
    params = PARAMS.with_(raw_base=base, raw_files={t: t for t in RAW_SQL})
    staged = job.build_staging(extract_all(spark, params), params)
    return facts.build_fact_orders(staged["orders"], staged["order_items"], staged["payments"])


def snapshot_rerun(spark: SparkSession, folder: str) -> DataFrame:
    """Two runs for one date and one for the next: rows and value per snapshot and latest."""
    base = scratch_folder(spark, "snapshots")
    table = {"fact_payments": fact_payments(spark, folder)}
    for run_date in ("2024-01-01", "2024-01-01", "2024-01-02"):
        load_warehouse(table, {}, PARAMS.with_(warehouse_base=base, run_date=run_date))
    dated = spark.read.parquet(snapshot_path(base, "fact_payments"))
    latest = spark.read.parquet(latest_path(base, "fact_payments"))
    every = dated.withColumn("dt", F.col("dt").cast("string")).unionByName(
        latest.withColumn("dt", F.lit("latest"))
    )
    sums = agg_dropna(
        every, ["dt"], F.expr("count(1) as rows"), exact_sum("payment_value").alias("total_value")
    )
    return _kept(spark, sums, base)


def publish_replace(spark: SparkSession, folder: str) -> DataFrame:
    """The payment mart published twice into a database: the second run replaces the first."""
    base = scratch_folder(spark, "publish")
    database = "cartloom_published"
    spark.sql(f"create database if not exists {database} location '{base}'")
    params = PARAMS.with_(
        publish_enabled=True,
        publish_database=database,
        publish_options={"path": f"{base}/{{table}}"},
    )
    mart = {"mart_payment_method_summary": mart_payment_method_summary(spark, folder)}
    publish(mart, params)
    result = _kept(spark, spark.table(publish(mart, params)[0]), base)  # a row per payment type
    spark.sql(f"drop database {database} cascade")
    return result


def sorted_mart_latest(spark: SparkSession, folder: str) -> DataFrame:
    """The product mart as published, each row with its place in the files of ``latest``."""
    base = scratch_folder(spark, "sorted")
    mart = mart_top_products(spark, folder)
    load_warehouse({}, {"mart_top_products": mart}, PARAMS.with_(warehouse_base=base))
    rows = spark.read.parquet(latest_path(base, "mart_top_products"))
    placed = row_numbers(rows.selectExpr("*", "_metadata.file_name as file", "_metadata.row_index as row"), "file", "row", "place")
    return placed.selectExpr("product_id", "product_category_name", "quantity", "cast(place as int) as place")


def csv_first_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The first row of each order over many CSV files with differing copies, and its number in the whole input."""
    base = scratch_folder(spark, "lines")
    order = ["l_shipdate", "l_orderkey", "l_linenumber"]
    lines = read_benchmark(spark, folder, "lineitem").selectExpr(*order).repartitionByRange(16, *order).sortWithinPartitions(*order)
    lines.selectExpr("l_orderkey as order_id", "l_linenumber as line", "date_format(l_shipdate, 'yyyy-MM-dd') as shipped").write.option("header", True).csv(base)
    raw = ingest_numbers(read_csv_table(spark, base, "orders"))
    first = dedupe_first(raw, "order_id")
    return first.selectExpr("order_id", "cast(line as int) as line", "shipped", "row_number")


def _without_rows(spark: SparkSession, folder: str, table: str) -> dict[str, DataFrame]:
    raw = raw_from_benchmark(spark, folder, ("orders", "order_items", "payments"))
    raw[table] = raw[table].where("false")
    return {
        "orders": staging.clean_orders(raw["orders"]),
        "items": staging.clean_order_items(raw["order_items"]),
        "payments": staging.clean_payments(raw["payments"]),
    }


def fact_orders_no_payments(spark: SparkSession, folder: str) -> DataFrame:
    """The order facts when no payment has come in."""
    staged = _without_rows(spark, folder, "payments")
    return facts.build_fact_orders(staged["orders"], staged["items"], staged["payments"])


def marts_no_items(spark: SparkSession, folder: str) -> DataFrame:
    """Revenue by month and status by day when no item has come in, in one frame."""
    staged = _without_rows(spark, folder, "order_items")
    orders = facts.build_fact_orders(staged["orders"], staged["items"], staged["payments"])
    months = marts.build_mart_revenue_by_month(orders)
    products = facts.build_fact_order_items(staged["items"], staged["orders"], stg_products(spark, folder))
    categories = marts.build_mart_revenue_by_category(products)
    by_month = months.selectExpr("concat(order_year, '-', order_month) as period", "revenue", "orders")
    return by_month.unionByName(categories.selectExpr("product_category_name as period", "revenue", "items_sold as orders"))


def published_profiles(spark: SparkSession, folder: str) -> DataFrame:
    """All profiles of every table that the whole job published."""
    base, params, _ = _run_job(spark, folder)
    found = job.profile_published(spark, params).withColumn("value", F.round("value", 4))
    return _kept(spark, found, base)  # some rows per column


def _run_job(spark: SparkSession, folder: str) -> tuple[str, JobParams, job.JobResult]:
    base = scratch_folder(spark, "run")
    params = PARAMS.with_(staging_base=f"{base}/staging", warehouse_base=f"{base}/warehouse")
    return base, params, job.run(spark, params, raw_from_benchmark(spark, folder))


def job_row_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Rows read and built per table, counted while the whole job writes its layers."""
    base, _, result = _run_job(spark, folder)
    drop_scratch(spark, base)
    return result.metrics


def job_output_check(spark: SparkSession, folder: str) -> DataFrame:
    """Every rule over the tables the whole job published."""
    base, params, _ = _run_job(spark, folder)
    return _kept(spark, job.check_published(spark, params).violations, base)


def _to_six_places(query: Query) -> Query:
    columns = MONEY_COLUMNS.get(query.__name__, ())

    def rounded(spark: SparkSession, folder: str) -> DataFrame:
        return query(spark, folder).withColumns({c: F.round(c, 6) for c in columns})

    return rounded if columns else query


QUERIES: dict[str, Query] = {
    q.__name__: _to_six_places(q)
    for q in (
        stg_orders,
        stg_customers,
        stg_products,
        stg_payments,
        stg_order_items,
        dedupe_first_orders,
        median_impute,
        quantiles_exact,
        dim_customers,
        dim_products,
        dim_date,
        payment_summary,
        fact_orders,
        fact_order_items,
        fact_order_items_salted,
        fact_payments,
        mart_revenue_by_day,
        mart_revenue_by_month,
        mart_revenue_by_category,
        mart_payment_method_summary,
        mart_order_status_daily,
        mart_top_products,
        mart_customer_geo,
        top_products_k,
        dq_staging,
        dq_raw,
        dq_invalid_values,
        dq_warehouse,
        dq_unique_composite,
        dq_required_columns,
        profile_shape,
        profile_nulls,
        profile_duplicates,
        profile_numeric,
        profile_numeric_items,
        profile_numeric_payments,
        profile_frequency,
        profile_frequency_payments,
        profile_top10,
        profile_top10_states,
        profile_delivered_totals,
        profile_date_range,
        csv_roundtrip,
        snapshot_rerun,
        publish_replace,
        sorted_mart_latest,
        csv_first_rows,
        fact_orders_no_payments,
        marts_no_items,
        published_profiles,
        job_row_counts,
        job_output_check,
    )
}

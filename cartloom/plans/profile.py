"""Profiles of tables, as DataFrames."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartloom.functions import exact_sum
from cartloom.operators import summarise
from cartloom.plans.quality import missing_columns, unique


def table_shape(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table: rows, number of columns, column list."""
    shapes = [
        df.agg(
            F.lit(name).alias("table"),
            F.expr("count(1) as rows"),
            F.lit(len(df.columns)).alias("columns"),
            F.lit(", ".join(df.columns)).alias("column_list"),
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, shapes)


def null_counts(df: DataFrame) -> DataFrame:
    """Columns with missing values and how many; one pass over the table."""
    missing = {
        name: f"`{name}` is null or isnan(`{name}`)"
        if kind in ("double", "float")
        else f"`{name}` is null"
        for name, kind in df.dtypes
    }
    counted = df.agg(*[F.expr(f"count_if({m}) as `{c}`") for c, m in missing.items()])
    return counted.unpivot([], df.columns, "column", "nulls").filter("nulls > 0")


def duplicate_count(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows beyond the first per business key."""
    return df.agg(F.expr(unique(*keys).count).alias("duplicates"))


DESCRIBED = "column string, count bigint, mean double, std double, min double, q25 double, q50 double, q75 double, max double"


PROFILED = "table string, part string, item string, measure string, value double, text string"


def describe(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact interpolated quartiles per column."""
    rows = []
    for c, s in summarise(df, columns, [0.25, 0.5, 0.75]).items():
        rows.append((c, s.count, s.mean, s.std, s.min, *(s.quantiles.get(p) for p in (0.25, 0.5, 0.75)), s.max))
    return df.sparkSession.createDataFrame(rows, DESCRIBED)


def revenue_totals(fact_orders: DataFrame, status: str = "delivered") -> DataFrame:
    sold = fact_orders.filter(F.col("order_status") == status)
    return sold.agg(
        exact_sum("total_order_value").alias("total_order_value"),
        exact_sum("total_payment_value").alias("total_payment_value"),
    )


def date_range(dim_date: DataFrame) -> DataFrame:
    return dim_date.agg(F.min("date").alias("min_date"), F.max("date").alias("max_date"))


def table_overview(
    name: str, df: DataFrame, keys: list[str] | None = None
) -> dict[str, DataFrame]:
    """Shape, first three rows, missing values and, where the keys exist, their repeats."""
    overview = {
        "shape": table_shape({name: df}),
        "head": df.limit(3),
        "null_counts": null_counts(df),
    }
    if keys and not missing_columns(df, tuple(keys)):
        overview["duplicates"] = duplicate_count(df, keys)
    return overview


def profile_rows(
    table: str,
    df: DataFrame,
    keys: tuple[str, ...] = (),
    numbers: tuple[str, ...] = (),
    frequency: str | None = None,
    top: int | None = None,
    totals: tuple[str, ...] = (),
    totals_where: str = "true",
    dates: str | None = None,
) -> DataFrame:
    """All profiles of a table in one long frame (table, part, item, measure, value, text).

    One scan takes everything that needs no grouping; exact quartiles take one for the first
    histogram and one to three that look only at the rows around a wanted rank. Keys and frequent
    values are counted by groups of their own, which read their columns alone. Parts: shape, nulls
    (columns with missing values), duplicates, describe, frequency, totals and range.
    """
    keys = () if missing_columns(df, keys) else keys
    measured = {"rows": "count(1)"}
    for i, (name, kind) in enumerate(df.dtypes):
        missing = f"`{name}` is null" + (f" or isnan(`{name}`)" if kind in ("double", "float") else "")
        measured[f"null{i}"] = f"count_if({missing})"
    if totals:
        measured["counted"] = f"count_if({totals_where})"
    if dates in df.columns:
        measured |= {f"{m}_date": f"cast({m}(date_from_unix_date(unix_date(`{dates}`))) as string)" for m in ("min", "max")}
    amounts = [f"if({totals_where}, cast(`{name}` as double), null) as _amount{i}" for i, name in enumerate(totals)]
    sums = [exact_sum(f"_amount{i}").alias(f"total{i}") for i in range(len(totals))]
    once = df.selectExpr("*", *amounts).agg(*[F.expr(e).alias(m) for m, e in measured.items()], *sums).first()

    known = [("shape", "", "rows", float(once["rows"]), None), ("shape", "", "columns", float(len(df.columns)), None)]
    known += [("nulls", name, "count", float(once[f"null{i}"]), None) for i, name in enumerate(df.columns) if once[f"null{i}"]]
    if totals and once["counted"]:
        known += [("totals", name, "sum", once[f"total{i}"], None) for i, name in enumerate(totals)]
    if dates in df.columns and once["min_date"] is not None:
        known += [("range", dates, m, None, once[f"{m}_date"]) for m in ("min", "max")]
    for c, s in summarise(df, list(numbers), [0.25, 0.5, 0.75]).items():
        measures = {"count": float(s.count), "mean": s.mean, "std": s.std, "min": s.min, "max": s.max}
        measures |= {f"q{round(100 * p)}": s.quantiles.get(p) for p in (0.25, 0.5, 0.75)}
        known += [("describe", c, m, v, None) for m, v in measures.items()]
    frames = [df.sparkSession.createDataFrame([(table, *k) for k in known], PROFILED)]

    whole = f"'{table}' as table", "part", "item", "measure", "value", "text"
    if keys:
        repeats = df.groupBy(*keys).agg(F.expr("count(1) as n")).agg(F.expr("cast(coalesce(sum(n - 1), 0) as double) as value"))
        frames.append(repeats.selectExpr("'duplicates' as part", f"'{','.join(keys)}' as item", "'count' as measure", "value", "cast(null as string) as text").selectExpr(*whole))
    if frequency in df.columns:
        counts = df.where(f"`{frequency}` is not null").groupBy(F.expr(f"cast(`{frequency}` as string)").alias("text")).agg(F.expr("count(1) as n"))
        values = counts.orderBy(F.desc("n"), F.asc("text"))
        values = values if top is None else values.limit(top)
        frames.append(values.selectExpr("'frequency' as part", f"'{frequency}' as item", "'count' as measure", "cast(n as double) as value", "text").selectExpr(*whole))
    return reduce(DataFrame.unionByName, frames)

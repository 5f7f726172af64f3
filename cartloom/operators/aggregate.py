"""Grouping that ignores rows without a key, and most frequent values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Size of the sketch of frequent values, and how many of them may be counted again.
TRACKED_VALUES = 16384
MAX_CANDIDATES = 4096
#: A value that the sketch does not report has at most this share of the rows: twice the sketch's
#: greatest error, 3.5 over its size.
UNREPORTED = 7 / TRACKED_VALUES


def agg_dropna(df: DataFrame, keys: list[str], *aggregates: Column) -> DataFrame:
    """Aggregate per key, leaving out rows where any key is null."""
    known = " and ".join(f"`{k}` is not null" for k in keys)
    return df.filter(known).groupBy(*keys).agg(*aggregates)


def top_values(df: DataFrame, column: str, limit: int | None = None) -> DataFrame:
    """How often each value occurs, most frequent first, ties by value; nulls are left out.

    With a limit, a sketch of bounded size runs first, at once, and only values that can be among
    the first are counted and shuffled. Where it cannot prove that, all values are counted.
    """
    if limit is not None:
        values = frequent_values(df, column, limit)
        if values is not None:
            df = df.filter(F.col(f"`{column}`").cast("string").isin(values))
    counts = agg_dropna(df, [column], F.expr("count(1) as count"))
    ordered = counts.orderBy(F.desc("count"), F.asc(column))
    return ordered if limit is None else ordered.limit(limit)


def frequent_values(df: DataFrame, column: str, limit: int) -> list[str] | None:
    """Values (as text) among which the ``limit`` most frequent ones surely are; None without proof.

    The sketch reports each value with a count that is too high by at most its error, and misses
    none that has a larger share than ``UNREPORTED``.
    """
    text = f"cast(`{column}` as string)"
    found = df.filter(f"`{column}` is not null").selectExpr("count(1) as total", f"approx_top_k({text}, {TRACKED_VALUES}, {TRACKED_VALUES}) as top").first()
    reported = sorted(((r["count"], r["item"]) for r in found["top"] or []), reverse=True)
    if sum(n for n, _ in reported) == found["total"]:  # every value is there, with its count
        error = 0
    elif len(reported) < min(limit, TRACKED_VALUES) or len(reported) == TRACKED_VALUES:
        return None
    else:
        error = found["total"] * UNREPORTED
    least = reported[limit - 1][0] - error if len(reported) >= limit else 0
    if error and least <= error:  # one that is not reported could still be among the first
        return None
    values = [item for n, item in reported if n >= least]
    return values if len(values) <= MAX_CANDIDATES else None

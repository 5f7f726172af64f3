"""Filling gaps with a column's median."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartloom.functions.numbers import missing_to_null
from cartloom.operators.quantile import summarise


def impute_median(
    df: DataFrame, columns: list[str], method: str = "exact", accuracy: int = 100_000
) -> DataFrame:
    """Replace missing numbers by the median of the column; a column without values stays null.

    The exact median takes a few scans of ``df`` at once, so give it a table that is cheap to scan.
    ``method="approx"`` takes a quantile sketch instead: a value of the column, not interpolated.
    """
    if not columns:
        return df
    numbers = {c: f"cast({missing_to_null(c)} as double)" for c in columns}
    if method == "exact":
        found = {c: summary.quantiles.get(0.5) for c, summary in summarise(df, columns, [0.5]).items()}
        return df.withColumns({c: F.coalesce(F.expr(n), F.lit(found[c]).cast("double")) for c, n in numbers.items()})
    if method == "approx":
        pairs = [f"'{c}', percentile_approx({n}, 0.5D, {accuracy})" for c, n in numbers.items()]
        medians = df.agg(F.expr(f"map({', '.join(pairs)})")).scalar()
    else:
        raise ValueError(f"method must be 'exact' or 'approx', not {method!r}")
    return df.withColumns(
        {
            c: F.coalesce(F.expr(n), F.try_element_at(medians, F.lit(c)))
            for c, n in numbers.items()
        }
    )

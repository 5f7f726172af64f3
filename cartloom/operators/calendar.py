"""Dense daily series."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def daily_calendar(df: DataFrame, timestamp: str, name: str = "date") -> DataFrame:
    """Every day from the first to the last timestamp, both included; no rows without any.

    The series has at most about 214,000 days, as parsed timestamps end in 2262.
    """
    bounds = df.agg(
        F.expr(f"to_date(min(`{timestamp}`)) as first"),
        F.expr(f"to_date(max(`{timestamp}`)) as last"),
    )
    return bounds.selectExpr(f"explode(sequence(first, last, interval 1 day)) as `{name}`")

"""Row numbers over many files or splits, without a task that sees all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartloom.operators.dedupe import INGEST_ORDER


def row_numbers(df: DataFrame, part: str | list[str], row: str, name: str = "row_number") -> DataFrame:
    """Add the number of each row (from 1) in the order of its part, then of ``row`` within it.

    Rows are counted per part; running sums over these counts, one row per part, say how many rows
    lie before each. ``row`` is a number that goes up by one from row to row of a part.
    """
    part = [part] if isinstance(part, str) else list(part)
    keys = [f"_part{i}" for i in range(len(part))]
    placed = df.withColumns({**{k: F.expr(p) for k, p in zip(keys, part, strict=True)}, "_row": F.expr(row)})
    sizes = placed.groupBy(*keys).agg(F.expr("count(1) as _size"), F.expr("min(_row) as _first"))
    order = ", ".join(keys)
    # One row per part, which is a file or a split of many megabytes.
    offsets = sizes.selectExpr(*keys, "_first", f"coalesce(sum(_size) over (order by {order} rows between unbounded preceding and 1 preceding), 0L) as _before")
    numbered = placed.join(F.broadcast(offsets), keys).withColumn(name, F.expr("_before + _row - _first + 1"))
    return numbered.drop(*keys, "_row", "_first", "_before")


def ingest_numbers(df: DataFrame, name: str = "row_number") -> DataFrame:
    """Number the rows of a keyed raw table in the order of its files; use it straight on the reader.

    Splits are counted in the same query that numbers the rows, so both see the same splits.
    """
    at = f"`{INGEST_ORDER}`"
    return row_numbers(df, [f"{at}.p0", f"{at}.p1"], f"{at}.p2", name)

"""Keep-first deduplication."""

from __future__ import annotations

from pyspark.sql import DataFrame

# Column that the sources add to keyed tables: a sortable position in the input.
INGEST_ORDER = "_ingest_order"


def dedupe_first(
    df: DataFrame, keys: str | list[str], order_by: str | None = None
) -> DataFrame:
    """One row per key: the first by ``order_by``, else by ingest order, else by row position.

    Null keys count as equal. ``row_number() = 1`` makes Spark drop later copies before the
    shuffle (WindowGroupLimit), so a key with very many copies sends one row per map task.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    if order_by is None and INGEST_ORDER in df.columns:
        order_by = INGEST_ORDER
    elif order_by is None:
        order_by = "_position"
        df = df.selectExpr("*", "monotonically_increasing_id() as _position")
    per_key = ", ".join(f"`{k}`" for k in keys)
    rank = f"row_number() over (partition by {per_key} order by {order_by}) as _rank"
    first = df.selectExpr("*", rank).filter("_rank = 1")
    return first.drop("_rank", "_position", INGEST_ORDER)

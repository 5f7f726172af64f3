"""Joins that stay balanced when a few keys hold much of the left side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Least number of parts that a key with all the rows is split into; more with more partitions.
SALTS = 1024
MAX_HOT_KEYS = 1000
#: Size of the sketch that counts keys; its error stays far below a thousandth of the rows.
TRACKED_KEYS = 16384

ROW_SALT = "_row_salt"
ROW_SALTS = 2**20


def hot_keys(df: DataFrame, columns: list[str]) -> dict[str, dict]:
    """Per column, the keys (null included) that hold more than 1/1000 of the rows, and into how many parts to split each.

    One aggregate over the key columns with a sketch of bounded size per task: no row is shuffled
    by its key. Some 1000 keys per column can pass, which bounds what comes back to the driver.
    The parts follow a key's share of the rows. No result depends on them.
    """
    spark = df.sparkSession
    parts = max(SALTS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    measures = ["count(1) as total"]
    for i, c in enumerate(columns):
        key = f"cast(`{c}` as string)"
        measures.append(f"count_if(`{c}` is null) as missing_{i}")
        measures.append(f"approx_top_k({key}, {MAX_HOT_KEYS}, {TRACKED_KEYS}) filter (where `{c}` is not null) as top_{i}")
    found = df.select(*columns).selectExpr(*measures).first()
    hot = {}
    for i, c in enumerate(columns):
        counts = {None: found[f"missing_{i}"], **{row.item: row["count"] for row in found[f"top_{i}"] or []}}
        hot[c] = {k: 1 + n * parts // found.total for k, n in counts.items() if n * MAX_HOT_KEYS > found.total}
    return hot


def with_row_salt(df: DataFrame) -> DataFrame:
    """Add a number per row that spreads even identical rows.

    Call it on a scan: there the row position is the same when a lost task runs again.
    """
    spread = f"cast(pmod(xxhash64(monotonically_increasing_id()), {ROW_SALTS}) as int)"
    return df.selectExpr("*", f"{spread} as {ROW_SALT}")


def salted_join(
    left: DataFrame, right: DataFrame, key: str, how: str, hot: dict | list | None = None
) -> DataFrame:
    """Inner or left equi-join that spreads the hot keys of the left side over all tasks.

    ``hot`` holds the parts of each hot key, or is a list of keys with ``SALTS`` parts each. Rows
    of a hot key are split by their salt and the few matching right rows are repeated per part;
    all other rows join as usual. Without hot keys this is a plain join. The left side needs the
    column of ``with_row_salt`` when there are hot keys; it is kept.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how must be 'inner' or 'left', not {how!r}")
    if not hot:
        return left.join(right, key, how)
    if not isinstance(hot, dict):
        hot = dict.fromkeys(hot, SALTS)
    salt = "_join_salt"
    hot_parts = F.when(_is_hot(key, list(hot)), _parts(key, hot))
    left_salt = F.coalesce(F.pmod(F.col(ROW_SALT), hot_parts), F.lit(0))
    right_salts = F.sequence(F.lit(0), F.coalesce(hot_parts, F.lit(1)) - 1)
    spread = left.withColumn(salt, left_salt)
    repeated = right.dropna(subset=[key]).withColumn(salt, F.explode(right_salts))
    return spread.join(repeated, [key, salt], how).drop(salt)


def _parts(key: str, hot: dict) -> Column:
    """Into how many parts a hot key is split."""
    known = [F.lit(x) for k, n in hot.items() if k is not None for x in (str(k), n)]
    by_key = F.try_element_at(F.create_map(*known), F.col(key).cast("string")) if known else F.lit(None).cast("int")
    return F.coalesce(by_key, F.lit(hot.get(None, 1)))


def _is_hot(key: str, hot: list) -> Column:
    known = [str(k) for k in hot if k is not None]
    condition = F.coalesce(F.col(key).cast("string").isin(known), F.lit(False))
    return condition | F.col(key).isNull() if None in hot else condition

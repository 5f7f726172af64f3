"""Sharding by histogram sort: shards of near-equal bytes, cut from one order of all rows.

Rows are ordered by (hash of the text, hash of the id, place in the written key table), so equal
texts lie together and yet may be cut apart. The bytes and rows below candidate key boundaries
are counted exactly, over all partitions. Intervals in which a shard boundary falls, or that hold
too many rows, get new probes until each boundary is within the tolerance and each interval is
small. Then every row is exchanged once, by interval, for its slot.

The histograms are bounded by the number of probes: a key that holds a third of the rows is
probed deeper, down to single rows.

Edge cases: a null text counts no bytes beyond the fixed overhead; repeated rows are rows of
their own; an empty table gives an empty result; shards may stay empty if there are few rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartloom.llm.tables import Scratch, literal_strings, whole_text

#: Hexadecimal digits of a key that one round of probes tells apart.
STEP = 3


def _key_table(docs: DataFrame, id_column: str, text_column: str, overhead: int) -> DataFrame:
    hexed = "lpad(lower(hex({})), 16, '0')"
    rows = docs.select(F.col(id_column).alias("id"), whole_text(text_column).alias("txt"))
    return rows.select(
        "id",
        (F.octet_length("txt") + F.lit(overhead)).cast("long").alias("size"),
        F.crc32(F.encode("txt", "UTF-8")).alias("crc"),
        F.concat(
            F.expr(hexed.format("xxhash64(txt)")),
            F.expr(hexed.format("xxhash64(id)")),
            F.expr(hexed.format("monotonically_increasing_id()")),
        ).alias("key"),
    )


def _histogram(keys: DataFrame, probes: list[tuple[str, int]]) -> list[dict]:
    """Exact bytes and rows between probes: intervals are the prefixes of ``length`` digits in each bracket."""
    if not probes:
        chosen = keys.withColumn("prefix", F.substring("key", 1, STEP))
    else:
        # One lookup per row for each length in use; the brackets are a bounded list.
        lengths = sorted({len(b) for b, _ in probes})
        picked = " ".join(
            f"when substring(key, 1, {n}) in ({literal_strings([b for b, _ in probes if len(b) == n])[6:-1]}) "
            f"then substring(key, 1, element_at({_lengths([(b, m) for b, m in probes if len(b) == n])}, substring(key, 1, {n})))"
            for n in lengths
        )
        chosen = keys.withColumn("prefix", F.expr(f"case {picked} end")).where("prefix is not null")
    counted = chosen.groupBy("prefix").agg(
        F.sum("size").alias("bytes"), F.count("*").alias("rows"), F.min("key").alias("low"), F.max("key").alias("high")
    )
    return [r.asDict() for r in counted.collect()]


def _lengths(pairs: list[tuple[str, int]]) -> str:
    return "map(" + ", ".join(f"'{b}', {m}" for b, m in pairs) + ")"


def _common(a: str, b: str) -> int:
    return next((i for i, (x, y) in enumerate(zip(a, b, strict=True)) if x != y), len(a))


def find_intervals(keys: DataFrame, n_shards: int, tolerance: float, leaf_rows: int) -> tuple[list[dict], list[str]]:
    """Intervals in key order with exact counts, and the first interval of each shard but the first."""
    leaves, total = sorted(_histogram(keys, []), key=lambda r: r["prefix"]), None
    while True:
        total = sum(r["bytes"] for r in leaves)
        slack = tolerance * total / n_shards
        refine, below = {}, 0
        for r in leaves:
            above = below + r["bytes"]
            cut = any(below + slack < total * i / n_shards < above - slack for i in _between(below, above, total, n_shards))
            if r["low"] != r["high"] and (cut or r["rows"] > leaf_rows):
                refine[r["prefix"]] = min(len(r["low"]), _common(r["low"], r["high"]) + STEP)
            below = above
        if not refine:
            break
        finer = _histogram(keys, sorted(refine.items()))
        leaves = sorted([r for r in leaves if r["prefix"] not in refine] + finer, key=lambda r: r["prefix"])
    splitters, below, i = [], 0, 1
    for r in leaves:
        # A boundary goes before or after the interval, whichever is nearer.
        while i < n_shards and total * i / n_shards <= below + r["bytes"] / 2:
            splitters.append(r["prefix"])
            i += 1
        below += r["bytes"]
    return leaves, splitters


def _between(below: int, above: int, total: int, n: int) -> range:
    return range(max(1, below * n // max(total, 1)), min(n - 1, above * n // max(total, 1)) + 1)


def shard_by_bytes(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    n_shards: int = 40,
    overhead: int = 16,
    tolerance: float = 0.001,
    leaf_share: float = 0.002,
) -> DataFrame:
    """(id, size, text_crc32, law, shard, slot, grown_shard), one row per document row.

    ``tolerance`` is the distance of a boundary from its ideal place, as a share of a shard;
    ``leaf_share`` the largest share of all rows that one interval, and so one task, may hold.
    """
    spark = docs.sparkSession
    keys = Scratch(spark, "shards").keep(_key_table(docs, id_column, text_column, overhead))
    n_rows = keys.count()
    leaves, splitters = find_intervals(keys, n_shards, tolerance, max(64, int(n_rows * leaf_share)))
    firsts, shard, table = set(), 0, []
    before = 0
    for r in leaves:
        moved = splitters.count(r["prefix"]) if r["prefix"] not in firsts else 0
        firsts.add(r["prefix"])
        if moved:
            shard, before = shard + moved, 0
        table.append((r["prefix"], shard, before))
        before += r["rows"]
    lengths = sorted({len(p) for p, _, _ in table}) or [STEP]
    intervals = spark.createDataFrame(table, "prefix string, shard int, before long") if table else None
    if intervals is None:
        empty = "cast(null as string) prefix, 0 shard, 0L before"
        intervals = spark.sql(f"select {empty}").limit(0)
    # An interval is found by its own length: no two intervals overlap.
    placed = None
    for n in lengths:
        part = keys.withColumn("prefix", F.substring("key", 1, n)).join(
            F.broadcast(intervals.where(F.length("prefix") == n)), "prefix"
        )
        placed = part if placed is None else placed.unionByName(part)
    return placed.select(
        F.col("id").alias(id_column),
        "size",
        F.col("crc").alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        F.expr("before + row_number() over (partition by prefix order by key) - 1").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )

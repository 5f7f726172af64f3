"""Connected components of a distributed edge list, by contraction in random order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartloom.llm.tables import Scratch
from cartloom.operators.skew import hot_keys, salted_join, with_row_salt


def connected_components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b: long); all nodes of a component share a root.

    Each round points every node to the neighbour, or itself, of the smallest hash, merges along
    these pointers and drops the edges within merged nodes. The hash changes by round, so a
    constant share of the nodes goes in each. A node's neighbours are reduced to one before the
    shuffle, so a hub costs a row per task; where nodes are renamed, the rows of a hub or of a large
    component are found by a sketch and dealt over many tasks. Every round is a written table.
    """
    current = scratch.keep(edges.where("a <> b").selectExpr("least(a, b) as a", "greatest(a, b) as b").distinct())
    roots, turn = None, 0
    while True:
        order = f"struct(xxhash64(b, {turn}) as h, b as n)"
        both = current.union(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        nearest = both.groupBy("a").agg(F.expr(f"min({order})").alias("m"))
        own = f"struct(xxhash64(a, {turn}) as h, a as n)"
        points = scratch.keep(nearest.select(F.col("a").alias("node"), F.expr(f"least(m, {own}).n").alias("root")))
        if roots is None:
            roots = points
        else:
            step = points.select(F.col("node").alias("root"), F.col("root").alias("next"))
            moved = salted_join(with_row_salt(roots), step, "root", "left", hot_keys(roots, ["root"])["root"])
            roots = moved.select("node", F.coalesce("next", "root").alias("root"))
        ends = [points.select(F.col("node").alias(c), F.col("root").alias(f"{c}_root")) for c in ("a", "b")]
        hot = hot_keys(current, ["a", "b"])
        moved = salted_join(with_row_salt(current), ends[0], "a", "inner", hot["a"])
        moved = salted_join(moved, ends[1], "b", "inner", hot["b"]).where("a_root <> b_root")
        current = scratch.keep(moved.selectExpr("least(a_root, b_root) as a", "greatest(a_root, b_root) as b").distinct())
        roots = scratch.keep(roots)
        turn += 1
        if current.isEmpty():
            return roots

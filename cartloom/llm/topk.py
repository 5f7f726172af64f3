"""Exact top-k search by inner product, with a three-phase uniform threshold.

A vector is cut into ``segments`` runs of components; each run gives a partial score, and the
score is their sum. For a block of queries:

1. each task lists the rows with the best partial scores in the first segment, ``2 * k`` of every
   chunk of rows, and sums those it lists exactly; the k-th best sum over all tasks is a safe
   cutoff, since k rows reach it;
2. the cutoff is sent back. A row that reaches it has a partial score of at least
   ``cutoff / segments`` somewhere, so rows whose segments are all too short for that share, by
   the product of norms, are left out before any product is taken. For the others the first
   segment is computed, and the entries are collected whose partial score and the bound on all
   segments they lack reach the cutoff, or the task's own k-th best score if that is higher;
3. the remaining segments are computed for the entries collected, which get fewer with each
   segment, and each task passes on its k best.

No list, block or message grows with the table: queries come in blocks of bounded size, which one
scan takes in parts, a task holds k rows per query, and the last ranking sees k rows per query and
task. Long vectors cost a chunk of rows more memory in proportion.

Edge cases: vectors that are null or empty, or hold null or non-finite components, and rows
without id take no part, neither as query nor as candidate; a query meets candidates of its own
length only; rows with the query's id are not its candidates; other repeated rows compete one by
one; ties go to the smaller id; with fewer than k candidates all are returned.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartloom.llm.tables import Scratch

#: Stands for no score; scores are smaller than this in size.
NONE = -(2**58)
#: Rows and queries scored at a time in a task.
CHUNK, PART = 512, 4096
#: More than every rounding error of a bound; scores are compared exactly in the end.
SLACK = 256
#: Entries are resolved one by one if fewer than one in this many is left.
SPARSE = 12


class Block:
    """A bounded number of queries, by vector length and in parts."""

    def __init__(self, rows: list, scale: int):
        self.parts: dict[int, list] = {}
        self.ids, at = np.empty(0, np.int64), 0
        for n in sorted({len(v) for _, v in rows}):
            own = [(i, v) for i, v in rows if len(v) == n]
            for low in range(0, len(own), PART):
                part = own[low : low + PART]
                ids = np.array([i for i, _ in part], np.int64)
                self.parts.setdefault(n, []).append((at, ids, _codes(np.array([v for _, v in part]), scale)))
                self.ids, at = np.concatenate([self.ids, ids]), at + len(part)
        self.size = at


def _codes(vectors: np.ndarray, scale: int) -> np.ndarray:
    return np.floor(scale * vectors.astype(np.float64))


def _exact(queries: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both sides in a type that holds every sum of products exactly."""
    most = queries.shape[1] * float(np.abs(queries).max(initial=0)) * float(np.abs(rows).max(initial=0))
    if most < 2**53:
        return queries, rows
    if most < -NONE:
        return queries.astype(np.int64), rows.astype(np.int64)
    raise ValueError("Scores may exceed a long")


def _chunks(batches: Iterator[pa.RecordBatch], block: Block, scale: int):
    """Of each chunk of rows and part of the block: offset of the queries, ids, both sides, and which pairs have the query's id."""
    for batch in batches:
        ids, vectors = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1)
        sizes = np.diff(vectors.offsets.to_numpy())
        for n, parts in block.parts.items():
            chosen = np.flatnonzero(sizes == n)
            for i in range(0, len(chosen), CHUNK):
                place = chosen[i : i + CHUNK]
                rows = _codes(vectors.take(pa.array(place)).flatten().to_numpy().reshape(-1, n), scale)
                for at, query_ids, queries in parts:
                    left, right = _exact(queries, rows)
                    yield at, ids[place].astype(np.int64), left, right, query_ids[:, None] == ids[place][None, :]


def _cuts(n: int, segments: int) -> np.ndarray:
    return np.linspace(0, n, min(segments, n) + 1).astype(int)


def _norms(side: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """A row's length in each segment."""
    return np.stack([np.linalg.norm(side[:, a:b].astype(float), axis=1) for a, b in zip(cuts, cuts[1:], strict=False)], axis=1)


def listed_sums(left: np.ndarray, right: np.ndarray, own: np.ndarray, segments: int, few: int) -> np.ndarray:
    """Per query the exact scores of the ``few`` rows that lead in the first segment."""
    cut = _cuts(left.shape[1], segments)[1]
    first = left[:, :cut] @ right[:, :cut].T
    first[own] = NONE
    few = min(few, first.shape[1])
    top = np.argpartition(first, -few, axis=1)[:, -few:]
    sums = np.take_along_axis(first, top, axis=1) + np.einsum("qd,qfd->qf", left[:, cut:], right[:, cut:][top])
    return np.where(np.take_along_axis(own, top, axis=1), NONE, sums).astype(np.int64)


def resolve(left: np.ndarray, right: np.ndarray, own: np.ndarray, least: np.ndarray, segments: int):
    """(query, row, score) of all entries with a score of ``least`` or more, and the products taken."""
    cuts = _cuts(left.shape[1], segments)
    m, floor = len(cuts) - 1, least.astype(float) - SLACK
    near, far = _norms(left, cuts), _norms(right, cuts)
    # The uniform share: a row that no query can list in any segment is out.
    share = floor / m
    reach = np.where(share[:, None] > 0, near / np.maximum(share, 1e-9)[:, None], np.inf).max(axis=0)
    every = np.isinf(reach)
    rows = np.flatnonzero(((far * np.where(every, 0, reach) >= 1) | every).any(axis=1))
    right, far, own = right[rows], far[rows], own[:, rows]
    held = left[:, : cuts[1]] @ right[:, : cuts[1]].T
    products = held.size * cuts[1]
    alive = (held + near[:, 1:] @ far[:, 1:].T >= floor[:, None]) & ~own
    done = 1
    while done < m and np.count_nonzero(alive) * SPARSE >= alive.size > 0:
        a, b = cuts[done], cuts[done + 1]
        held += left[:, a:b] @ right[:, a:b].T
        products += held.size * (b - a)
        done += 1
        alive &= held + near[:, done:] @ far[:, done:].T >= floor[:, None]
    q, r = np.nonzero(alive)
    score = held[q, r]
    for j in range(done, m):
        a, b = cuts[j], cuts[j + 1]
        score = score + np.einsum("id,id->i", left[q, a:b], right[r, a:b])
        products += len(q) * (b - a)
        able = score + np.einsum("id,id->i", near[q, j + 1 :], far[r, j + 1 :]) >= floor[q]
        q, r, score = q[able], r[able], score[able]
    score = score.astype(np.int64)
    found = score >= least[q]
    return q[found], rows[r[found]], score[found], products


def _local_lists(block: Block, scale: int, segments: int, k: int):
    def run(batches):
        best = np.full((block.size, k), NONE, np.int64)
        for at, _, left, right, own in _chunks(batches, block, scale):
            sums = listed_sums(left, right, own, segments, 2 * k)
            here = slice(at, at + len(sums))
            best[here] = np.sort(np.concatenate([best[here], sums], axis=1), axis=1)[:, -k:]
        q, r = np.nonzero(best > NONE)
        yield pa.RecordBatch.from_arrays([pa.array(q.astype(np.int32)), pa.array(best[q, r])], ["q", "score"])

    return run


def _resolved(block: Block, first: int, cutoff: np.ndarray, scale: int, segments: int, k: int):
    def reduce(q, ids, scores):
        order = np.lexsort((ids, -scores, q))
        q, ids, scores = q[order], ids[order], scores[order]
        rank = np.arange(len(q)) - np.searchsorted(q, q)
        full = rank == k - 1  # the task's own k-th best
        return (q[rank < k], ids[rank < k], scores[rank < k]), q[full], scores[full]

    def run(batches):
        kept, least = (np.empty(0, np.int64),) * 3, cutoff.copy()
        for at, ids, left, right, own in _chunks(batches, block, scale):
            q, r, scores, _ = resolve(left, right, own, least[at : at + len(left)], segments)
            if len(q):
                kept, known, score = reduce(*(np.concatenate(x) for x in zip(kept, (q + at, ids[r], scores), strict=True)))
                least[known] = np.maximum(least[known], score)
        q, ids, scores = kept
        yield pa.RecordBatch.from_arrays(
            [pa.array(q + first), pa.array(block.ids[q]), pa.array(ids), pa.array(scores)],
            ["ask", "query_id", "vec_id", "score"],
        )

    return run


def _blocks(queries: DataFrame, size: int) -> Iterator[list]:
    rows = []
    for r in queries.toLocalIterator():
        rows.append((r[0], r[1]))
        if len(rows) == size:
            yield rows
            rows = []
    if rows:
        yield rows


def exact_topk(
    vectors: DataFrame,
    is_query: Column,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    k: int = 5,
    scale: int = 256,
    segments: int = 4,
    block_size: int = 8 * PART,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row where ``is_query`` holds, its k best other rows.

    A component x counts as ``floor(scale * x)``, so scores are whole numbers.
    """
    spark = vectors.sparkSession
    valid = vectors.select(
        F.col(id_column).cast("long").alias("id"),
        F.col(vector_column).cast("array<double>").alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
    ).where("id is not null and size(vector) > 0 and forall(vector, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))")
    rows = valid.select("id", "vector")
    scratch, found = Scratch(spark, "topk"), None
    # A repeated query row is asked once.
    queries = valid.where("asks").select("id", "vector").dropDuplicates()
    for number, asked in enumerate(_blocks(queries, block_size)):
        block = Block(asked, scale)
        lists = rows.mapInArrow(_local_lists(block, scale, segments, k), "q int, score long")
        ranked = lists.withColumn("n", F.expr("row_number() over (partition by q order by score desc)")).where(f"n = {k}")
        cutoff = np.full(block.size, NONE + 1, np.int64)
        for r in ranked.collect():  # a row per query of the block
            cutoff[r["q"]] = r["score"]
        resolve = _resolved(block, number * block_size, cutoff, scale, segments, k)
        part = scratch.keep(rows.mapInArrow(resolve, "ask long, query_id long, vec_id long, score long"))
        found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.sql("select 0L query_id, 0 rank, 0L vec_id, 0L score").limit(0)
    order = "row_number() over (partition by ask order by score desc, vec_id)"
    return found.withColumn("rank", F.expr(order)).where(f"rank <= {k}").select("query_id", "rank", "vec_id", "score")

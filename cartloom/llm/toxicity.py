"""Toxicity grades by cumulative-link ordinal regression on sparse text features.

``P(grade <= k) = sigmoid(cut_k - w . x)``: one weight vector serves all ordered thresholds. The
features x are the distinct words of a text and the prefixes of 4, 5 and 6 letters of longer
words, hashed; so inflected and joined forms of a word share weight with it. The result is the
expected grade and the probability of any toxicity.

The features are chosen, and the model is fitted with numpy, on a bounded sample of labelled
rows (``sample_rows``); every row of the corpus is then scored. Labels say toxic or not, so
severity grades come from the sample: a toxic text has grade 1, grade 2 with at least two
distinct words that are found almost only in toxic texts, grade 3 with at least four.

Edge cases: a null or empty text has no features and gets the base rate of the model; labels
without text, or null, are left out; without toxic or without clean labels nothing is rejected;
repeated rows are scored one by one.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartloom.llm.tables import Scratch, bounded_sample, returning_memory

WORD = re.compile(r"[^\W\d_]+")
BITS = 18
#: Feature kinds in the low two bits: whole word, then prefixes.
PREFIXES = (4, 5, 6)


def features(text: str) -> set[int]:
    found, mask = set(), (1 << BITS) - 1
    crc = zlib.crc32
    for word in set(WORD.findall(text.lower())):
        data = word.encode()
        found.add((crc(data) & mask) << 2)
        for kind, n in enumerate(PREFIXES, 1):
            if len(word) > n:
                found.add((crc(word[:n].encode()) & mask) << 2 | kind)
    return found


def _extracted(chosen: np.ndarray | None):
    wanted = None if chosen is None else set(chosen.tolist())

    def run(batches):
        for batch in batches:
            sets = [features(t.as_py()) for t in batch.column(1)]
            lists = [sorted(s if wanted is None else s & wanted) for s in sets]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lists, pa.list_(pa.int32()))], ["toxic", "features"])

    return run


@dataclass
class OrdinalModel:
    chosen: np.ndarray
    weights: np.ndarray
    cuts: np.ndarray

    def table(self) -> dict[int, float]:
        return dict(zip(self.chosen.tolist(), self.weights.tolist(), strict=True))

    def above(self, score: np.ndarray) -> np.ndarray:
        """P(grade > k) by row and k."""
        return 1 / (1 + np.exp(np.clip(self.cuts[None, :] - score[:, None], -50, 50)))


def fit_ordinal(rows: list[list[int]], grades: np.ndarray, chosen: np.ndarray, penalty: float = 3e-4, rounds: int = 400) -> OrdinalModel:
    """Maximum likelihood with an L2 penalty, by Adam on the whole sample."""
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    column = np.searchsorted(chosen, np.concatenate([np.asarray(r, np.int64) for r in rows]) if len(owner) else np.empty(0, int))
    n, top = len(rows), int(grades.max())
    weights = np.zeros(len(chosen))
    # Cut points are a first one and positive gaps.
    share = [np.clip((grades <= k).mean(), 1e-3, 1 - 1e-3) for k in range(top)]
    start = np.log(np.array(share) / (1 - np.array(share)))
    free = np.concatenate([start[:1], np.log(np.maximum(np.diff(start), 1e-2))])
    params = np.concatenate([weights, free])
    m, v = np.zeros_like(params), np.zeros_like(params)
    for step in range(1, rounds + 1):
        weights, free = params[: len(chosen)], params[len(chosen) :]
        cuts = np.concatenate([free[:1], free[0] + np.cumsum(np.exp(free[1:]))])
        score = np.bincount(owner, weights[column], minlength=n)
        edge = np.concatenate([np.full(1, -50.0), cuts, np.full(1, 50.0)])
        s = 1 / (1 + np.exp(-np.clip(edge[None, :] - score[:, None], -50, 50)))
        high, low = s[np.arange(n), grades + 1], s[np.arange(n), grades]
        p = np.maximum(high - low, 1e-12)
        d_high, d_low = high * (1 - high) / p, low * (1 - low) / p
        by_score = d_high - d_low  # of the negative log likelihood
        gradient = np.bincount(column, by_score[owner], minlength=len(chosen)) / n + penalty * weights
        by_cut = np.array([-d_high[grades == k].sum() + d_low[grades == k + 1].sum() for k in range(top)]) / n
        tail = np.cumsum(by_cut[::-1])[::-1]
        by_free = np.concatenate([tail[:1], tail[1:] * np.exp(free[1:])])
        g = np.concatenate([gradient, by_free])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        params = params - 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    weights, free = params[: len(chosen)], params[len(chosen) :]
    return OrdinalModel(chosen, weights, np.concatenate([free[:1], free[0] + np.cumsum(np.exp(free[1:]))]))


def train(
    docs: DataFrame, labels: DataFrame, id_column: str, text_column: str, label_column: str, sample_rows: int, n_features: int
) -> OrdinalModel | None:
    known = labels.where(F.col(label_column).isNotNull() & F.col(id_column).isNotNull()).select(
        F.col(id_column).alias("id"), (F.col(label_column) > 0).cast("int").alias("toxic")
    )
    # A bounded sample, up to a third of it toxic rows; of equal ids one text.
    parts = [bounded_sample(known.where(f"toxic = {t}"), n, "id") for t, n in ((1, sample_rows // 3), (0, sample_rows - sample_rows // 3))]
    sample = parts[0].unionByName(parts[1]).groupBy("id").agg(F.max("toxic").alias("toxic"))
    texts = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("txt")).where("txt is not null")
    scratch = Scratch(docs.sparkSession, "toxicity")
    labelled = texts.join(F.broadcast(sample), "id")
    held = scratch.keep(labelled.groupBy("id").agg(F.max("toxic").alias("toxic"), F.min("txt").alias("txt")).select("toxic", "txt"))
    n = {r["toxic"]: r["count"] for r in held.groupBy("toxic").count().collect()}
    if len(n) < 2:
        return None
    counted = (
        held.mapInArrow(returning_memory(_extracted(None)), "toxic int, features array<int>")
        .select("toxic", F.explode("features").alias("feature"))
        .groupBy("feature")
        .agg(F.sum("toxic").alias("bad"), F.count("*").alias("all"))
    )
    share = n[1] / (n[0] + n[1])
    chi = f"pow(bad - all * {share}, 2) / (all * {share} * {1 - share})"
    best = counted.where("all >= 5").orderBy(F.expr(chi).desc(), "feature").limit(n_features).collect()
    if not best:
        return None
    chosen = np.array(sorted(r["feature"] for r in best), np.int64)
    markers = {r["feature"] for r in best if r["feature"] % 4 == 0 and (r["bad"] + 1) / (r["all"] + 2) >= 0.9}
    rows = held.mapInArrow(returning_memory(_extracted(chosen)), "toxic int, features array<int>").toArrow().to_pylist()
    lists = [r["features"] for r in rows]
    strong = np.array([sum(f in markers for f in x) for x in lists])
    grades = np.array([r["toxic"] for r in rows]) * (1 + (strong >= 2) + (strong >= 4))
    return fit_ordinal(lists, grades, chosen)


def grade_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "toxic",
    sample_rows: int = 12_000,
    n_features: int = 4096,
    reject_at: float = 0.3,
    with_rows: bool = False,
) -> DataFrame:
    """(id, severity, grade, p_toxic, rejected) per document row, and the whole row as ``row`` if asked.

    ``severity`` is the expected grade, ``grade`` the most likely one; a text is rejected if its
    probability of any toxicity is at least ``reject_at``. The model is fitted on at most
    ``sample_rows`` labelled texts and keeps ``n_features`` of their features; whole texts are read,
    also very long ones.
    """
    model = train(docs, labels, id_column, text_column, label_column, sample_rows, n_features)
    table = model.table() if model else {}

    def run(batches):
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            score = np.array([sum(table.get(f, 0.0) for f in features(t.as_py())) for t in texts])
            if model:
                above = model.above(score)
            else:
                above = np.zeros((len(score), 1))
            each = np.concatenate([np.ones((len(score), 1)), above], axis=1) - np.concatenate([above, np.zeros((len(score), 1))], axis=1)
            columns = [
                *batch.columns[:-1],
                pa.array(above.sum(axis=1)),
                pa.array(each.argmax(axis=1).astype(np.int32)),
                pa.array(above[:, 0]),
                pa.array(above[:, 0] >= reject_at),
            ]
            yield pa.RecordBatch.from_arrays(columns, names)

    kept = [F.col(id_column), *([F.struct("*").alias("row")] if with_rows else [])]
    given = docs.select(*kept, F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("_toxicity_text"))
    out = given.drop("_toxicity_text").schema
    for name, kind in (("severity", "double"), ("grade", "integer"), ("p_toxic", "double"), ("rejected", "boolean")):
        out = out.add(name, kind)
    names = out.names
    return given.mapInArrow(returning_memory(run), out)

"""Ranked lexical search with bit-sliced Bloom signatures.

1. *Index* (once, for any items): every document gets a Bloom signature of its (term, level) pairs:
   a term that occurs tf times has an entry for each of ``LEVELS`` up to tf. Documents with
   signatures of equal width form blocks, and a block is stored bit-sliced: one bitmap over its
   documents per bit position. ANDing the slices of an entry gives the documents that may hold it;
   none that holds it is missing.
2. *Bounds*: the first level that a document surely lacks bounds tf from above, so the weighted
   sum over an item's terms bounds its score from above. All of it is integer arithmetic, so a
   bound is never too low by rounding.
3. *Seeds*: the documents with the highest bounds of each item are scored exactly; their k-th best
   score is a floor that the final k-th score cannot miss.
4. Every document whose bound reaches the floor of an item is scored exactly from its text; all
   others are provably outside. Equal scores are ranked by id.

The index is scanned twice, the texts three times (statistics, index, exact scores of what is left)
and once more for the few seeds. Items are taken in blocks of ``max_items``, whose terms and weights
go to all tasks.

Edge cases: a null text, or one without terms, counts as no document; an item without terms has no
rows; items of equal id are one item with the terms of all; every row of the documents is ranked,
also repeated ones; a document without id comes last among equal scores; empty tables give no rows;
other columns are not looked at; texts are never cut, and the signature of a very long one is as
wide as it needs.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartloom.llm.tables import Scratch

#: What a term is made of, over UTF-8 bytes: digits, lower-cased A-Z and all beyond ASCII.
TERM = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: Numbers of occurrences that have an entry of their own.
LEVELS = (1, 2, 3, 4, 6, 8, 12, 16, 24, 32, 48, 64, 96, 128, 256, 1024)
#: Bits per entry and hash functions: about one false entry in 500.
BITS, HASHES = 14, 7
#: Documents in a block at most, and bytes of a block unless eight documents need more.
BLOCK_DOCS, BLOCK_BYTES = 1024, 2_000_000
#: Terms times documents whose bounds are taken at once.
CELLS = 2_000_000
#: Up to so many pairs of item and candidate go to all tasks (some 20 MB); more are joined by a shuffle.
BROADCAST_PAIRS = 1_000_000


def terms_of(text: bytes) -> list[bytes]:
    return TERM.findall(text.lower())  # bytes: only A-Z change


def positions(hashes: np.ndarray, level: np.ndarray | int, width: int) -> np.ndarray:
    """(entries, HASHES) bit positions below ``width``, a power of two, of the entries (term hash, level)."""
    with np.errstate(over="ignore"):
        mix = hashes + (np.asarray(level).astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        mix = (mix ^ (mix >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        mix = (mix ^ (mix >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        mix ^= mix >> np.uint64(31)
        step = (mix >> np.uint64(32)) | np.uint64(1)
        return (mix[:, None] + np.arange(HASHES, dtype=np.uint64) * step[:, None]) & np.uint64(width - 1)


def _texts(batches: Iterable[pa.RecordBatch], *columns: str) -> Iterator[tuple]:
    """Rows one by one, so that no more than one text is held beside its batch."""
    for batch in batches:
        held = [batch.column(batch.schema.get_field_index(c)) for c in columns]
        for i in range(batch.num_rows):
            yield tuple(c[i].as_py() for c in held)


# Statistics


def _statistics(vocabulary: dict[bytes, int]):
    """Counts by key: -1 documents, -2 their terms, else documents that hold the term of that number."""
    schema = pa.schema([("key", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for (text,) in _texts(batches, "body"):
            terms = terms_of(text)
            if terms:
                counts[-1] += 1
                counts[-2] += len(terms)
                counts.update(vocabulary[t] for t in set(terms) if t in vocabulary)
        yield pa.RecordBatch.from_pydict({"key": list(counts), "n": list(counts.values())}, schema=schema)

    return run, "key long, n long"


# Index

_INDEX = pa.schema([("width", pa.int64()), ("ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("slices", pa.binary())])
_INDEX_DDL = "width long, ids array<long>, lengths array<long>, slices binary"


class _Block:
    """Documents with signatures of one width: a bitmap over documents for each bit position."""

    def __init__(self, width: int):
        self.width, self.ids, self.lengths = width, [], []
        self.room = max(8, min(BLOCK_DOCS, BLOCK_BYTES * 8 // width // 8 * 8))
        self.bits = np.zeros((width, self.room // 8), np.uint8)

    def add(self, doc: int | None, length: int, entries: np.ndarray) -> bool:
        """Whether the block is full now."""
        i = len(self.ids)
        self.bits[entries, i // 8] |= np.uint8(1 << (i % 8))
        self.ids.append(doc)
        self.lengths.append(length)
        return i + 1 == self.room

    def record(self) -> pa.RecordBatch:
        slices = self.bits[:, : -(-len(self.ids) // 8)].tobytes()
        return pa.RecordBatch.from_pydict({"width": [self.width], "ids": [self.ids], "lengths": [self.lengths], "slices": [slices]}, schema=_INDEX)


def _index(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict[bytes, int] = {}
    blocks: dict[int, _Block] = {}
    for doc, text in _texts(batches, "doc", "body"):
        counts = Counter(terms_of(text))
        if not counts:
            continue
        if len(known) > 500_000:  # hashes of terms met before, to save time
            known.clear()
        for term in [t for t in counts if t not in known]:  # a difference of key sets would go over all known ones
            known[term] = xxhash.xxh3_64_intdigest(term)
        hashes = np.fromiter((known[t] for t in counts), np.uint64, len(counts))
        tf = np.fromiter(counts.values(), np.int64, len(counts))
        levels = np.searchsorted(LEVELS, tf, side="right")
        which = np.repeat(np.arange(len(tf)), levels)
        level = np.arange(len(which)) - np.repeat(np.cumsum(levels) - levels, levels)
        width = 1 << max(6, (BITS * len(which) - 1).bit_length())
        block = blocks.get(width) or blocks.setdefault(width, _Block(width))
        if block.add(doc, int(tf.sum()), positions(hashes[which], level, width)):
            yield blocks.pop(width).record()
    for block in blocks.values():
        yield block.record()


def build_index(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(width, ids, lengths, slices): one row per block of documents."""
    return _bodies(docs, id_column, text_column).mapInArrow(_index, _INDEX_DDL)


def _bodies(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    return docs.select(F.col(id_column).cast("long").alias("doc"), F.col(text_column).cast("string").cast("binary").alias("body")).where("body is not null")


# Scores


class Items:
    """A block of items as numbers: term lists, weights and collection statistics."""

    def __init__(self, terms: dict, counts: dict[int, int], vocabulary: dict[bytes, int]):
        self.n, self.total = counts.get(-1, 0), counts.get(-2, 0)
        self.ids = list(terms)
        self.terms = list(vocabulary)
        self.of = [np.array(sorted(vocabulary[t] for t in found), np.int64) for found in terms.values()]
        frequency = (counts.get(k, 0) for k in range(len(vocabulary)))
        self.weights = np.array([math.floor(1000 * math.log((2 * self.n + 2) / (2 * df + 1))) for df in frequency], np.int64)
        # Terms that no document holds add nothing.
        held = np.array([counts.get(k, 0) > 0 for k in range(len(vocabulary))], bool)
        self.live = [t[held[t]] for t in self.of]
        self.hashes = np.array([xxhash.xxh3_64_intdigest(t) for t in self.terms], np.uint64)

    def lengths_weighed(self, lengths: np.ndarray) -> np.ndarray:
        return 100 - 50 + (50 * lengths * self.n) // max(self.total, 1)


def _bounds(items: Items, block: dict) -> np.ndarray:
    """(items, documents) upper bounds of the scores in a block."""
    width, lengths = block["width"], np.array(block["lengths"], np.int64)
    slices = np.frombuffer(block["slices"], np.uint8).reshape(width, -1)
    # So many bytes of each bitmap at a time that terms times documents stays bounded.
    step = max(1, CELLS // 8 // max(len(items.terms), 1))
    parts = [_part_bounds(items, slices[:, c : c + step], width, lengths[8 * c : 8 * (c + step)]) for c in range(0, slices.shape[1], step)]
    return np.concatenate(parts, axis=1)


def _part_bounds(items: Items, slices: np.ndarray, width: int, lengths: np.ndarray) -> np.ndarray:
    n, terms = len(lengths), np.arange(len(items.terms))
    most = np.zeros((len(terms), n), np.int64)  # the largest tf that the signatures allow
    for level, least in enumerate(LEVELS):
        spots = positions(items.hashes[terms], level, width)
        maybe = slices[spots[:, 0]]
        for k in range(1, HASHES):
            maybe &= slices[spots[:, k]]
        here = maybe.any(axis=1)
        terms, maybe = terms[here], maybe[here]
        if not len(terms):
            break
        # A document that lacks a level lacks all above.
        present = np.unpackbits(maybe, axis=1, count=n, bitorder="little").astype(bool) & (most[terms] == least - 1)
        most[terms] = np.where(present, LEVELS[level + 1] - 1 if level + 1 < len(LEVELS) else lengths, most[terms])
    used = np.flatnonzero(most.any(axis=1))
    place = np.full(len(items.terms), -1)
    place[used] = np.arange(len(used))
    tf = np.minimum(most[used], lengths)
    added = items.weights[used, None] * ((1_000_000_000 * tf) // (1000 * tf + 20 * items.lengths_weighed(lengths)))
    out = np.zeros((len(items.ids), n), np.int64)
    for i, held in enumerate(items.live):
        rows = place[held]
        out[i] = added[rows[rows >= 0]].sum(axis=0)
    return out


_FOUND = pa.schema([("item", pa.int64()), ("doc", pa.int64()), ("score", pa.int64())])
_FOUND_DDL = "item long, doc long, score long"


def _found(item, doc, score) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"item": item, "doc": doc, "score": score}, schema=_FOUND)


def _highest_bounds(items: Items, k: int):
    """Per task and item, the k documents with the highest bounds."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[tuple] = [(np.zeros(0, np.int64), []) for _ in items.ids]
        for batch in batches:
            for i in range(batch.num_rows):
                block = batch.slice(i, 1).to_pylist()[0]
                bounds = _bounds(items, block)
                for j, row in enumerate(bounds):
                    top = np.argpartition(-row, k)[:k] if len(row) > k else np.arange(len(row))
                    top = top[row[top] > (best[j][0].min() if len(best[j][0]) >= k else 0)]
                    if len(top):
                        score = np.concatenate([best[j][0], row[top]])
                        docs = best[j][1] + [block["ids"][d] for d in top]
                        keep = np.argsort(-score, kind="stable")[:k]
                        best[j] = (score[keep], [docs[d] for d in keep])
        for j, (score, docs) in enumerate(best):
            if docs:
                yield _found([j] * len(docs), docs, score.tolist())

    return run, _FOUND_DDL


def _above_floors(items: Items, floors: np.ndarray):
    """All documents whose bound reaches the floor of an item."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                block = batch.slice(i, 1).to_pylist()[0]
                bounds = _bounds(items, block)
                item, doc = np.nonzero((bounds >= floors[:, None]) & (bounds > 0))
                yield _found(item, [block["ids"][d] for d in doc], bounds[item, doc])

    return run, _FOUND_DDL


def _exact(items: Items):
    """Exact scores of (doc, body, items) rows, those above 0."""
    number = {t: k for k, t in enumerate(items.terms)}

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for doc, body, wanted in _texts(batches, "doc", "body", "items"):
            terms = terms_of(body)
            counts = Counter(t for t in terms if t in number)
            m = 100 - 50 + (50 * len(terms) * items.n) // max(items.total, 1)
            added = {number[t]: int(items.weights[number[t]]) * ((1_000_000_000 * tf) // (1000 * tf + 20 * m)) for t, tf in counts.items()}
            scores = [(j, sum(added.get(k, 0) for k in items.of[j].tolist())) for j in wanted]
            scores = [(j, s) for j, s in scores if s > 0]
            if scores:
                yield _found([j for j, _ in scores], [doc] * len(scores), [s for _, s in scores])

    return run, _FOUND_DDL


def _ranked(scores: DataFrame, k: int) -> DataFrame:
    place = "row_number() over (partition by item order by score desc, doc nulls last) as rank"
    return scores.selectExpr("*", place).where(f"rank <= {int(k)}")


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 50,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    max_items: int = 2000,
    seeds: int = 2,
) -> DataFrame:
    """The k best documents of each item: (item id, rank, doc id, score).

    ``max_items`` bounds the items that are searched together, and with them what goes to each
    task. ``seeds`` times k documents per item are scored to find its floor; it changes no result.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "search")
    bodies = _bodies(docs, id_column, text_column)
    index = scratch.keep(build_index(docs, id_column, text_column))
    asked = items.select(F.col(item_column).cast("long").alias("item"), F.col(item_text_column).cast("string").cast("binary").alias("body")).where("body is not null")
    results = []
    for ids in _blocks(asked, max_items):
        rows = asked.where(ids).collect()  # a block of items
        terms: dict = {}
        for row in rows:
            terms.setdefault(row["item"], set()).update(terms_of(bytes(row["body"])))
        terms = {i: t for i, t in terms.items() if t}
        vocabulary = {t: n for n, t in enumerate(sorted(set().union(*terms.values())))} if terms else {}
        run, ddl = _statistics(vocabulary)
        counts = {r["key"]: r["n"] for r in bodies.select("body").mapInArrow(run, ddl).groupBy("key").agg(F.sum("n").alias("n")).collect()}
        block = Items(terms, counts, vocabulary)

        def exact(candidates: DataFrame, block: Items = block) -> DataFrame:
            pairs = scratch.keep(candidates.select("doc", "item").distinct())
            wanted = pairs.groupBy(F.col("doc").alias("wanted")).agg(F.collect_list("item").alias("items"))
            if pairs.count() <= BROADCAST_PAIRS:
                wanted = F.broadcast(wanted)
            return bodies.join(wanted, F.expr("doc <=> wanted")).select("doc", "body", "items").mapInArrow(*_exact(block))

        highest = index.mapInArrow(*_highest_bounds(block, k * seeds))
        seeded = highest.selectExpr("*", "row_number() over (partition by item order by score desc, doc) as place").where(f"place <= {k * seeds}")
        floors = np.zeros(len(block.ids), np.int64)
        for row in _ranked(exact(seeded), k).where(f"rank = {int(k)}").collect():  # a row per item
            floors[row["item"]] = row["score"]
        best = _ranked(exact(index.mapInArrow(*_above_floors(block, floors))), k)
        names = spark.createDataFrame(list(enumerate(block.ids)), "number long, item_id long")
        results.append(
            best.join(F.broadcast(names), F.expr("item = number")).select(
                F.col("item_id").alias(item_column), F.col("rank").cast("int").alias("rank"), F.col("doc").alias(id_column), "score"
            )
        )
    if not results:
        return spark.createDataFrame([], f"{item_column} long, rank int, {id_column} long, score long")
    out = results[0]
    for more in results[1:]:
        out = out.unionByName(more)
    return out


def _blocks(asked: DataFrame, most: int) -> Iterator:
    """Conditions that cut the items into blocks of at most ``most`` ids, by ranges of ids."""
    ids = asked.select("item").distinct()
    after = None
    if ids.where("item is null").head(1):
        yield F.col("item").isNull()
    while True:
        rest = ids.where("item is not null")
        if after is not None:
            rest = rest.where(F.col("item") > F.lit(after))
        block = [r["item"] for r in rest.orderBy("item").limit(most).collect()]
        if not block:
            return
        yield F.col("item").between(block[0], block[-1])
        after = block[-1]

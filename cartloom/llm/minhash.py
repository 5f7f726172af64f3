"""Near duplicates by MinHash with tensored banding, and exact verification.

A text's set holds its distinct word shingles, lower-cased in A-Z. Two small collections of half
keys are computed per distinct set, each half key from a few minhashes. A table key is a pair of
one half key of either collection, so ``bands ** 2`` tables need only ``2 * bands * rows``
minhashes. Half keys that no other set has cannot take part in a shared table key, so the pairs
are formed for the others only.

Sets that share a table key are candidates. Stars per table key tie candidates together, and
within each tied cluster every pair is verified on the full sets. Large clusters are cut into
chunks of bounded size and the chunks verified pairwise, each task passing on a spanning forest
of the links it finds: no pairs are emitted and no group grows without bound. With the defaults
a link at a similarity of exactly 0.75 shares a table key with probability 0.99998; verification
of whole clusters finds even more.

Copies of one set are a class and take part once. Classes, clusters and components that hold more
than a thousandth of the rows are found by a sketch and dealt over many tasks in the joins. Edge cases: a text without words has an empty
set, which links with nothing; fewer words than a shingle form one shingle; repeated rows belong
to one class; a null id counts as larger than any other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartloom.llm.components import connected_components
from cartloom.llm.tables import Scratch, returning_memory
from cartloom.operators.skew import hot_keys, salted_join, with_row_salt

U = np.uint64
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 2**64)
#: Bytes of text that are hashed at a time; a longer text is a piece of its own.
PIECE = 1 << 20


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(33))) * U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> U(33))) * U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U(33))


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = max(PIECE, n) + 1
    if size not in _POWERS:
        _POWERS.clear()
        table = []
        for b in (BASE, INVERSE):
            p = np.full(size, U(b))
            p[0] = 1
            table.append(np.multiply.accumulate(p))
        _POWERS[size] = tuple(table)
    return _POWERS[size]


def shingles(data: np.ndarray, ends: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct shingles of texts that lie in one byte array, sorted by text, and each one's text."""
    lower = np.where((data >= 65) & (data <= 90), data + 32, data)
    inner = np.concatenate([[False], ~((data == 32) | ((data >= 9) & (data <= 13))), [False]])
    cuts = np.zeros(len(data) + 1, bool)
    cuts[ends] = True  # a text's end parts words
    starts = np.flatnonzero(inner[1:] & (~inner[:-1] | cuts))
    starts = starts[starts < len(data)]
    stops = np.flatnonzero(inner[:-1] & (~inner[1:] | cuts))
    if not len(starts):
        return np.empty(0, U), np.empty(0, np.int64)
    power, inverse = _powers(len(data))
    sums = np.concatenate([[U(0)], np.cumsum((lower.astype(U) + U(1)) * power[: len(data)])])
    words = _mix((sums[stops] - sums[starts]) * inverse[starts] ^ (stops - starts).astype(U))
    text = np.searchsorted(ends, starts, side="right")
    # A shingle begins at each word that has enough followers in its text, or at a short text's first word.
    last = np.searchsorted(text, text, side="right")
    place = np.arange(len(words))
    first = np.searchsorted(text, text, side="left")
    short = last - first < width
    begin = np.flatnonzero((place + width <= last) | (short & (place == first)))
    hashes = np.zeros(len(begin), U)
    for i in range(width):
        at = begin + i
        ok = at < last[begin]
        hashes = np.where(ok, _mix(hashes * U(31) + words[np.minimum(at, len(words) - 1)] + U(i)), hashes)
    owner = text[begin]
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    return hashes[new], owner[new]


def _pieces(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows (from, to) with their bytes and the ends of the texts in them."""
    column = column.cast(pa.large_string()).cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.empty(0, np.uint8)
    i = 0
    while i < len(column):
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + PIECE, side="right")) - 1)
        yield i, j, data[offsets[i] : offsets[j]], offsets[i + 1 : j + 1] - offsets[i]
        i = j


class Sketch:
    """Half keys and set hashes; everything follows from the parameters."""

    def __init__(self, width: int, bands: int, rows: int, seed: int):
        random = np.random.default_rng(seed)
        n = 2 * bands * rows
        self.width, self.bands, self.rows = width, bands, rows
        self.factors = random.integers(0, 2**32, n, dtype=np.uint32) | np.uint32(1)
        self.terms = random.integers(0, 2**32, n, dtype=np.uint32)

    def classes(self, column: pa.Array) -> Iterator[tuple[np.ndarray, ...]]:
        """Per run of rows: set size, class, and the shingles with their rows."""
        for i, j, data, ends in _pieces(column):
            hashes, owner = shingles(data, ends, self.width)
            sizes = np.bincount(owner, minlength=j - i)
            sums = np.concatenate([[U(0)], np.cumsum(_mix(hashes + U(0x5851F42D4C957F2D)))])
            stop = np.cumsum(sizes)
            label = _mix((sums[stop] - sums[stop - sizes]) ^ sizes.astype(U))
            yield i, j, sizes, label.view(np.int64), hashes, stop - sizes

    def half_keys(self, hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """A row of ``2 * bands`` half keys per set; no set is empty."""
        least = np.empty((len(self.factors), len(starts)), np.uint32)
        short = (hashes >> U(32)).astype(np.uint32)
        step = 1 << 15
        # Sets are taken by runs whose shingles stay in the processor's cache.
        at = 0
        while at < len(starts):
            to = max(at + 1, int(np.searchsorted(starts, starts[at] + step, side="right")) - 1)
            to = len(starts) if starts[-1] < starts[at] + step else to
            low, high = starts[at], starts[to] if to < len(starts) else len(short)
            part, own = short[low:high], starts[at:to] - low
            for t, (factor, term) in enumerate(zip(self.factors, self.terms, strict=True)):
                least[t, at:to] = np.minimum.reduceat(part * factor + term, own)
            at = to
        keys = np.zeros((2 * self.bands, len(starts)), U)
        for r in range(self.rows):
            keys = _mix(keys * U(31) + least[r :: self.rows].astype(U) + U(r + 1))
        return _mix(keys + np.arange(2 * self.bands, dtype=U)[:, None]).T.view(np.int64)


def _sketched(sketch: Sketch):
    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            for i, j, sizes, label, hashes, starts in sketch.classes(batch.column(1)):
                full = sizes > 0
                keys = sketch.half_keys(hashes, starts[full]) if full.any() else np.empty((0, 2 * sketch.bands), np.int64)
                offsets = np.concatenate([[0], np.cumsum(np.where(full, 2 * sketch.bands, 0))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(i, j - i),
                        pa.array(sizes.astype(np.int64)),
                        pa.array(label, mask=~full),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.ravel())),
                    ],
                    ["doc_id", "n_shingles", "class", "keys"],
                )

    return run


def _full_sets(sketch: Sketch):
    def run(batches):
        for batch in batches:
            for i, j, sizes, label, hashes, starts in sketch.classes(batch.column(0)):
                sets = [hashes[s : s + n].tobytes() for s, n in zip(starts, sizes, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(label, mask=sizes == 0), pa.array(sets, pa.binary())], ["class", "set"]
                )

    return run


def _links(left: list[np.ndarray], right: list[np.ndarray] | None, percent: int) -> np.ndarray:
    """A matrix of links between sets; ``right`` None: within ``left``."""
    sides = [left] if right is None else [left, right]
    ids, counts = np.unique(np.concatenate([s for side in sides for s in side]), return_counts=True)
    shared = ids[counts > 1]
    other = left if right is None else right
    common = np.zeros((len(left), len(other)), np.float32)
    width = 4096
    places = [[np.searchsorted(shared, s[np.isin(s, shared, assume_unique=True)]) for s in side] for side in sides]
    for low in range(0, len(shared), width):
        matrices = []
        for side in places:
            m = np.zeros((len(side), min(width, len(shared) - low)), np.float32)
            for i, at in enumerate(side):
                a, b = np.searchsorted(at, [low, low + width])
                m[i, at[a:b] - low] = 1
            matrices.append(m)
        common += matrices[0] @ matrices[-1].T
    sizes = [np.array([len(s) for s in side], np.float64) for side in (left, other)]
    union = sizes[0][:, None] + sizes[1][None, :] - common
    return 100 * common.astype(np.float64) >= percent * union


def _forest(links: np.ndarray, left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """Edges that span the linked nodes."""
    parent: dict[int, int] = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    edges = []
    for i in range(len(left)):
        for b in right[links[i]]:
            x, y = find(int(left[i])), find(int(b))
            if x != y:
                parent[x] = y
                edges.append((int(left[i]), int(b)))
    return edges


def _verify(percent: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        low, high = rows["low"].iat[0], rows["high"].iat[0]
        sides = []
        for chunk in dict.fromkeys((low, high)):
            own = rows[rows["chunk"] == chunk]
            sides.append((own["class"].to_numpy(), [np.frombuffer(s, U) for s in own["set"]]))
        if not all(len(s[0]) for s in sides) or (len(sides) == 1 and len(sides[0][0]) < 2):
            return pd.DataFrame({"a": [], "b": []}, dtype="int64")
        links = _links(sides[0][1], sides[1][1] if len(sides) > 1 else None, percent)
        return pd.DataFrame(_forest(links, sides[0][0], sides[-1][0]), columns=["a", "b"], dtype="int64")

    return run


def _spread_join(rows: DataFrame, right: DataFrame, key: str, how: str) -> DataFrame:
    """A join of a scanned table in which the rows of a hot key, null included, go to many tasks."""
    return salted_join(with_row_salt(rows), right, key, how, hot_keys(rows, [key])[key])


def near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    width: int = 5,
    percent: int = 75,
    bands: int = 30,
    rows: int = 4,
    seed: int = 7,
    chunk_sets: int = 512,
    chunk_shingles: int = 1_000_000,
) -> DataFrame:
    """(id, n_shingles, component_id, kept), one row per document row.

    ``component_id`` is the smallest id reachable over links, its own included; ``kept`` says that
    it is the row's own id. ``chunk_sets`` and ``chunk_shingles`` bound a verification task.
    """
    scratch, sketch = Scratch(docs.sparkSession, "minhash"), Sketch(width, bands, rows, seed)
    texts = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("txt")
    )
    sketched = scratch.keep(texts.mapInArrow(returning_memory(_sketched(sketch)), "doc_id long, n_shingles long, class long, keys array<long>"))
    plain = sketched.select("doc_id", "n_shingles", "class")
    reps = plain.where("class is not null").groupBy("class").agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"))

    # Half keys that two sets share, and their pairs.
    single = sketched.where("class is not null").dropDuplicates(["class"])
    halves = single.select("class", F.posexplode("keys").alias("place", "key"))
    shared = halves.groupBy("key").count().where("count > 1").select("key")
    sides = halves.join(shared, "key").groupBy("class").agg(
        F.expr(f"collect_list(key) filter (where place < {bands})").alias("firsts"),
        F.expr(f"collect_list(key) filter (where place >= {bands})").alias("seconds"),
    )
    sides = scratch.keep(sides.where("size(firsts) > 0 and size(seconds) > 0"))
    tables = sides.select("class", "seconds", F.explode("firsts").alias("first")).select(
        "class", F.expr("explode(transform(seconds, s -> xxhash64(first, s)))").alias("key")
    )

    # Candidates of a table key are tied to its smallest class; clusters are what hangs together.
    least = tables.groupBy("key").agg(F.min("class").alias("a"), F.count("*").alias("n")).where("n > 1").select("key", "a")
    ties = tables.join(least, "key").select("a", F.col("class").alias("b")).where("a <> b")
    clusters = connected_components(ties, scratch)

    # Chunks of each cluster, and every pair of chunks.
    clusters = clusters.select(F.col("node").alias("class"), F.col("root").alias("cluster"))
    weights = clusters.join(reps, "class").groupBy("cluster").agg(
        F.expr(f"cast(ceil(greatest(count(*) / {chunk_sets}, sum(n) / {chunk_shingles})) as int)").alias("chunks")
    )
    members = _spread_join(clusters, weights, "cluster", "inner").join(reps, "class")
    members = scratch.keep(
        members.select("class", "rep", "cluster", "chunks", F.expr("cast(pmod(xxhash64(class), chunks) as int)").alias("chunk"))
    )
    wanted = members.select(F.col("rep").alias("doc_id")).distinct()
    again = texts.join(wanted, texts["doc_id"].eqNullSafe(wanted["doc_id"]), "left_semi").select("txt")
    sets = again.mapInArrow(returning_memory(_full_sets(sketch)), "class long, set binary").dropDuplicates(["class"])
    dealt = sets.join(members, "class").select(
        "class", "set", "cluster", "chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other")
    )
    dealt = dealt.withColumns({"low": F.least("chunk", "other"), "high": F.greatest("chunk", "other")})
    links = dealt.groupBy("cluster", "low", "high").applyInPandas(_verify(percent), "a long, b long")
    linked = connected_components(links, scratch)

    # The smallest id of each component, back to all rows by class.
    linked = linked.withColumnRenamed("node", "class")
    smallest = linked.join(reps, "class").groupBy("root").agg(F.min("rep").alias("component_id"))
    found = _spread_join(linked, smallest, "root", "inner").select("class", "component_id")
    by_class = reps.join(found, "class", "left").select("class", F.coalesce("component_id", "rep").alias("component_id"))
    return _spread_join(plain, by_class, "class", "left").select(
        F.col("doc_id").alias(id_column),
        "n_shingles",
        F.coalesce("component_id", "doc_id").alias("component_id"),
        F.expr("doc_id <=> coalesce(component_id, doc_id)").alias("kept"),
    )

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest

from cartloom.llm import queries, search

DOCS = "doc_id long, text string"
ITEMS = "item_id long, text string"


def terms_of(text):
    """Character by character, over code points."""
    out, held = [], ""
    for c in (text or "") + " ":
        c = c.lower() if "A" <= c <= "Z" else c
        if c.isdigit() and c < "\x80" or "a" <= c <= "z" or c >= "\x80":
            held += c
        elif held:
            out.append(held)
            held = ""
    return out


def brute_force(docs, items, k=50):
    held = [(d, terms_of(t)) for d, t in docs]
    held = [(d, t) for d, t in held if t]
    n, total = len(held), sum(len(t) for _, t in held)
    df = Counter(t for _, terms in held for t in set(terms))
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(terms_of(text))
    out = []
    for item, terms in wanted.items():
        found = []
        for doc, have in held:
            tf, m = Counter(have), 100 - 50 + (50 * len(have) * n) // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * tf[t]) // (1000 * tf[t] + 20 * m)) for t in terms if tf[t])
            if score > 0:
                found.append((-score, doc is None, doc or 0, doc))
        for rank, (score, _, _, doc) in enumerate(sorted(found)[:k], 1):
            out.append((item, rank, doc, -score))
    return sorted(out, key=str)


def words(generator, n, vocabulary=400):
    return " ".join(f"w{int(generator.paretovariate(0.7)) % vocabulary}" for _ in range(n))


def data(seed, n=300):
    generator = random.Random(seed)
    docs = [(i, words(generator, generator.choice([1, 5, 40, 200, 900]))) for i in range(n)]
    docs += [(None, "w3 w4"), (5, None), (6, ""), (7, "!!! --"), (8, "Ünï cödé W3 w3\x00w5 日本"), (9, docs[9][1]), (9, docs[9][1])]
    docs += [(1000 + i, docs[2][1]) for i in range(60)]  # more ties than ranks
    items = [(i, words(generator, 25)) for i in range(6)] + [(50, docs[2][1]), (51, "nowhere at all"), (52, None), (53, "?"), (0, "w399"), (None, "w3 ünï")]
    return docs, items


def found(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


@pytest.mark.parametrize("k", [50, 3])
def test_search_equals_brute_force(spark, k):
    docs, items = data(k)
    got = search.search(spark.createDataFrame(docs, DOCS).repartition(4), spark.createDataFrame(items, ITEMS), k)
    assert found(got) == brute_force(docs, items, k)


def test_blocks_of_items_and_shuffled_candidates(spark, monkeypatch):
    docs, items = data(3, 120)
    monkeypatch.setattr(search, "BROADCAST_PAIRS", 0)
    got = search.search(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), 10, max_items=3)
    assert found(got) == brute_force(docs, items, 10)


def _blocks(docs):
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"doc": [d for d, _ in docs], "body": [t.encode() for _, t in docs]})
    return [r for b in search._index([batch]) for r in b.to_pylist()]


def _items(docs, items):
    terms = {i: {t.encode() for t in terms_of(x)} for i, x in items}
    vocabulary = {t: n for n, t in enumerate(sorted(set().union(*terms.values())))}
    held = [terms_of(t) for _, t in docs]
    df = Counter(t.encode() for h in held for t in set(h))
    counts = {-1: len(held), -2: sum(map(len, held)), **{n: df[t] for t, n in vocabulary.items() if df[t]}}
    return search.Items(terms, counts, vocabulary)


def test_bounds_are_never_below_scores_and_exclude_most():
    generator = random.Random(8)
    docs = [(i, words(generator, generator.choice([20, 300, 2000]), 3000)) for i in range(1500)]
    items = [(i, words(generator, 30, 3000)) for i in range(5)]
    exact = {(i, d): s for i, _, d, s in brute_force(docs, items, 10**6)}
    block = _items(docs, items)
    near = []
    for row in _blocks(docs):
        bounds = search._bounds(block, row)
        for j, item in enumerate(block.ids):
            for doc, bound in zip(row["ids"], bounds[j]):
                score = exact.get((item, doc), 0)
                assert bound >= score
                near.append((int(bound) - score) / max(score, 1) if score else 0.0)
    # The levels bound repeats closely, so few documents are scored in vain.
    assert np.median(near) < 0.15
    floors = {i: sorted((s for (j, _), s in exact.items() if j == i), reverse=True)[49] for i in block.ids}
    left = sum((search._bounds(block, row)[j] >= floors[i]).sum() for row in _blocks(docs) for j, i in enumerate(block.ids))
    assert left < 0.2 * len(docs) * len(items)


def test_parts_of_a_block_have_the_bounds_of_the_whole(monkeypatch):
    generator = random.Random(9)
    docs = [(i, words(generator, 60)) for i in range(333)]
    block, rows = _items(docs, [(0, "w1 w2 w3 w50")]), _blocks(docs)
    whole = [search._bounds(block, r) for r in rows]
    monkeypatch.setattr(search, "CELLS", 40)
    assert all((search._bounds(block, r) == w).all() for r, w in zip(rows, whole))


def test_a_very_long_text_and_a_hot_term(spark):
    generator = random.Random(10)
    docs = [(0, "w1 " * 300_000 + "rare")] + [(i, "w1 w2") for i in range(1, 200)] + [(500, words(generator, 60_000, 50_000))]
    items = [(1, "w1 rare"), (2, "w1"), (3, "w2 w49999 w7")]
    got = search.search(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS))
    assert found(got) == brute_force(docs, items)


def test_empty_tables_and_other_columns(spark):
    none, one = spark.createDataFrame([], DOCS), spark.createDataFrame([(1, "word")], DOCS)
    asked = spark.createDataFrame([(1, "word")], ITEMS)
    assert search.search(none, asked).count() == 0
    assert search.search(one, spark.createDataFrame([], ITEMS)).columns == ["item_id", "rank", "doc_id", "score"]
    wide = spark.createDataFrame([(1, "word", 2, b"x", 3, 4)], DOCS + ", doc int, body binary, item int, rank int")
    clash = spark.createDataFrame([(1, "word", 2, 3)], ITEMS + ", doc_id int, score int")
    assert found(search.search(wide, clash)) == brute_force([(1, "word")], [(1, "word")])


def test_query(spark, tmp_path):
    docs, items = data(4, 80)
    spark.createDataFrame(docs, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, ITEMS).write.parquet(f"{tmp_path}/benchmark.parquet")
    assert found(queries.op12_search(spark, str(tmp_path))) == brute_force(docs, items)

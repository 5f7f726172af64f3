from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cartloom.llm import language, queries
from cartloom.llm.language import STRIDE, WIDTHS, WINDOW, ByteNetwork, cut_windows
from cartloom.llm.tables import bounded_sample

SCHEMA = "doc_id long, text string, lang string"
SYLLABLES = {"xx": ["ba", "do", "ki", "lu"], "yy": ["ßü", "grü", "schä", "tö"], "zz": ["quo", "ñi", "ció", "lla"]}


def text(lang, n, generator):
    return " ".join("".join(generator.choices(SYLLABLES[lang], k=generator.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    generator = random.Random(4)
    return [(i, text(lang, generator.choice([3, 20, 200]), generator), lang) for i in range(700) for lang in [generator.choice(["xx", "xx", "xx", "yy", "zz"])]]


@pytest.fixture(scope="module")
def network(spark, corpus):
    return language.train_language(spark.createDataFrame(corpus, SCHEMA).where(~language.held_out()))


def test_gradients_equal_differences():
    generator = np.random.default_rng(1)
    net = ByteNetwork(["a", "b", "c"])
    net.weights = {k: v.astype(np.float64) for k, v in net.weights.items()}
    x, y, weight = generator.integers(0, 256, (7, 20)), generator.integers(0, 3, 7), generator.random(7) + 0.5

    def loss():
        return -(net.log_probabilities(x)[np.arange(7), y] * weight).sum() / weight.sum()

    found = net.gradients(x, y, weight)
    for name, g in found.items():
        spots = np.argsort(-abs(g.ravel()))[:5]
        for spot in spots:
            cell = net.weights[name].reshape(-1)
            before = cell[spot]
            cell[spot] = before + 1e-5
            high = loss()
            cell[spot] = before - 1e-5
            low = loss()
            cell[spot] = before
            assert g.ravel()[spot] == pytest.approx((high - low) / 2e-5, rel=2e-2, abs=1e-6), name


@pytest.mark.parametrize("n", [0, 1, 2, WINDOW - 1, WINDOW, WINDOW + 1, STRIDE, 2 * STRIDE + 4, 2 * STRIDE + 5, 10_007])
def test_windows_show_each_place_once(n):
    """Every run of bytes as long as the widest filter lies in exactly one window."""
    body = bytes(random.Random(n).choices(range(1, 256), k=n))
    windows = cut_windows(body)
    width = max(WIDTHS)
    runs = [bytes(w[i : i + width]) for w in windows for i in range(WINDOW - width + 1)]
    assert [r for r in runs if 0 not in r] == [body[i : i + width] for i in range(n - width + 1)]
    assert windows.shape[1] == WINDOW and bytes(windows[0][: min(n, WINDOW)]) == body[:WINDOW]


def test_held_out_accuracy(spark, corpus, network):
    df = spark.createDataFrame(corpus, SCHEMA)
    found = language.predict_language(df, network).join(df, "doc_id").where("held_out").collect()
    assert 150 < len(found) < 320
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in found)
    assert np.mean([r.lang_pred == r.lang for r in found]) > 0.97


def test_batches_equal_one_by_one(spark, corpus, network):
    """Texts judged together, and long ones in parts, get what the network says of them alone."""
    generator = random.Random(2)
    texts = [t for _, t, _ in corpus[:40]] + [text("yy", 150_000, generator), text("zz", 9, generator)]
    df = spark.createDataFrame([(i, t, None) for i, t in enumerate(texts)], SCHEMA).coalesce(1)
    for r in language.predict_language(df, network).collect():
        logs = network.log_probabilities(cut_windows(texts[r.doc_id].encode())).astype(float)
        best = logs.sum(axis=0).argmax()
        assert r.lang_pred == network.classes[best]
        assert r.score == pytest.approx(np.exp(logs[:, best]).mean(), abs=1e-4)


def test_only_learnable_rows_are_read(spark, corpus):
    """Held-out rows and rows without label or letter change nothing."""
    learnable = [r for r in corpus if zlib.crc32(str(r[0]).encode()) % 3 != 1]
    noise = [(r[0], "1 2 3 !", "qq") for r in learnable[:9]] + [(r[0], r[1], None) for r in learnable[:50]] + [(1, None, "qq")]
    held = [(r[0], text("yy", 20, random.Random(1)), "xx") for r in corpus if zlib.crc32(str(r[0]).encode()) % 3 == 1]
    one = language.train_language(spark.createDataFrame(learnable, SCHEMA))
    other = language.train_language(spark.createDataFrame(learnable + noise + held, SCHEMA).where(~language.held_out()))
    assert one.classes == other.classes
    assert all((one.weights[k] == other.weights[k]).all() for k in one.weights)


def test_texts_without_letters_and_odd_rows(spark, network):
    odd = [(1, None, "xx"), (2, "", "xx"), (3, "12 - 5!\n", "xx"), (None, "ba do ki lu ba", None), (4, "ß", "yy"), (5, "5 б", None), (4, "ß", "yy")]
    found = {(r.doc_id, r.lang_pred == "und"): r for r in language.predict_language(spark.createDataFrame(odd, SCHEMA), network).collect()}
    assert set(found) == {(1, True), (2, True), (3, True), (None, False), (4, False), (5, False)}
    assert found[1, True].score == 0 and found[None, False].held_out is False
    assert all(0 <= r.score <= 1 for r in found.values())


def test_empty_tables_and_other_columns(spark, network):
    none = spark.createDataFrame([], SCHEMA)
    assert language.train_language(none) is None
    assert language.predict_language(none, network).count() == 0
    unlabelled = spark.createDataFrame([(2, "ba do", None)], SCHEMA)
    assert [tuple(r) for r in language.predict_language(unlabelled, None).collect()] == [(2, True, "und", 0.0)]
    wide = spark.createDataFrame([(2, "ba do ki lu", 1, b"x", "k", "h")], "doc_id long, text string, id int, body binary, known string, held string")
    got = language.predict_language(wide, network)
    assert got.columns == ["doc_id", "held_out", "lang_pred", "score"] and got.first().lang_pred == "xx"


def test_query(spark, corpus, tmp_path):
    spark.createDataFrame(corpus, SCHEMA).withColumn("source", F.lit("s")).write.parquet(f"{tmp_path}/documents.parquet")
    assert queries.op11_language(spark, str(tmp_path)).count() == len(corpus)


def test_a_bounded_sample(spark):
    few = spark.range(90)
    assert bounded_sample(few, 100, "id").count() == 90
    many = spark.range(20_000, numPartitions=7)
    sizes = [bounded_sample(many, n, "id").count() for n in (100, 1000, 15_000)]
    assert all(0.8 * n < size <= n for n, size in zip((100, 1000, 15_000), sizes))
    one, other = (bounded_sample(many.repartition(k), 500, "id").orderBy("id").collect() for k in (3, 9))
    assert one == other
    # A key with a third of all rows is passed over as a whole, never cut.
    hot = many.unionByName(spark.range(10_000).selectExpr("-1L as id"))
    assert 0 < bounded_sample(hot, 300, "id").count() <= 300

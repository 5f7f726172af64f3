"""The pipeline's stages on their own input, and the whole."""

from __future__ import annotations

import corpus_pipeline
import pytest

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    base, docs, out = tmp_path_factory.mktemp("stages"), spark.read.parquet(f"{FOLDER}/documents.parquet"), [("input", None)]
    out = [("input", docs)]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, FOLDER).write.parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
        out.append((name, docs))
    return dict(out)


def test_stages_keep_the_columns_of_documents(stages):
    columns = stages["input"].dtypes
    for name in ("toxicity", "near_duplicates", "personal_data", "mixing"):
        assert stages[name].dtypes == columns


def test_toxic_documents_go_and_others_stay(spark, stages):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    kept = stages["toxicity"].join(labels, "doc_id").groupBy("toxic").count().collect()
    all_ = {r["toxic"]: r["count"] for r in labels.groupBy("toxic").count().collect()}
    left = {r["toxic"]: r["count"] for r in kept}
    assert left.get(1, 0) <= 0.1 * all_[1] and left[0] >= 0.99 * all_[0]


def test_one_of_each_group_stays(spark, stages):
    from cartloom.llm.minhash import near_duplicates

    again = near_duplicates(stages["near_duplicates"]).where("not kept").count()
    assert again == 0 and stages["near_duplicates"].count() < stages["toxicity"].count()


def test_personal_data_is_masked(stages):
    before = stages["near_duplicates"].where("text like '%@mail%'").count()
    after = stages["personal_data"].where("text like '%@mail%'").count()
    assert before > 0 and after == 0
    assert stages["personal_data"].count() == stages["near_duplicates"].count()


def test_mixing_keeps_good_documents(spark, stages):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    good = stages["personal_data"].join(labels.where("quality = 1"), "doc_id").count()
    left = stages["mixing"].join(labels.where("quality = 1"), "doc_id").count()
    assert left >= 0.98 * good and stages["mixing"].count() < stages["personal_data"].count()


def test_every_document_is_packed(stages):
    assert stages["packing"].select("doc_id").distinct().count() == stages["mixing"].select("doc_id").distinct().count()


@pytest.mark.parametrize("stage", ["toxicity", "near_duplicates", "personal_data", "packing"])
def test_stages_bound_their_arrow_batches(spark, monkeypatch, stage):
    name, seen = "spark.sql.execution.arrow.maxRecordsPerBatch", []
    before = spark.conf.get(name)
    modules = {"toxicity": corpus_pipeline.toxicity, "near_duplicates": corpus_pipeline.minhash, "personal_data": corpus_pipeline.pii, "packing": corpus_pipeline.packing}

    class Reached(Exception):
        pass

    def operator(*args, **options):
        seen.append(int(spark.conf.get(name)))
        raise Reached

    called = {"toxicity": "grade_toxicity", "near_duplicates": "near_duplicates", "personal_data": "find_personal_data", "packing": "pack_documents"}
    monkeypatch.setattr(modules[stage], called[stage], operator)
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    try:
        for given in ("10000", "7", "0"):
            spark.conf.set(name, given)
            with pytest.raises(Reached):
                dict(corpus_pipeline.STAGES)[stage](spark, docs, "/root/testdata/sf0.001")
    finally:
        spark.conf.set(name, before)
    assert seen == [corpus_pipeline.BATCH, 7, corpus_pipeline.BATCH]


@pytest.mark.parametrize("stage", list(dict(corpus_pipeline.STAGES)))
def test_stages_bound_the_batches_of_the_reader(spark, monkeypatch, stage):
    name, seen = "spark.sql.parquet.columnarReaderBatchSize", []
    both = [name, "spark.sql.execution.arrow.maxRecordsPerBatch"]
    before = {x: spark.conf.get(x) for x in both}
    operators = {
        "toxicity": (corpus_pipeline.toxicity, "grade_toxicity"),
        "near_duplicates": (corpus_pipeline.minhash, "near_duplicates"),
        "personal_data": (corpus_pipeline.pii, "find_personal_data"),
        "mixing": (corpus_pipeline.mixing, "mix_sources"),
        "packing": (corpus_pipeline.packing, "pack_documents"),
    }

    class Reached(Exception):
        pass

    def operator(*args, **options):
        seen.append(int(spark.conf.get(name)))
        raise Reached

    monkeypatch.setattr(*operators[stage], operator)
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    try:
        for given in ("4096", "7"):
            spark.conf.set(name, given)
            with pytest.raises(Reached):
                dict(corpus_pipeline.STAGES)[stage](spark, docs, "/root/testdata/sf0.001")
    finally:
        for x in both:
            spark.conf.set(x, before[x])
    assert seen == [corpus_pipeline.READ, 7]

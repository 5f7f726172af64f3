"""The corpus pipeline: toxic documents go, near duplicates go, personal data is masked, sources
are mixed, and what is left is packed into training sequences.

Each stage takes (spark, docs, folder); its result is written as Parquet and read again as the
next one's documents. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartloom.llm import minhash, mixing, packing, pii, toxicity
from cartloom.llm.tables import Scratch, read_table


#: Rows of an Arrow batch, and of a batch of the Parquet reader. Documents are long: with Spark's own
#: 10,000 and 4,096 the JVM and its Python workers hold tens of MB a task several times over, in arrays
#: that each need a stretch of the heap for themselves, and keep them for the stages that follow.
BATCH, READ = 250, 128


def small_batches(spark: SparkSession) -> None:
    """Bounds the Arrow and reader batches of the session; a smaller bound stays."""
    for name, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH), ("spark.sql.parquet.columnarReaderBatchSize", READ)):
        if not 0 < int(spark.conf.get(name)) <= most:
            spark.conf.set(name, most)


def toxicity_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that are not rejected as toxic."""
    small_batches(spark)
    graded = toxicity.grade_toxicity(docs, read_table(spark, folder, "labels"), with_rows=True)
    return graded.where("not rejected").select("row.*")


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near duplicates; repeated rows count as one."""
    small_batches(spark)
    kept = minhash.near_duplicates(docs).where("kept").select(F.col("doc_id").alias("kept_id")).distinct()
    stays = docs.join(kept, docs["doc_id"].eqNullSafe(kept["kept_id"]), "left_semi")
    return stays.dropDuplicates(["doc_id", "text"])


def personal_data_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """All documents, with personal data masked and ``n_chars`` counted anew."""
    small_batches(spark)
    found = pii.find_personal_data(docs, with_rows=True).select("row", "redacted", "spans")
    masked = F.when(F.col("spans") == "", F.col("row.text")).otherwise(F.col("redacted"))
    changed = {"text": masked, "n_chars": F.when(F.col("spans") == "", F.col("row.n_chars")).otherwise(F.length("redacted"))}
    return found.select(*[changed.get(c, F.col(f"row.`{c}`")).cast(t).alias(c) for c, t in docs.dtypes])


#: Texts of junk domains go down to a quarter of their tokens, all others keep theirs.
FACTORS = {f"{lang}-junk": 0.25 for lang in ("en", "de", "fr", "es")}


def mixing_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents drawn at their rates, which are at most 1: none is repeated."""
    small_batches(spark)
    targets = mixing.Targets(factors=FACTORS, by_text=True)
    mixed = mixing.mix_sources(docs, read_table(spark, folder, "labels"), targets, most=1.0, with_rows=True)
    return mixed.where("copies > 0").select("row.*")


def packing_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Pieces of documents with their place in training sequences."""
    small_batches(spark)
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("near_duplicates", near_duplicates_stage),
    ("personal_data", personal_data_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: Trained models and token ids are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = scratch.keep(stage(spark, docs, sf_dir))
    return docs

"""What the operators share: reading a table, shared scratch tables, literal tables."""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartloom.sinks import scratch_folder

#: White space that separates words: space, tab, line feed, vertical tab, form feed, carriage return.
WORD_GAP = r"[\x20\x09-\x0D]+"


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def release_memory() -> None:
    """Gives memory that Python and Arrow have freed back to the system; without glibc it does nothing."""
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass


def returning_memory(task: Callable) -> Callable[[Iterator], Iterator]:
    """A task on Arrow batches whose worker keeps no freed memory afterwards.

    Python workers live on between stages. Without this each one holds what its largest batch took
    while later stages run.
    """

    @functools.wraps(task)
    def run(batches: Iterator) -> Iterator:
        try:
            yield from task(batches)
        finally:
            release_memory()

    return run


class Scratch:
    """Tables written once to the shared folder and read back, so that lost executors cost one stage."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.base, self.count = spark, scratch_folder(spark, label), 0

    def keep(self, df: DataFrame) -> DataFrame:
        self.count += 1
        path = f"{self.base}/{self.count:03d}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


def whole_text(column: str) -> Column:
    """The text; a null counts as an empty one."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def literal_strings(values) -> str:
    """A SQL array literal."""
    escaped = (str(v).replace("\\", "\\\\").replace("'", "\\'") for v in values)
    return "array(" + ", ".join(f"'{v}'" for v in escaped) + ")"


def bounded_sample(df: DataFrame, n: int, *columns: str) -> DataFrame:
    """At most ``n`` rows, all if there are no more, chosen by a hash of ``columns``.

    The hash deals the rows into buckets of about n / 16 rows, and 64 of these buckets are taken in
    order as long as they fit. Rows of equal columns share a bucket; one with too many copies is
    passed over. Only the bucket counts reach the driver, and no row moves for it.
    """
    total = df.count()
    if total <= n:
        return df
    modulus = max(64, 16 * total // max(n, 1))
    bucket = F.pmod(F.xxhash64(*columns, F.lit(29)), F.lit(modulus))
    counts = {r["bucket"]: r["count"] for r in df.select(bucket.alias("bucket")).where("bucket < 64").groupBy("bucket").count().collect()}
    chosen, size = [], 0
    for b, held in sorted(counts.items()):
        if size + held <= n:
            chosen.append(b)
            size += held
    return df.where(bucket.isin(chosen))

"""Working folders that every executor can reach."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Folders whose tables may still be read; they go when the program ends.
_KEPT: dict[str, SparkSession] = {}


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A new folder below ``spark.checkpoint.dir``; a temporary one only in local mode.

    It is dropped when the program ends, if ``drop_scratch`` has not done so before.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("Set spark.checkpoint.dir to a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="cartloom-")
    folder = f"{base.rstrip('/')}/cartloom-{label}-{uuid.uuid4().hex}"
    _KEPT[folder] = spark
    return folder


def drop_scratch(spark: SparkSession, folder: str) -> None:
    _KEPT.pop(folder, None)
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@atexit.register
def _drop_kept() -> None:
    for folder, spark in list(_KEPT.items()):
        if spark.sparkContext._jsc is not None:  # else the session has ended before
            drop_scratch(spark, folder)


def written_once(df: DataFrame, label: str) -> DataFrame:
    """The table written to a working folder and read from there, so that it is computed once."""
    path = scratch_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

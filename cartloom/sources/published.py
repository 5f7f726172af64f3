"""Published tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from cartloom.sinks.attempts import latest_path


def read_latest(spark: SparkSession, base: str, table: str) -> DataFrame:
    path = latest_path(base, table)
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"Required table '{table}' does not exist: {path}") from error
        raise

"""Raw CSV tables under a column contract.

Every column is read as text, missing-value texts become null, and contract columns are cast.
Types never depend on the content, ids keep their leading zeros, and there is no extra pass
over the data to infer types.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartloom.operators.dedupe import INGEST_ORDER
from cartloom.params import JobParams
from cartloom.schemas import KEYED_TABLES, NA_TOKENS, RAW_CONTRACTS

# What counts as a number; type suffixes and words do not.
NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def read_csv_table(
    spark: SparkSession, path: str, table: str, multi_line: bool = False
) -> DataFrame:
    """One raw table; keyed tables also get their ingest order.

    ``multi_line`` allows line breaks inside quotes, at the price of unsplittable files.
    """
    try:
        text = (
            spark.read.option("header", True)
            .option("escape", '"')
            .option("multiLine", multi_line)
            .option("enforceSchema", False)
            .csv(path)
        )
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"Raw CSV file missing for table '{table}' at: {path}") from error
        raise
    contract = RAW_CONTRACTS.get(table, {})
    columns = [_typed(c, contract.get(c, "string")).alias(c) for c in text.columns]
    if table in KEYED_TABLES:
        columns.append(_file_position().alias(INGEST_ORDER))
    return text.select(*columns)


def extract_all(spark: SparkSession, params: JobParams) -> dict[str, DataFrame]:
    """All configured raw tables; a missing file is an error before anything runs."""
    return {
        table: read_csv_table(spark, params.raw_path(table), table, params.csv_multi_line)
        for table in params.raw_files
    }


def _typed(name: str, spark_type: str) -> Column:
    quoted = F.col(f"`{name}`")
    text = F.when(~quoted.isin(*NA_TOKENS), quoted)
    if spark_type == "string":
        return text
    plain = F.when(text.rlike(NUMBER), text)
    number = F.nanvl(plain.try_cast("double"), F.lit(None))
    return number if spark_type == "double" else number.try_cast(spark_type)


def _file_position() -> Column:
    """Sortable input position: file, block, row."""
    parts = [
        F.col("_metadata.file_path"),
        F.col("_metadata.file_block_start"),
        F.monotonically_increasing_id(),
    ]
    return F.struct(*[part.alias(f"p{i}") for i, part in enumerate(parts)])

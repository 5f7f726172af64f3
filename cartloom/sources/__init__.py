"""Readers: raw CSV tables, published Parquet tables, and the benchmark tables as raw tables."""

from cartloom.sources.benchmark_tables import raw_from_benchmark
from cartloom.sources.csv_tables import extract_all, read_csv_table
from cartloom.sources.published import read_latest

__all__ = ["extract_all", "raw_from_benchmark", "read_csv_table", "read_latest"]

"""Reusable DataFrame operators."""

from cartloom.operators.aggregate import agg_dropna, top_values
from cartloom.operators.calendar import daily_calendar
from cartloom.operators.dedupe import INGEST_ORDER, dedupe_first
from cartloom.operators.impute import impute_median
from cartloom.operators.positions import ingest_numbers, row_numbers
from cartloom.operators.quantile import exact_quantiles, histogram, summarise
from cartloom.operators.skew import hot_keys, salted_join, with_row_salt

__all__ = [
    "INGEST_ORDER",
    "agg_dropna",
    "daily_calendar",
    "dedupe_first",
    "exact_quantiles",
    "histogram",
    "hot_keys",
    "impute_median",
    "ingest_numbers",
    "row_numbers",
    "salted_join",
    "summarise",
    "top_values",
    "with_row_salt",
]

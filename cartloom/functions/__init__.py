"""Column expressions, as SQL text over column names: text, numbers, money sums, dates."""

from cartloom.functions.dates import calendar_columns, date_parts, parse_timestamp
from cartloom.functions.money import exact_sum
from cartloom.functions.numbers import clip_non_negative, missing_to_null
from cartloom.functions.text import normalize_text

__all__ = [
    "calendar_columns",
    "clip_non_negative",
    "date_parts",
    "exact_sum",
    "missing_to_null",
    "normalize_text",
    "parse_timestamp",
]

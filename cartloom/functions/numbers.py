"""Number expressions with one notion of "missing"."""

from __future__ import annotations


def missing_to_null(column: str) -> str:
    """The number with NaN as null, so that no comparison with a missing number is true.

    Spark orders NaN above all numbers, hence ``NaN >= 0`` would hold.
    """
    return f"if(isnan(`{column}`), null, `{column}`)"


def clip_non_negative(column: str) -> str:
    """Missing and negative numbers become 0.0."""
    return f"greatest(coalesce(cast({missing_to_null(column)} as double), 0D), 0D)"

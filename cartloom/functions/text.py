"""Text normalisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character that counts as whitespace when text is stripped.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def normalize_text(column: str, case: str = "lower", missing: str = "unknown") -> Column:
    """Fill missing, change case, strip - in this order.

    Filling comes first, so a missing state reads ``UNKNOWN`` and blank text stays ``''``.
    """
    if case not in ("lower", "upper"):
        raise ValueError(f"case must be 'lower' or 'upper', not {case!r}")
    filled = F.expr(f"{case}(coalesce(cast(`{column}` as string), '{missing}'))")
    # btrim with a character list compiles into the stage; a regex would run per row.
    return F.btrim(filled, F.lit(WHITESPACE))

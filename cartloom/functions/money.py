"""Sums of money that keep every digit and do not depend on the order of addition.

A plain sum of doubles changes in the last digits with the partitioning, and a decimal cast drops
digits and goes through text for every row. Here each amount is split exactly, by powers of two,
into whole numbers of falling units, which are summed as longs. Only what lies below the smallest
unit, and amounts too large for the largest, are added as doubles; nothing is thrown away.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Exponents of the units. A part is below 2**24 units, so a group of 2**39 rows cannot overflow.
UNITS = (8, -16, -40, -64)
#: From this size on (2e21) an amount is added as a double.
LARGE = 2.0**71


def exact_sum(column: str) -> Column:
    """Sum of a double column, 0.0 for a group without values."""
    amount = f"nanvl(cast(`{column}` as double), null)"
    rest = f"if(abs({amount}) < {LARGE!r}D, {amount}, null)"
    parts = []
    for unit in UNITS:
        whole = f"cast({rest} * {2.0**-unit!r}D as bigint)"  # towards zero, so the rest is exact
        parts.append(whole)
        rest = f"({rest} - {whole} * {2.0**unit!r}D)"
    first, *others = parts
    # The largest part may be long: its high and low bits are summed apart.
    sums = [f"sum(shiftright({first}, 24))", f"sum({first} & {2**24 - 1}L)", *[f"sum({p})" for p in others]]
    high, low, *fine = [f"cast(coalesce({s}, 0L) as decimal(20, 0))" for s in sums]
    upper = f"cast({high} * {2**24} + {low} as double) * {2.0 ** UNITS[0]!r}D"
    lower = f"cast({fine[0]} * {2**48} + {fine[1]} * {2**24} + {fine[2]} as double) * {2.0 ** UNITS[-1]!r}D"
    large = f"sum(if(abs({amount}) < {LARGE!r}D, null, {amount}))"
    return F.expr(f"{upper} + ({lower} + coalesce(sum({rest}), 0D)) + coalesce({large}, 0D)")

"""Exact quantiles by histograms of fixed size, without a shuffle of values.

The built-in exact percentile ends in a single task that holds every distinct value. Here each scan
of the table yields one histogram per column, summed within the tasks first, so that only bins are
shuffled and only the bins around a wanted rank come to the driver. The first histogram has 1024
bins per power of two; each further one has ``BINS`` bins of equal width over every range that
still holds a wanted rank. A range ends as soon as it holds a single value. One logarithmic bin
spans less than 2**43 doubles, so three further scans always do; values with few digits, such as
money, mostly need one.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartloom.functions.numbers import missing_to_null

BINS_PER_POWER = 1024
BINS = 2**14

# Bin number by sign and binary logarithm, ascending with the value; infinities lie outside.
_LOG_BIN = (
    "case when {v} = 0 then 0L when abs({v}) = double('inf') then cast(signum({v}) as bigint) * 100000000L"
    f" else cast(signum({{v}}) as bigint) * (floor(log2(abs({{v}})) * {BINS_PER_POWER}) + 10000000L) end"
)


@dataclass(frozen=True)
class _Rank:
    """A wanted rank: how many values of [lo, hi] lie before it."""

    column: str
    probability: float
    upper: bool
    rank: int
    lo: float = -math.inf
    hi: float = math.inf


@dataclass(frozen=True)
class ColumnSummary:
    """Count, mean, sample deviation, extremes and quantiles (by probability) of a column's values."""

    count: int
    mean: float | None
    std: float | None
    min: float | None
    max: float | None
    quantiles: dict[float, float]


def histogram(df: DataFrame, columns: list[str], ranges: dict[str, list[tuple[float, float]]] | None = None) -> DataFrame:
    """Rows (column, part, bin, n, lo, hi, mean, variance) from one scan.

    Without ``ranges`` the bins are logarithmic over all values. With them, ``part`` numbers the
    range of the column that a value lies in; values outside all ranges are left out.
    """
    if ranges is not None:  # few rows lie in a range; the others are passed over before they are taken apart
        df = df.where(" or ".join(f"{first_bin(c)[0]} between double('{lo!r}') and double('{hi!r}')" for c in columns for lo, hi in ranges[c]))
    placed = df.selectExpr(f"inline(array({', '.join(_placed(columns, ranges))}))").where("part is not null")
    return placed.groupBy("column", "part", "bin").agg(F.expr("count(1) as n"), *[F.expr(f"{m} as {name}") for name, m in BIN_MEASURES.items()])


#: What a bin tells of its values beside their number.
BIN_MEASURES = {"lo": "min(value)", "hi": "max(value)", "mean": "avg(value)", "variance": "var_pop(value)"}


def first_bin(column: str) -> tuple[str, str]:
    """A column's value as a number (null if missing), and its logarithmic bin."""
    v = f"cast({missing_to_null(column)} as double)"
    return v, _LOG_BIN.format(v=v)


def _placed(columns: list[str], ranges: dict[str, list[tuple[float, float]]] | None) -> list[str]:
    """Per column, a struct with its value, range and bin."""
    entries = []
    for c in columns:
        v, log_bin = first_bin(c)
        if ranges is None:
            entries.append(f"named_struct('column', '{c}', 'value', {v}, 'part', if({v} is null, null, 0), 'bin', {log_bin})")
            continue
        inside, bins = [], []
        for i, (lo, hi) in enumerate(ranges[c]):
            within = f"when {v} between double('{lo!r}') and double('{hi!r}')"
            inside.append(f"{within} then {i}")
            bins.append(f"{within} then floor(({v} - double('{lo!r}')) / double('{hi - lo!r}') * {BINS})")
        entries.append(f"named_struct('column', '{c}', 'value', {v}, 'part', case {' '.join(inside)} end, 'bin', case {' '.join(bins)} end)")
    return entries


def summarise(
    df: DataFrame, columns: list[str], probabilities: list[float], first: DataFrame | None = None
) -> dict[str, ColumnSummary]:
    """Summary of each column's values; missing values are skipped.

    Runs at once: one scan for all but the quantiles, and one to three more for these. ``first`` is
    the first histogram, if it has been taken before.
    """
    if not columns:
        return {}
    # The first histogram stays in Spark: its running sums find the bins that hold a wanted rank.
    bins = (histogram(df, columns) if first is None else first).selectExpr("*", "sum(n) over (partition by column order by bin) as upto", "sum(n) over (partition by column) as total")
    wanted = ", ".join(f"cast({way}(double('{p!r}') * (total - 1)) as bigint)" for p in probabilities for way in ("floor", "ceil")) or "-1L"
    holds = f"exists(array({wanted}), r -> upto - n <= r and r < upto)"
    kept = bins.groupBy("column").agg(
        F.expr("max(total) as total"),
        F.expr("min(lo) as min"),
        F.expr("max(hi) as max"),
        F.expr("sum(n * mean) / sum(n) as mean"),
        F.expr("collect_list(struct(n, mean, variance)) as moments"),
        F.expr(f"collect_list(if({holds}, struct(upto - n as before, n, lo, hi), null)) as holding"),
    )
    # Between the bins and around them: variances add up about the common mean.
    about = "aggregate(moments, 0D, (a, m) -> a + m.n * (m.variance + (m.mean - mean) * (m.mean - mean)))"
    rows = kept.selectExpr("column", "total", "min", "max", "mean", f"if(total > 1, sqrt({about} / (total - 1)), null) as std", "holding").collect()
    found, ranks = {r["column"]: r for r in rows}, []
    for c, row in found.items():
        for p in probabilities:
            for upper, place in ((False, math.floor), (True, math.ceil)):
                rank = place(p * (row["total"] - 1))
                held = next(h for h in row["holding"] if h["before"] <= rank < h["before"] + h["n"])
                ranks.append(_Rank(c, p, upper, rank - held["before"], held["lo"], held["hi"]))
    while any(r.lo < r.hi for r in ranks):
        ranks = _narrow(df, ranks)
    ends = {(r.column, r.probability, r.upper): r.lo for r in ranks}
    out = {}
    for c in columns:
        row = found.get(c)
        if row is None:
            out[c] = ColumnSummary(0, None, None, None, None, {})
            continue
        at = {}
        for p in probabilities:
            low, high = ends[c, p, False], ends[c, p, True]
            part = p * (row["total"] - 1) % 1
            at[p] = low if low == high else (low + high) / 2 if part == 0.5 else low + (high - low) * part
        out[c] = ColumnSummary(row["total"], row["mean"], row["std"], row["min"], row["max"], at)
    return out


def _narrow(df: DataFrame, ranks: list[_Rank]) -> list[_Rank]:
    """One scan: each open range becomes the bin of it that holds the rank."""
    ranges: dict[str, list[tuple[float, float]]] = {}
    for r in ranks:
        if r.lo < r.hi and (r.lo, r.hi) not in ranges.setdefault(r.column, []):
            ranges[r.column].append((r.lo, r.hi))
    open_columns = [c for c, parts in ranges.items() if parts]
    bins = histogram(df, open_columns, ranges).selectExpr("column", "part", "n", "lo", "hi", "sum(n) over (partition by column, part order by bin) as upto")
    holds = " or ".join(
        f"(column = '{r.column}' and part = {ranges[r.column].index((r.lo, r.hi))} and upto - n <= {r.rank} and {r.rank} < upto)" for r in ranks if r.lo < r.hi
    )
    held = bins.where(holds).collect()  # at most a row per wanted rank
    out = []
    for r in ranks:
        if r.lo < r.hi:
            part = ranges[r.column].index((r.lo, r.hi))
            b = next(b for b in held if b["column"] == r.column and b["part"] == part and b["upto"] - b["n"] <= r.rank < b["upto"])
            r = replace(r, rank=r.rank - (b["upto"] - b["n"]), lo=b["lo"], hi=b["hi"])
        out.append(r)
    return out


def exact_quantiles(df: DataFrame, columns: list[str], probabilities: list[float]) -> DataFrame:
    """Rows (column, probability, quantile), linearly interpolated; missing values are skipped.

    A column without any value yields no rows.
    """
    found = summarise(df, columns, probabilities)
    rows = [(c, float(p), q) for c, s in found.items() for p, q in s.quantiles.items()]
    return df.sparkSession.createDataFrame(rows, "column string, probability double, quantile double")

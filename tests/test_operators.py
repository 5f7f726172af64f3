from __future__ import annotations

import math
import struct
from decimal import Decimal

import numpy as np
import pytest
from conftest import plan, rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cartloom.functions import exact_sum
from cartloom.operators import (
    agg_dropna,
    daily_calendar,
    dedupe_first,
    exact_quantiles,
    hot_keys,
    impute_median,
    salted_join,
    top_values,
    with_row_salt,
)
from cartloom.operators import histogram, quantile, row_numbers, summarise
from cartloom.operators.aggregate import frequent_values
from cartloom.operators.quantile import BINS
from cartloom.operators.skew import ROW_SALTS, SALTS


def test_dedupe_keeps_the_first_by_order(spark):
    df = spark.createDataFrame(
        [("a", 2, "late"), ("a", 1, "first"), (None, 5, "n1"), (None, 4, "n0"), ("b", 1, "b")],
        "k string, seq int, v string",
    ).repartition(4)
    result = {r.k: r.v for r in dedupe_first(df, "k", order_by="seq").collect()}
    assert result == {"a": "first", None: "n0", "b": "b"}


def test_dedupe_composite_key(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (1, 2)], "a int, b int")
    assert dedupe_first(df, ["a", "b"]).count() == 2


def test_aggregate_leaves_out_null_keys(spark):
    df = spark.createDataFrame([("a", 1.0), (None, 2.0), ("a", None)], "k string, x double")
    result = agg_dropna(df, ["k"], exact_sum("x").alias("s"), F.expr("count(x) as n"))
    assert rows(result) == [{"k": "a", "s": 1.0, "n": 1}]


def test_top_values_with_ties(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), (None,)], "v string")
    assert [tuple(r) for r in top_values(df, "v", 2).collect()] == [("c", 2), ("a", 1)]


def test_calendar_is_dense(spark):
    df = spark.createDataFrame([("2020-02-27 23:00:00",), ("2020-03-02",), (None,)], "t string")
    days = daily_calendar(df.selectExpr("cast(t as timestamp_ntz) as t"), "t")
    assert [r.date.isoformat() for r in days.collect()] == [
        "2020-02-27",
        "2020-02-28",
        "2020-02-29",
        "2020-03-01",
        "2020-03-02",
    ]


# Sums of money


def test_exact_sum_of_nothing_is_zero(spark):
    df = spark.createDataFrame([(None,), (float("nan"),)], "x double")
    assert df.agg(exact_sum("x").alias("s")).first().s == 0.0
    assert df.limit(0).agg(exact_sum("x").alias("s")).first().s == 0.0


def test_exact_sum_does_not_depend_on_partitions(spark):
    df = spark.range(200_000).selectExpr("cast(id % 9973 as double) * 0.01 as x")
    sums = {
        df.repartition(n).agg(exact_sum("x").alias("s")).first().s for n in (1, 3, 8)
    }
    exact = sum(Decimal(i % 9973) / 100 for i in range(200_000))
    assert sums == {float(exact)}


def test_exact_sum_keeps_small_digits(spark):
    tiny = spark.range(1_000_000).selectExpr("0.00004D as x")
    assert tiny.agg(exact_sum("x").alias("s")).first().s == pytest.approx(40.0, rel=1e-15)
    mixed = spark.createDataFrame([(x,) for x in (0.12346, 0.12346, 0.12346, -1e-20, 1e15, -1e15)], "x double")
    assert mixed.agg(exact_sum("x").alias("s")).first().s == pytest.approx(0.37038, rel=1e-15)


def test_exact_sum_of_large_totals_and_amounts(spark):
    df = spark.range(1000).selectExpr("800000000000.25D as x")
    assert df.agg(exact_sum("x").alias("s")).first().s == pytest.approx(8.0000000000025e14, rel=1e-15)
    large = spark.createDataFrame([(1e300,), (-5.25,), (1e15,)], "x double")
    assert large.agg(exact_sum("x").alias("s")).first().s == 1e300
    infinite = spark.createDataFrame([(math.inf,), (1.0,)], "x double")
    assert infinite.agg(exact_sum("x").alias("s")).first().s == math.inf


@settings(
    max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(st.lists(st.integers(-(10**13), 10**13), min_size=1, max_size=40))
def test_exact_sum_equals_decimal_arithmetic(spark, units):
    amounts = [u / 10_000 for u in units]
    df = spark.createDataFrame([(a,) for a in amounts], "x double")
    total = Decimal(sum(units)) / 10_000
    assert df.agg(exact_sum("x").alias("s")).first().s == pytest.approx(float(total), rel=1e-15, abs=1e-12)


# Quantiles


def _quantiles(spark, values, probabilities):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    found = exact_quantiles(df, ["x"], probabilities).collect()
    return {r.probability: r.quantile for r in found}


AWKWARD = [
    [1.0],
    [10.0, 30.0],
    [-5.0, -0.0, 0.0, 7.5, 7.5, 7.5, 1e300, -1e300, 5e-324],
    # Neighbouring doubles: only the last round of bins tells them apart.
    [struct.unpack("<d", struct.pack("<q", 0x4059000000000000 + i))[0] for i in range(50)],
    [1e-12 * i for i in range(30)] + [1e12 + i for i in range(30)] + [1e300],
    [float("nan"), 1.0, 2.0, 4.0],
]


@pytest.mark.parametrize("values", AWKWARD)
def test_quantiles_equal_brute_force(spark, values):
    probabilities = [0.0, 0.25, 0.5, 0.75, 1.0]
    found = _quantiles(spark, values, probabilities)
    known = [v for v in values if not math.isnan(v)]
    for p in probabilities:
        assert found[p] == pytest.approx(np.quantile(known, p), rel=1e-15, abs=0.0), p


def test_quantiles_of_skewed_and_spread_values(spark):
    generator = np.random.default_rng(3)
    values = np.concatenate([np.full(3000, 42.0), generator.lognormal(3, 4, 6000)])
    df = spark.createDataFrame([(float(v),) for v in values], "x double").repartition(5)
    df = df.withColumn("y", F.expr("-x"))
    found = exact_quantiles(df, ["x", "y"], [0.1, 0.5, 0.999]).collect()
    assert len(found) == 6
    for r in found:
        sign = 1 if r.column == "x" else -1
        assert r.quantile == pytest.approx(np.quantile(sign * values, r.probability), rel=1e-14)


def test_quantiles_of_any_doubles(spark):
    """Random bit patterns, and ranges in which thousands of neighbouring doubles lie."""
    generator = np.random.default_rng(11)
    n = 4001
    columns = {
        "any": generator.integers(0, 2**64, n, dtype=np.uint64).view(np.float64),
        "tiny": generator.integers(0, 5000, n, dtype=np.uint64).view(np.float64),
        "dense": (0x40F0000000000000 + generator.integers(0, 3000, n)).view(np.float64),
        "wide": (0x3FF0000000000000 + generator.integers(0, 2**52, n)).view(np.float64),
        "cents": generator.integers(-(10**7), 10**7, n) / 100.0,
    }
    columns["any"][~np.isfinite(columns["any"])] = 0.0
    data = [tuple(float(columns[c][i]) for c in columns) for i in range(n)]
    df = spark.createDataFrame(data, ", ".join(f"`{c}` double" for c in columns))
    probabilities = [0.0, 0.2, 0.5, 0.75, 1.0]  # whole ranks, so each is a value of the column
    found = exact_quantiles(df, list(columns), probabilities).collect()
    assert len(found) == len(columns) * len(probabilities)
    for r in found:
        rank = round(r.probability * (n - 1))
        assert r.quantile == np.sort(columns[r.column])[rank], (r.column, r.probability)


def test_infinite_values_rank_last(spark):
    assert _quantiles(spark, [1.0, math.inf, -math.inf, 2.0, math.inf], [0.0, 0.5, 1.0]) == {
        0.0: -math.inf,
        0.5: 2.0,
        1.0: math.inf,
    }


def test_quantiles_use_no_single_task_percentile(spark):
    text = plan(exact_quantiles(spark.range(10).selectExpr("id * 1D as x"), ["x"], [0.5]))
    assert "percentile" not in text and "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text


def test_impute_keeps_a_column_without_values(spark):
    df = spark.createDataFrame([(1, None), (2, None)], "k int, x double")
    assert [r.x for r in impute_median(df, ["x"]).collect()] == [None, None]
    with pytest.raises(ValueError):
        impute_median(df, ["x"], "mode")


# Skewed joins


@pytest.fixture(scope="module")
def skewed(spark):
    left = spark.range(30_000, numPartitions=6).selectExpr(
        "id",
        "case when id % 3 = 0 then 'hot' when id % 7 = 0 then null else concat('k', id % 5000) end"
        " as k",
    )
    right = spark.range(4000).selectExpr("concat('k', id) as k", "id * 2 as v")
    return left, right.union(spark.sql("select 'hot', -1L")).union(spark.sql("select null, -2L"))


def test_hot_keys_are_found(skewed):
    left, _ = skewed
    found = hot_keys(left, ["k", "id"])
    assert set(found["k"]) == {"hot", None}
    assert found["id"] == {}
    assert all(1 < parts <= SALTS + 1 for parts in found["k"].values())


def test_hot_keys_of_an_empty_table(skewed):
    left, _ = skewed
    assert hot_keys(left.limit(0), ["k"]) == {"k": {}}


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_equals_plain_join(skewed, how):
    left, right = skewed
    plain = left.join(right, "k", how).select("id", "k", "v")
    salted = salted_join(with_row_salt(left), right, "k", how, {"hot": 700, None: 90}).select("id", "k", "v")
    assert sorted(map(str, salted.collect())) == sorted(map(str, plain.collect()))


def test_salted_join_spreads_the_hot_key(spark, skewed):
    left, right = skewed
    settings_before = {
        k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")
    }
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = salted_join(with_row_salt(left), right, "k", "left", ["hot", None])
        sizes = joined.groupBy(F.spark_partition_id()).count().collect()
        plain = left.join(right, "k", "left").groupBy(F.spark_partition_id()).count().collect()
    finally:
        for key, value in settings_before.items():
            spark.conf.set(key, value)
    mean = 30_000 / 8
    assert max(r["count"] for r in plain) > 2.5 * mean
    assert max(r["count"] for r in sizes) < 1.3 * mean


def test_row_salt_spreads_identical_rows(spark):
    copies = spark.range(100_000, numPartitions=4).selectExpr("'same' as k")
    salts = with_row_salt(copies).select("_row_salt")
    # Over a million salts, 100,000 rows meet rarely ...
    bounds = salts.agg(F.min("_row_salt").alias("low"), F.max("_row_salt").alias("high"), F.countDistinct("_row_salt").alias("n")).first()
    assert 0 <= bounds.low < 0.01 * ROW_SALTS and 0.99 * ROW_SALTS < bounds.high < ROW_SALTS
    assert bounds.n > 90_000
    # ... and the parts that a join makes of them are of even size, whatever their number.
    for parts in (7, 64, SALTS):
        sizes = [r["count"] for r in salts.groupBy(F.pmod("_row_salt", F.lit(parts))).count().collect()]
        assert len(sizes) == parts
        assert max(sizes) < 2 * 100_000 / parts


def test_other_join_types_are_refused(skewed):
    left, right = skewed
    with pytest.raises(ValueError):
        salted_join(left, right, "k", "full", ["hot"])


# Histograms, frequent values, row numbers


def test_quantiles_shuffle_bins_and_no_values(spark):
    """A million different values: what is shuffled and collected is bounded by the bins."""
    df = spark.range(1_000_000, numPartitions=8).selectExpr("cast(pmod(xxhash64(id), 100000007) as double) / 100 as x")
    first = histogram(df, ["x"])
    text = plan(first)
    assert "hashpartitioning(column" in text and "hashpartitioning(value" not in text and ", value" not in text.split("Exchange")[1].split("\n")[0]
    assert first.count() < 30_000
    found = summarise(df, ["x"], [0.5, 0.99])["x"]
    values = np.array([r.x for r in df.collect()])
    assert found.quantiles == {p: pytest.approx(np.quantile(values, p), rel=1e-14) for p in (0.5, 0.99)}
    assert (found.count, found.min, found.max) == (1_000_000, values.min(), values.max())
    assert found.mean == pytest.approx(values.mean(), rel=1e-12) and found.std == pytest.approx(values.std(ddof=1), rel=1e-9)
    around = {"x": [(found.quantiles[0.5] - 100, found.quantiles[0.5] + 100)]}
    assert histogram(df, ["x"], around).count() <= BINS + 1


def test_quantiles_of_money_take_two_scans(spark, monkeypatch):
    scans = []
    plain = quantile.histogram
    monkeypatch.setattr(quantile, "histogram", lambda *a, **k: scans.append(a) or plain(*a, **k))
    summarise(spark.range(100_000).selectExpr("cast(id % 90000 as double) / 100 as x"), ["x"], [0.25, 0.5, 0.75])
    assert len(scans) == 2


def test_summary_of_columns_without_values(spark):
    df = spark.createDataFrame([(None, 3.0), (float("nan"), None)], "x double, y double")
    found = summarise(df, ["x", "y"], [0.5])
    assert found["x"].count == 0 and found["x"].quantiles == {} and found["x"].mean is None
    assert found["y"].count == 1 and found["y"].std is None and found["y"].quantiles == {0.5: 3.0}
    assert summarise(df, [], [0.5]) == {}


@pytest.fixture(scope="module")
def wide_column(spark):
    """300,000 values, of which some are frequent, with ties at the tenth place."""
    rare = spark.range(300_000).selectExpr("concat('v', id) as v")
    often = spark.range(60_000).selectExpr("concat('often', id % 12) as v")
    return rare.unionByName(often).unionByName(spark.sql("select explode(array_repeat('often3', 500)) as v")).repartition(6)


def test_top_values_of_a_wide_column(spark, wide_column):
    assert set(frequent_values(wide_column, "v", 10)) >= {f"often{i}" for i in range(12)}
    assert len(frequent_values(wide_column, "v", 10)) < 200
    got = [tuple(r) for r in top_values(wide_column, "v", 10).collect()]
    assert got == [("often3", 5500), *[(f"often{i}", 5000) for i in (0, 1, 10, 11, 2, 4, 5, 6, 7)]]


def test_top_values_without_proof_count_all(spark):
    """No value stands out, so every one is counted."""
    flat = spark.range(200_000).selectExpr("concat('v', id % 100000) as v")
    assert frequent_values(flat, "v", 3) is None
    assert [tuple(r) for r in top_values(flat, "v", 3).collect()] == [("v0", 2), ("v1", 2), ("v10", 2)]
    assert top_values(flat.limit(0), "v", 3).collect() == []
    dates = spark.sql("select explode(sequence(date'2024-01-01', date'2024-03-01')) as d")
    assert [str(r.d) for r in top_values(dates.unionByName(dates.limit(2)), "d", 2).collect()] == ["2024-01-01", "2024-01-02"]


def test_row_numbers_go_on_from_part_to_part(spark):
    df = spark.createDataFrame([(p, 100 * i + r, f"{p}{r}") for i, (p, n) in enumerate([("a", 3), ("b", 1), ("c", 5)]) for r in range(n)], "p string, r long, v string")
    numbered = row_numbers(df.repartition(4), "p", "r")
    assert [r.v for r in numbered.orderBy("row_number").collect()] == ["a0", "a1", "a2", "b0", "c0", "c1", "c2", "c3", "c4"]
    assert [r.row_number for r in numbered.orderBy("row_number").collect()] == list(range(1, 10))
    assert numbered.columns == ["p", "r", "v", "row_number"] and row_numbers(df.limit(0), "p", "r").count() == 0

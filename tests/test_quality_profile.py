from __future__ import annotations

import datetime as dt

import numpy as np
import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from cartloom.operators import histogram
from cartloom.params import JobParams
from cartloom.plans import profile, quality
from cartloom.plans.quality import DataQualityError


def _violations(df):
    return {(r.table, r.rule, r.column): r.violations for r in df.collect()}


@pytest.fixture(scope="module")
def staged(spark):
    return {
        "orders": spark.createDataFrame(
            [("1", "c1", "lost"), (None, None, None), (None, "c3", "delivered")],
            "order_id string, customer_id string, order_status string",
        ),
        "customers": spark.createDataFrame([("a",), ("a",), (None,)], "customer_id string"),
        "products": spark.createDataFrame([("a",), ("b",)], "product_id string"),
        "payments": spark.createDataFrame(
            [("1", -1.0), (None, None)], "order_id string, payment_value double"
        ),
        "order_items": spark.createDataFrame(
            [("1", None, -1.0, 0.0), ("1", "p", float("nan"), None)],
            "order_id string, product_id string, price double, shipping_charges double",
        ),
    }


def test_staging_rules_count_violations(staged):
    found = _violations(quality.validate_staging(staged, JobParams()))
    assert found == {
        ("orders", "not_null", "order_id"): 2,
        ("orders", "unique", "order_id"): 1,
        ("orders", "not_null", "customer_id"): 1,
        ("orders", "allowed_values", "order_status"): 2,
        ("customers", "not_null", "customer_id"): 1,
        ("customers", "unique", "customer_id"): 1,
        ("products", "not_null", "product_id"): 0,
        ("products", "unique", "product_id"): 0,
        ("payments", "not_null", "order_id"): 1,
        ("payments", "non_negative", "payment_value"): 1,
        ("order_items", "not_null", "order_id"): 0,
        ("order_items", "not_null", "product_id"): 1,
        ("order_items", "non_negative", "price"): 1,
        ("order_items", "non_negative", "shipping_charges"): 0,
    }


def test_enforce_reports_every_broken_rule(staged):
    violations = quality.validate_staging(staged, JobParams())
    bad = quality.invalid_values(staged["orders"], "order_status", ("delivered",))
    with pytest.raises(DataQualityError) as error:
        quality.enforce(violations, {"orders.order_status": bad})
    assert "'lost'" in str(error.value) and "payments.payment_value" in str(error.value)
    quality.enforce(violations.filter("violations = 0"))


def test_invalid_values_lists_all(staged):
    bad = quality.invalid_values(staged["orders"], "order_status", ("delivered",))
    assert {(r.order_status, r.rows) for r in bad.collect()} == {("lost", 1), (None, 1)}


def test_no_allowed_values_rejects_all(staged):
    rule = quality.allowed_values("order_status", ())
    found = quality.check_table(staged["orders"], "staging", "orders", [rule])
    assert found.first().violations == 3


def test_allowed_value_with_a_quote(spark):
    df = spark.createDataFrame([("it's",), ("a\\b",), ("x",)], "s string")
    rule = quality.allowed_values("s", ("it's", "a\\b"))
    assert quality.check_table(df, "l", "t", [rule]).first().violations == 1


def test_composite_uniqueness_counts_null_keys_as_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, 2), (2, 2)], "a int, b int")
    found = quality.check_table(df, "l", "t", [quality.unique("a", "b")])
    assert found.first().violations == 1


def test_empty_mart_is_a_violation(spark):
    frame = spark.createDataFrame([], "revenue double")
    assert quality.check_not_empty(frame, "mart", "m").first().violations == 1
    assert quality.check_not_empty(spark.range(5), "mart", "m").first().violations == 0


def test_required_columns(spark):
    df = spark.createDataFrame([("1",)], "order_id string")
    quality.require_columns("t", df, ("order_id",))
    with pytest.raises(DataQualityError, match="customer_id"):
        quality.require_columns("t", df, ("order_id", "customer_id"))


def test_output_rules_follow_the_columns(spark):
    by_date = spark.createDataFrame([(dt.date(2024, 1, 1),)] * 2, "date date")
    found = _violations(quality.check_output({"dim_date": by_date}))
    assert found == {("dim_date", "unique", "date"): 1}
    mart = spark.createDataFrame([(-1.0, 2.0)], "net_revenue double, total_value double")
    found = _violations(quality.check_output({"mart_top_products": mart}))
    assert found == {
        ("mart_top_products", "not_empty", "*"): 0,
        ("mart_top_products", "non_negative", "net_revenue"): 1,
        ("mart_top_products", "non_negative", "total_value"): 0,
    }


def test_shape_and_null_counts(spark):
    df = spark.createDataFrame(
        [("a", None, 1.0), (None, None, float("nan"))], "s string, n int, x double"
    )
    assert rows(profile.table_shape({"t": df})) == [
        {"table": "t", "rows": 2, "columns": 3, "column_list": "s, n, x"}
    ]
    assert {(r.column, r.nulls) for r in profile.null_counts(df).collect()} == {
        ("s", 1),
        ("n", 2),
        ("x", 1),
    }


def test_describe_equals_brute_force(spark):
    values = [float(v) for v in np.random.default_rng(1).gamma(2, 50, 999)]
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "x double, n int")
    x, n = (r for r in sorted(profile.describe(df, ["x", "n"]).collect(), key=lambda r: -ord(r.column)))
    assert x["count"] == 999 and x["min"] == min(values) and x["max"] == max(values)
    assert x["mean"] == pytest.approx(np.mean(values))
    assert x["std"] == pytest.approx(np.std(values, ddof=1))
    assert [x.q25, x.q50, x.q75] == pytest.approx(list(np.quantile(values, [0.25, 0.5, 0.75])))
    assert (n.q25, n.q50, n.q75) == (249.5, 499.0, 748.5)


def test_describe_a_column_without_values(spark):
    df = spark.createDataFrame([(None, 1.0)], "x double, y double")
    x = next(r for r in profile.describe(df, ["x", "y"]).collect() if r.column == "x")
    assert x["count"] == 0 and x["mean"] is None and x.q50 is None


def test_overview_parts(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (2, 2), (3, 3)], "k int, v int")
    overview = profile.table_overview("t", df, ["k"])
    assert overview["head"].count() == 3
    assert overview["duplicates"].first().duplicates == 1
    assert overview["null_counts"].count() == 0
    assert "duplicates" not in profile.table_overview("t", df, ["missing"])


def test_profile_rows_count_keys_apart_from_numbers(spark):
    """Only counts of a key are shuffled for it; odd rows are profiled as they are."""
    data = [("a", 1.5, "x", 1), ("a", float("nan"), "x", 1), (None, None, None, None), (None, -2.0, "y", 0)]
    df = spark.createDataFrame(data, "k string, v double, s string, n int")
    found = profile.profile_rows("t", df, ("k",), ("v",), "s", 1, ("v",), "n = 1", None)
    assert "to_json" not in plan(found) and "keys=[k#" in plan(found)
    got = {(r.part, r.item, r.measure, r.text): r.value for r in found.collect()}
    assert {k: v for k, v in got.items() if k[0] != "describe"} == {
        ("shape", "", "rows", None): 4.0,
        ("shape", "", "columns", None): 4.0,
        ("nulls", "k", "count", None): 2.0,
        ("nulls", "v", "count", None): 2.0,
        ("nulls", "s", "count", None): 1.0,
        ("nulls", "n", "count", None): 1.0,
        ("totals", "v", "sum", None): 1.5,
        ("duplicates", "k", "count", None): 2.0,
        ("frequency", "s", "count", "x"): 2.0,
    }
    described = {m: v for (part, _, m, _), v in got.items() if part == "describe"}
    assert described == {"count": 2.0, "mean": -0.25, "std": pytest.approx(2.4748737), "min": -2.0, "max": 1.5, "q25": -1.125, "q50": -0.25, "q75": 0.625}


def test_narrowing_passes_over_rows_outside_the_ranges(spark):
    df = spark.range(1000).select(F.col("id").cast("double").alias("x"), (F.col("id") * 2.0).alias("y"))
    narrow = histogram(df, ["x", "y"], {"x": [(10.0, 20.0)], "y": [(30.0, 50.0), (100.0, 101.0)]})
    assert {(r["column"], r["part"]): r["n"] for r in narrow.groupBy("column", "part").agg(F.sum("n").alias("n")).collect()} == {("x", 0): 11, ("y", 0): 11, ("y", 1): 1}
    text = plan(narrow)
    assert "Filter" in text[text.index("Generate") :]  # plans are read from below

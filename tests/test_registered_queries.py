from __future__ import annotations

import pytest
from oracle_check import compare, database

from __spark_entry__ import entry, oracle_sql, queries
from cartloom.queries.oracle import ORACLE
from cartloom.queries.registry import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return database(FOLDER)


def test_every_query_has_sql():
    assert set(ORACLE) == set(QUERIES)
    assert set(oracle_sql()) <= set(queries())
    assert QUERIES.keys() <= queries().keys()


def test_entry(spark):
    assert entry(spark).count() == 7


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert compare(spark, FOLDER, name, con) == []


def test_invariants(spark):
    revenue = {}
    for name in ("mart_revenue_by_day", "mart_revenue_by_month", "mart_customer_geo"):
        total = queries()[name](spark, FOLDER).selectExpr("round(sum(revenue), 2) as r")
        revenue[name] = total.first().r
    assert revenue["mart_revenue_by_day"] == revenue["mart_revenue_by_month"] == 99318135.61
    # Orders with bad dates have a place but no day.
    assert revenue["mart_customer_geo"] == 101370304.21
    items = queries()["fact_order_items"](spark, FOLDER)
    assert items.filter("product_category_name is null").count() == 125

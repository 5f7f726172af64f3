from __future__ import annotations

import datetime as dt

from conftest import plan, rows

from cartloom.plans import staging


def test_orders_keep_every_status(spark):
    df = spark.createDataFrame(
        [
            ("1", "c1", "delivered", "2023-01-01"),
            ("2", "c2", "canceled", "2023-01-02"),
            ("3", "c3", "shipped", "2023-01-03"),
        ],
        "order_id string, customer_id string, order_status string, order_purchase_timestamp string",
    )
    result = staging.clean_orders(df)
    assert result.count() == 3
    assert {r.order_status for r in result.collect()} == {"delivered", "canceled", "shipped"}


def test_order_date_parts(spark):
    df = spark.createDataFrame(
        [("1", "2023-05-15 10:00:00")], "order_id string, order_purchase_timestamp string"
    )
    assert rows(staging.clean_orders(df)) == [
        {
            "order_id": "1",
            "order_purchase_timestamp": dt.datetime(2023, 5, 15, 10),
            "order_date": dt.date(2023, 5, 15),
            "order_year": 2023,
            "order_month": 5,
            "order_quarter": 2,
            "order_dow": "Monday",
        }
    ]


def test_each_timestamp_is_read_on_its_own(spark):
    texts = ["2023-01-01", "2023-01-02 10:00:00", "bad", "9999-01-01", None]
    df = spark.createDataFrame(
        [(str(i), t) for i, t in enumerate(texts)], "order_id string, order_approved_at string"
    )
    result = rows(staging.clean_orders(df), "order_id")
    assert [r["order_approved_at"] for r in result] == [
        dt.datetime(2023, 1, 1),
        dt.datetime(2023, 1, 2, 10),
        None,
        None,
        None,
    ]
    assert "order_date" not in result[0]


def test_timestamps_with_a_format(spark):
    df = spark.createDataFrame(
        [("1", "15/05/2023 10:30"), ("2", "2023-05-15")],
        "order_id string, order_purchase_timestamp string",
    )
    result = rows(staging.clean_orders(df, "dd/MM/yyyy HH:mm"), "order_id")
    assert result[0]["order_purchase_timestamp"] == dt.datetime(2023, 5, 15, 10, 30)
    assert result[1]["order_purchase_timestamp"] is None


def test_orders_without_timestamps_pass_through(spark):
    df = spark.createDataFrame([("1", "x"), ("1", "y")], "order_id string, note string")
    assert rows(staging.clean_orders(df)) == [{"order_id": "1", "note": "x"}]


def test_customers_text(spark):
    df = spark.createDataFrame(
        [
            ("a", "\tSao Paulo\n", " sp "),
            ("b", None, None),
            ("c", "  ", "  "),
            ("d", " Rio　", "\x1crj"),
            ("a", "other", "xx"),
        ],
        "customer_id string, customer_city string, customer_state string",
    ).coalesce(1)
    result = rows(staging.clean_customers(df), "customer_id")
    assert [(r["customer_city"], r["customer_state"]) for r in result] == [
        ("sao paulo", "SP"),
        ("unknown", "UNKNOWN"),
        ("", ""),
        ("rio", "RJ"),
    ]


def test_customers_need_only_their_id(spark):
    df = spark.createDataFrame([("a",), ("a",)], "customer_id string")
    assert staging.clean_customers(df).count() == 1


def test_products_dedupe_and_unknown_category(spark):
    df = spark.createDataFrame(
        [("p1", "Toys", 1.0), ("p1", "Toys", 1.0), ("p2", None, None)],
        "product_id string, product_category_name string, product_weight_g double",
    )
    result = rows(staging.clean_products(df), "product_id")
    assert [(r["product_id"], r["product_category_name"]) for r in result] == [
        ("p1", "toys"),
        ("p2", "unknown"),
    ]


def test_products_median_fills_gaps(spark):
    df = spark.createDataFrame(
        [("p1", 10.0, None), ("p2", 30.0, None), ("p3", None, None), ("p4", float("nan"), None)],
        "product_id string, product_weight_g double, product_width_cm double",
    )
    result = rows(staging.clean_products(df), "product_id")
    assert [r["product_weight_g"] for r in result] == [10.0, 30.0, 20.0, 20.0]
    assert all(r["product_width_cm"] is None for r in result)


def test_products_median_is_of_deduplicated_rows(spark):
    data = [("p1", 10.0)] * 5 + [("p2", 30.0), ("p3", None)]
    df = spark.createDataFrame(data, "product_id string, product_weight_g double")
    result = rows(staging.clean_products(df), "product_id")
    assert [r["product_weight_g"] for r in result] == [10.0, 30.0, 20.0]


def test_products_approximate_median(spark):
    df = spark.createDataFrame(
        [("p1", 10.0), ("p2", 30.0), ("p3", 50.0), ("p4", None)],
        "product_id string, product_weight_g double",
    )
    result = rows(staging.clean_products(df, "approx"), "product_id")
    assert result[3]["product_weight_g"] == 30.0


def test_payments_keep_known_values_from_zero(spark):
    df = spark.createDataFrame(
        [
            ("1", " Voucher ", 1, float("nan")),
            ("2", None, 2, None),
            ("3", "x", 3, -1.0),
            ("4", " Credit_Card ", None, 0.0),
            ("5", None, 1, 5.0),
            ("6", "boleto", 2, 5.0),
            ("6", "boleto", 2, 5.0),
        ],
        "order_id string, payment_type string, payment_installments int, payment_value double",
    )
    result = rows(staging.clean_payments(df), "order_id")
    assert [(r["order_id"], r["payment_type"], r["is_installment"]) for r in result] == [
        ("4", "credit_card", False),
        ("5", "unknown", False),
        ("6", "boleto", True),
        ("6", "boleto", True),
    ]


def test_order_items_clip_and_total(spark):
    df = spark.createDataFrame(
        [
            ("1", None, 5.0),
            ("2", -3.0, 5.0),
            ("3", float("nan"), None),
            ("4", 2.5, 1.5),
            ("4", 2.5, 1.5),
        ],
        "order_id string, price double, shipping_charges double",
    )
    result = rows(staging.clean_order_items(df), "order_id")
    assert [r["item_total"] for r in result] == [5.0, 5.0, 0.0, 4.0, 4.0]


def test_order_items_without_shipping(spark):
    df = spark.createDataFrame([("1", -1.0)], "order_id string, price double")
    assert rows(staging.clean_order_items(df)) == [{"order_id": "1", "price": 0.0}]


def test_dedupe_drops_copies_before_the_shuffle(spark):
    df = spark.createDataFrame([("1", "x")], "order_id string, order_status string")
    text = plan(staging.clean_orders(df))
    assert text.count("WindowGroupLimit") == 2
    assert "Python" not in text

from __future__ import annotations

import datetime as dt
import json
import subprocess
import sys
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F

from cartloom.__main__ import main
from cartloom.operators import INGEST_ORDER, ingest_numbers
from cartloom.params import JobParams
from cartloom.plans import job, staging
from cartloom.plans.quality import DataQualityError
from cartloom.sinks import Attempt, attempts, latest_path, load_staging, load_warehouse, publish
from cartloom.sources import extract_all, read_csv_table, read_latest

CSV = {
    "orders": '''order_id,customer_id,order_status,order_purchase_timestamp,note
007,c1,delivered,2023-05-15 10:00:00,"x ""q"""
007,c1,canceled,2023-05-16,second
2,c2,shipped,bad,NA
3,c1,delivered,2023-05-17,
''',
    "order_items": """order_id,product_id,price,shipping_charges
007,p1,10.5,1
007,p2,-3,NaN
2,p1,abc,2.5
3,p9,4,
""",
    "customers": """customer_id,customer_city,customer_state
c1,  Rio ,rj
c2,NA,null
""",
    "products": """product_id,product_category_name,product_weight_g
p1,Toys,10
p2,,N/A
p3,Books,30
""",
    "payments": """order_id,payment_type,payment_installments,payment_value
007,credit_card,2,11.5
2,voucher,,2.5
3,boleto,1.0,-4
""",
}


@pytest.fixture
def params(tmp_path):
    for table, text in CSV.items():
        folder = tmp_path / "raw" / table
        folder.mkdir(parents=True)
        (folder / f"{table}.csv").write_text(text)
    return JobParams(
        raw_base=str(tmp_path / "raw"),
        staging_base=str(tmp_path / "staging"),
        warehouse_base=str(tmp_path / "warehouse"),
        run_date="2024-01-01",
    )


def _rewrite(params, table, text):
    with open(params.raw_path(table), "w") as f:
        f.write(text)


def test_csv_contract(spark, params):
    raw = extract_all(spark, params)
    assert list(raw) == list(params.raw_files)
    orders = rows(raw["orders"].drop(INGEST_ORDER), "order_purchase_timestamp")
    assert orders[0]["order_id"] == "007" and orders[0]["note"] == 'x "q"'
    assert [o["note"] for o in orders] == ['x "q"', "second", None, None]
    items = [r.price for r in raw["order_items"].collect()]
    assert items == [10.5, -3.0, None, 4.0]
    assert dict(raw["payments"].dtypes)["payment_installments"] == "double"
    assert [r.payment_installments for r in raw["payments"].collect()] == [2, None, 1]
    city = [r.customer_city for r in raw["customers"].collect()]
    assert city == ["  Rio ", None]


def test_missing_values(spark, tmp_path):
    texts = ["NA", "null", "", "<NA>", "-nan", "#N/A", "None", "none", " NA", "0"]
    (tmp_path / "t.csv").write_text("v,w\n" + "".join(f"{t},x\n" for t in texts))
    df = read_csv_table(spark, str(tmp_path / "t.csv"), "other")
    assert [r.v for r in df.collect()] == [None] * 7 + ["none", " NA", "0"]


def test_line_breaks_inside_quotes(spark, tmp_path):
    (tmp_path / "t.csv").write_text('v,w\n"a\nb",1\n')
    df = read_csv_table(spark, str(tmp_path / "t.csv"), "other", multi_line=True)
    assert [tuple(r) for r in df.collect()] == [("a\nb", "1")]


def test_missing_file_is_named(spark, params, tmp_path):
    gone = params.with_(raw_files={**params.raw_files, "payments": "nowhere.csv"})
    with pytest.raises(FileNotFoundError, match="payments.*nowhere.csv"):
        extract_all(spark, gone)
    with pytest.raises(KeyError):
        params.raw_path("returns")


def test_first_row_wins_over_file_blocks(spark, tmp_path):
    """Each key's first row lies in the first part of a file that is read in many pieces."""
    lines = [f"k{i % 100},{i:06d}" for i in range(20_000)]
    (tmp_path / "customers.csv").write_text("customer_id,customer_city\n" + "\n".join(lines))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        raw = read_csv_table(spark, str(tmp_path / "customers.csv"), "customers")
        assert raw.rdd.getNumPartitions() > 8
        first = staging.clean_customers(raw).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert {r.customer_id: int(r.customer_city) for r in first} == {f"k{i}": i for i in range(100)}
    assert all(INGEST_ORDER not in r for r in first[:1])


def test_first_row_wins_over_files(spark, tmp_path):
    for name, city in (("a", "first"), ("b", "second" * 400), ("c", "third")):
        (tmp_path / f"{name}.csv").write_text(f"customer_id,customer_city\nk,{city}\n")
    raw = read_csv_table(spark, str(tmp_path), "customers")
    assert [r.customer_city for r in staging.clean_customers(raw).collect()] == ["first"]


def test_row_numbers_over_files_and_splits(spark, tmp_path):
    """Row numbers follow the files by name and the rows in them, however they are split."""
    want = []
    for name in ("a", "b", "c"):
        lines = [f"k{i % 50},{name}{i:05d}" for i in range(4000)]
        (tmp_path / f"{name}.csv").write_text("customer_id,customer_city\n" + "\n".join(lines))
        want += [line.split(",")[1] for line in lines]
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        raw = ingest_numbers(read_csv_table(spark, str(tmp_path), "customers"))
        assert raw.rdd.getNumPartitions() > 8
        got = raw.orderBy("row_number").collect()
        first = staging.clean_customers(raw).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [r.customer_city for r in got] == want and [r.row_number for r in got] == list(range(1, 12_001))
    assert sorted(r.row_number for r in first) == list(range(1, 51))


def test_snapshots_by_date_and_latest(spark, params):
    def run(date, values):
        table = spark.createDataFrame([(v,) for v in values], "x int")
        load_staging({"orders": table}, params.with_(run_date=date))

    run("2024-01-01", [1, 2, 3])
    run("2024-01-01", [])
    assert spark.read.parquet(f"{params.staging_base}/orders").count() == 0
    run("2024-01-01", [1, 2])
    run("2024-01-02", [9])
    dated = spark.read.parquet(f"{params.staging_base}/orders")
    assert {(str(r.dt), r.x) for r in dated.collect()} == {
        ("2024-01-01", 1),
        ("2024-01-01", 2),
        ("2024-01-02", 9),
    }
    latest = read_latest(spark, params.staging_base, "orders")
    assert [tuple(r) for r in latest.collect()] == [(9,)]
    assert latest.columns == ["x"]


def test_only_latest_or_only_dated(spark, params, tmp_path):
    table = {"t": spark.range(3)}
    load_staging(table, params.with_(write_partitioned=False))
    assert read_latest(spark, params.staging_base, "t").count() == 3
    assert not (tmp_path / "staging" / "t").exists()
    load_warehouse(table, {}, params.with_(write_latest=False))
    with pytest.raises(FileNotFoundError, match="'t'"):
        read_latest(spark, params.warehouse_base, "t")


def test_a_failed_rename_undoes_all(spark, params, tmp_path, monkeypatch):
    old = {"a": spark.range(2), "b": spark.range(3)}
    load_staging(old, params)
    attempt = Attempt(spark, params.staging_base, params)
    attempt.write({"a": spark.range(20), "b": spark.range(30), "c": spark.range(40)})
    assert read_latest(spark, params.staging_base, "a").count() == 2
    rename = attempt._rename

    def broken(source, target):
        if "/copy/" in source and target.endswith("latest/b"):
            raise OSError("no")
        rename(source, target)

    monkeypatch.setattr(attempt, "_rename", broken)
    with pytest.raises(OSError):
        attempt.publish()
    attempt.drop()
    assert [read_latest(spark, params.staging_base, t).count() for t in "ab"] == [2, 3]
    assert [spark.read.parquet(f"{params.staging_base}/{t}").count() for t in "ab"] == [2, 3]
    assert not (tmp_path / "staging/c").exists() or not list((tmp_path / "staging/c").iterdir())
    assert not list((tmp_path / "staging").glob("_attempt*"))


def test_each_layer_is_written_once(spark, params, monkeypatch):
    """One write per built table, and one copy of its files for the second place."""
    paths = []
    save = attempts.save_parquet
    monkeypatch.setattr(attempts, "save_parquet", lambda df, path: paths.append(path) or save(df, path))
    job.run(spark, params)
    built = [p for p in paths if "/new/" in p]
    assert len(built) == len(set(built)) == 5 + 6 + 7 and len(paths) == 2 * len(built)
    paths.clear()
    job.run(spark, params.with_(write_partitioned=False))
    assert len(paths) == 18


def test_mart_wins_on_a_name_clash(spark, params):
    load_warehouse({"t": spark.range(3)}, {"t": spark.range(5)}, params)
    assert read_latest(spark, params.warehouse_base, "t").count() == 5


def test_a_column_named_dt_is_refused(spark, params):
    with pytest.raises(ValueError, match="dt"):
        load_staging({"t": spark.sql("select 1 as dt")}, params)


def test_publish_replaces_tables(spark, params):
    spark.sql("create database if not exists shop_out")
    on = params.with_(publish_enabled=True, publish_database="shop_out")
    assert publish({"t": spark.range(3)}, params) == []
    with pytest.raises(ValueError, match="publish_database"):
        publish({"t": spark.range(3)}, on.with_(publish_database=""))
    publish({"t": spark.range(3)}, on)
    assert publish({"t": spark.range(5).withColumn("y", F.lit(1))}, on) == ["shop_out.t"]
    assert spark.table("shop_out.t").count() == 5 and spark.table("shop_out.t").columns == ["id", "y"]
    spark.sql("drop database shop_out cascade")


def test_a_failed_publish_leaves_the_old_tables(spark, params):
    spark.sql("create database if not exists shop_kept")
    on = params.with_(publish_enabled=True, publish_database="shop_kept")
    publish({"a": spark.range(3), "b": spark.range(4)}, on)
    broken = spark.range(9).selectExpr("if(id = 8, raise_error('broken row'), id) as id")
    with pytest.raises(Exception, match="broken row"):
        publish({"a": spark.range(30), "b": broken}, on)
    assert [spark.table(f"shop_kept.{t}").count() for t in "ab"] == [3, 4]
    assert {t.name for t in spark.catalog.listTables("shop_kept")} == {"a", "b"}
    spark.sql("drop database shop_kept cascade")


def test_publish_through_a_connector(spark, params, tmp_path):
    on = params.with_(
        publish_enabled=True,
        publish_database="any",
        publish_format="parquet",
        publish_options={"path": str(tmp_path / "out" / "{table}")},
    )
    publish({"a": spark.range(2), "b": spark.range(4)}, on)
    assert spark.read.parquet(str(tmp_path / "out" / "b")).count() == 4


def test_the_whole_job(spark, params):
    result = job.run(spark, params)
    counts = {(r.table, r.step): r.rows for r in result.metrics.collect()}
    assert counts[("orders", "read")] == 4 and counts[("orders", "built")] == 3
    assert counts[("products", "read")] == 3 and counts[("products", "built")] == 3
    assert counts[("payments", "read")] == 3 and counts[("payments", "built")] == 2
    assert counts[("payments", "dropped_negative")] == 1
    assert counts[("payments", "dropped_missing")] == 0
    day = rows(read_latest(spark, params.warehouse_base, "mart_revenue_by_day"), "order_date")
    assert day == [
        {"order_date": dt.date(2023, 5, 15), "revenue": 11.5, "orders": 1},
        {"order_date": dt.date(2023, 5, 17), "revenue": 4.0, "orders": 1},
    ]
    report = job.check_published(spark, params)
    assert {r.violations for r in report.violations.collect()} == {0}
    assert "fact_orders.describe" in report.profiles
    assert report.profiles["fact_orders.revenue_totals"].first().total_order_value == 15.5
    assert report.profiles["dim_date.range"].first().max_date == dt.date(2023, 5, 17)
    assert report.profiles["mart_top_products.head"].count() <= 3

    def content():
        frames = {t: read_latest(spark, params.warehouse_base, t) for t in job.OUTPUT_VIEWS}
        return {t: sorted(map(str, df.collect())) for t, df in frames.items()}

    before = content()
    job.run(spark, params)
    assert content() == before
    dated = spark.read.parquet(f"{params.warehouse_base}/fact_orders")
    assert dated.count() == 3
    by_day = before["mart_revenue_by_day"]
    assert len(by_day) == 2 and len(before["fact_orders"]) == 3


def test_counts_with_a_task_that_fails_once(params, tmp_path):
    """A session of its own, which tries tasks again: counts are those of the rows."""
    code = f"""
import sys
sys.path[:0] = ['{Path(__file__).resolve().parent.parent}']
from pyspark import TaskContext
from cartloom.params import JobParams
from cartloom.plans import job
from cartloom.session import local_session
from cartloom.sources import extract_all
spark = local_session("2, 3", **{{"spark.sql.shuffle.partitions": "2", "spark.checkpoint.dir": '{tmp_path}/work'}})
params = JobParams(raw_base='{params.raw_base}', staging_base='{params.staging_base}', warehouse_base='{params.warehouse_base}', run_date='2024-01-01')

def flaky(batches):
    for batch in batches:
        yield batch
    if TaskContext.get().attemptNumber() == 0:
        raise RuntimeError('lost')

raw = extract_all(spark, params)
raw['payments'] = raw['payments'].mapInArrow(flaky, raw['payments'].schema)
result = job.run(spark, params, raw)
print('COUNTS', sorted((r.table, r.step, r.rows) for r in result.metrics.collect() if r.table == 'payments'))
"""
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300)
    assert "lost" in done.stderr, done.stderr[-2000:]
    want = [("payments", "built", 2), ("payments", "dropped_missing", 0), ("payments", "dropped_negative", 1), ("payments", "read", 3), ("payments", "written", 2)]
    assert f"COUNTS {want}" in done.stdout, done.stderr[-2000:]


def test_profiles_of_published_tables(spark, params):
    job.run(spark, params)
    found = {(r.table, r.part, r.item, r.measure, r.text): r.value for r in job.profile_published(spark, params).collect()}
    assert found["fact_orders", "shape", "", "rows", None] == 3 and found["dim_date", "shape", "", "rows", None] == 3
    assert found["fact_orders", "nulls", "order_purchase_timestamp", "count", None] == 1
    assert found["fact_orders", "duplicates", "order_id", "count", None] == 0
    assert found["fact_orders", "frequency", "order_status", "count", "delivered"] == 2
    assert found["fact_orders", "totals", "total_order_value", "sum", None] == 15.5
    assert found["dim_date", "range", "date", "max", "2023-05-17"] is None
    report = job.check_published(spark, params)
    for r in report.profiles["fact_orders.describe"].collect():
        for m in ("count", "mean", "std", "min", "q25", "q50", "q75", "max"):
            assert found["fact_orders", "describe", r.column, m, None] == (pytest.approx(r[m]) if r[m] is not None else None)


def test_a_failed_validation_writes_nothing(spark, params, tmp_path):
    _rewrite(params, "orders", "order_id,customer_id,order_status\n1,c1,lost\n,c1,delivered\n")
    with pytest.raises(DataQualityError, match="lost"):
        job.run(spark, params)
    assert not (tmp_path / "staging").exists() and not (tmp_path / "warehouse").exists()


def test_an_empty_mart_stops_after_staging(spark, params, tmp_path):
    header = CSV["payments"].splitlines()[0]
    _rewrite(params, "payments", header + "\n")
    with pytest.raises(DataQualityError, match="mart_payment_method_summary"):
        job.run(spark, params)
    assert (tmp_path / "staging").exists() and not (tmp_path / "warehouse").exists()
    assert latest_path(params.staging_base, "payments")


def test_command_line(spark, params, tmp_path, capsys):
    fields = ("raw_base", "staging_base", "warehouse_base", "run_date", "valid_order_statuses")
    config = tmp_path / "params.json"
    config.write_text(json.dumps({f: getattr(params, f) for f in fields}))
    main(["run", "--params", str(config)])
    assert "mart_customer_geo" in capsys.readouterr().out
    main(["check", "--params", str(config)])
    assert "fact_orders.describe" in capsys.readouterr().out
    only = job.check_published(spark, params, only=("dim_date",))
    assert set(only.profiles) >= {"dim_date.range", "dim_date.duplicates"}
    with pytest.raises(FileNotFoundError):
        job.check_published(spark, params.with_(warehouse_base=str(tmp_path / "none")))


def test_run_date():
    assert JobParams().run_date == dt.date.today().isoformat()
    with pytest.raises(ValueError):
        JobParams(run_date="yesterday")

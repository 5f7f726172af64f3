"""The benchmark's Parquet tables seen as the five raw tables.

The mapping adds dirt (bad dates, negative and missing numbers, padded text, unknown products)
so that every cleaning step has work to do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cartloom.operators.dedupe import INGEST_ORDER
from cartloom.schemas import KEYED_TABLES

# Plain SQL, so that a check in another engine can start from the same raw tables.
RAW_SQL = {
    "orders": """
        select o_orderkey as order_id, o_custkey as customer_id,
          case o_orderstatus when 'F' then 'delivered' when 'O' then 'shipped'
            else 'processing' end as order_status,
          case when o_orderkey % 97 = 0 then 'not-a-date'
            else cast(o_orderdate as string) end as order_purchase_timestamp
        from {orders}""",
    "order_items": """
        select l_orderkey as order_id,
          case when l_partkey % 59 = 0 then l_partkey + 1000000 else l_partkey end as product_id,
          case when l_partkey % 53 = 0 then null when l_partkey % 47 = 0 then -l_extendedprice
            else l_extendedprice end as price,
          l_quantity as shipping_charges
        from {lineitem}""",
    "customers": """
        select c_custkey as customer_id, concat('  ', n_name, ' ') as customer_city,
          case when c_custkey % 29 = 0 then null else lower(r_name) end as customer_state
        from {customer} join {nation} on c_nationkey = n_nationkey
          join {region} on n_regionkey = r_regionkey""",
    "products": """
        select p_partkey as product_id,
          case when p_partkey % 31 = 0 then null else p_type end as product_category_name,
          cast(nullif(p_size, 50) as double) as product_weight_g
        from {part}""",
    "payments": """
        select cast(floor(event_id / 2) as bigint) as order_id,
          case event_type when 'purchase' then ' Credit_Card ' when 'signup' then 'VOUCHER'
            when 'view' then 'boleto' when 'click' then 'debit_card' end as payment_type,
          case when event_id % 11 = 0 then null
            else cast(event_id % 4 as int) end as payment_installments,
          case when event_id % 41 = 0 then -value when event_id % 37 = 0 then value + 0.00004e0 when event_id % 43 = 0 then null
            else value end as payment_value
        from {events}""",
}

# The benchmark table whose rows are the rows of a keyed raw table.
KEYED_SOURCES = {"orders": "orders", "customers": "customer", "products": "part"}

SOURCE_TABLES = ("orders", "lineitem", "customer", "nation", "region", "part", "events")


def read_benchmark(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{table}.parquet")


def raw_from_benchmark(
    spark: SparkSession, folder: str, tables: tuple[str, ...] = tuple(RAW_SQL)
) -> dict[str, DataFrame]:
    """The raw tables; keyed ones also get their ingest order, taken before any join."""
    raw = {}
    for table in tables:
        sql = RAW_SQL[table]
        inputs = {t: read_benchmark(spark, folder, t) for t in SOURCE_TABLES if f"{{{t}}}" in sql}
        if table in KEYED_TABLES:
            source = KEYED_SOURCES[table]
            inputs[source] = inputs[source].selectExpr("*", f"{FILE_POSITION} as {INGEST_ORDER}")
            sql = sql.replace("select ", f"select {INGEST_ORDER}, ", 1)
        raw[table] = spark.sql(sql, **inputs)
    return raw


# Sortable input position: file and row.
FILE_POSITION = "struct(_metadata.file_path as path, _metadata.row_index as row)"

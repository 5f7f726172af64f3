"""SQL counterparts of the registered queries, over the same tables.

Each statement starts from the raw tables of ``RAW_SQL`` and restates staging, facts and marts
in SQL, using only the common table expressions it needs.
"""

from __future__ import annotations

import re

from cartloom.queries.money_columns import MONEY_COLUMNS
from cartloom.schemas import MART_TABLES, REQUIRED_FACT_COLUMNS
from cartloom.sources.benchmark_tables import RAW_SQL, SOURCE_TABLES


def _sum(c: str) -> str:
    return f"coalesce(fsum(cast({c} as double)), 0.0)"


def _rows(c: str = "*") -> str:
    return f"cast(count({c}) as bigint)"


# Common table expressions in order of use.
CTES = {f"raw_{t}": sql.format(**{s: s for s in SOURCE_TABLES}) for t, sql in RAW_SQL.items()}
CTES |= {
    "parsed_orders": """
        select order_id, customer_id, order_status,
          try_cast(order_purchase_timestamp as timestamp) as order_purchase_timestamp
        from (select distinct on (order_id) * from raw_orders)""",
    "stg_orders": """
        select *, cast(order_purchase_timestamp as date) as order_date,
          cast(year(order_purchase_timestamp) as int) as order_year,
          cast(month(order_purchase_timestamp) as int) as order_month,
          cast(quarter(order_purchase_timestamp) as int) as order_quarter,
          dayname(order_purchase_timestamp) as order_dow
        from parsed_orders""",
    "stg_customers": """
        select customer_id, trim(lower(coalesce(customer_city, 'unknown'))) as customer_city,
          trim(upper(coalesce(customer_state, 'unknown'))) as customer_state
        from (select distinct on (customer_id) * from raw_customers)""",
    "first_products": "select distinct on (product_id) * from raw_products",
    "stg_products": """
        select product_id,
          trim(lower(coalesce(product_category_name, 'unknown'))) as product_category_name,
          coalesce(product_weight_g, (select median(product_weight_g) from first_products))
            as product_weight_g
        from first_products""",
    "stg_payments": """
        select order_id, trim(lower(coalesce(payment_type, 'unknown'))) as payment_type,
          payment_installments, payment_value,
          coalesce(payment_installments > 1, false) as is_installment
        from raw_payments where payment_value >= 0""",
    "clean_items": """
        select order_id, product_id, greatest(coalesce(price, 0.0), 0.0) as price,
          greatest(coalesce(shipping_charges, 0.0), 0.0) as shipping_charges
        from raw_order_items""",
    "stg_order_items": """
        select *, price + shipping_charges as item_total from clean_items""",
    "payment_summary": f"""
        select order_id, {_sum("payment_value")} as total_payment_value,
          {_rows("distinct payment_type")} as payment_methods_count,
          max(payment_installments) as max_installments,
          bool_or(payment_type = 'voucher') as has_voucher,
          bool_or(payment_type = 'credit_card') as has_credit_card,
          coalesce(max(payment_installments) > 1, false) as is_installment
        from stg_payments group by order_id""",
    "item_totals": f"""
        select order_id, {_sum("price")} as total_item_revenue,
          {_sum("shipping_charges")} as total_shipping_cost, {_rows("product_id")} as item_count
        from stg_order_items group by order_id""",
    "order_totals": """
        select o.*, coalesce(i.total_item_revenue, 0.0) as total_item_revenue,
          coalesce(i.total_shipping_cost, 0.0) as total_shipping_cost,
          coalesce(i.item_count, 0) as item_count,
          coalesce(p.total_payment_value, 0.0) as total_payment_value,
          coalesce(p.payment_methods_count, 0) as payment_methods_count, p.max_installments,
          coalesce(p.has_voucher, false) as has_voucher,
          coalesce(p.has_credit_card, false) as has_credit_card,
          coalesce(p.is_installment, false) as is_installment
        from stg_orders o left join item_totals i on o.order_id = i.order_id
          left join payment_summary p on o.order_id = p.order_id""",
    "fact_orders": """
        select *, total_item_revenue + total_shipping_cost as total_order_value,
          total_payment_value - (total_item_revenue + total_shipping_cost) as payment_diff
        from order_totals""",
    "fact_order_items": """
        select i.*, o.customer_id, o.order_status, o.order_purchase_timestamp, o.order_date,
          p.product_category_name
        from stg_order_items i join stg_orders o on i.order_id = o.order_id
          left join stg_products p on i.product_id = p.product_id""",
    "days": """
        select unnest(generate_series(cast(min(order_date) as timestamp),
          cast(max(order_date) as timestamp), interval 1 day)) as d from stg_orders""",
    "dim_date": """
        select cast(d as date) as date, cast(strftime(d, '%Y%m%d') as int) as date_id,
          cast(year(d) as int) as year, cast(quarter(d) as int) as quarter,
          cast(month(d) as int) as month, monthname(d) as month_name,
          cast(day(d) as int) as day, cast(isodow(d) - 1 as int) as day_of_week,
          cast(weekofyear(d) as int) as week_of_year, isodow(d) >= 6 as is_weekend
        from days""",
    "mart_revenue_by_day": f"""
        select order_date, {_sum("total_order_value")} as revenue, {_rows("order_id")} as orders
        from fact_orders where order_status = 'delivered' and order_date is not null
        group by order_date""",
    "mart_revenue_by_month": f"""
        select order_year, order_month, {_sum("total_order_value")} as revenue,
          {_rows("order_id")} as orders
        from fact_orders where order_status = 'delivered' and order_year is not null
        group by order_year, order_month""",
    "mart_revenue_by_category": f"""
        select product_category_name, {_sum("item_total")} as revenue,
          {_rows("order_id")} as items_sold
        from fact_order_items
        where order_status = 'delivered' and product_category_name is not null
        group by product_category_name""",
    "mart_payment_method_summary": f"""
        select payment_type, {_sum("payment_value")} as total_value,
          {_rows("order_id")} as transaction_count
        from stg_payments where payment_type is not null group by payment_type""",
    "mart_order_status_daily": f"""
        select order_date, order_status, {_rows("order_id")} as order_count
        from fact_orders where order_date is not null and order_status is not null
        group by order_date, order_status""",
    "mart_top_products": f"""
        select product_id, product_category_name, {_sum("item_total")} as revenue,
          {_rows("order_id")} as quantity
        from fact_order_items
        where order_status = 'delivered' and product_category_name is not null
        group by product_id, product_category_name""",
    "mart_customer_geo": f"""
        select c.customer_state, c.customer_city, {_sum("f.total_order_value")} as revenue,
          {_rows("f.order_id")} as orders, {_rows("distinct f.customer_id")} as unique_customers
        from fact_orders f join stg_customers c on f.customer_id = c.customer_id
        where f.order_status = 'delivered' group by c.customer_state, c.customer_city""",
}


def _needed(sql: str) -> list[str]:
    names = set(re.findall(r"\w+", sql)) & set(CTES)
    every = set(names)
    for name in names:
        every |= set(_needed(CTES[name].replace(name, "")))
    return [name for name in CTES if name in every]


def _with(sql: str) -> str:
    parts = ",\n".join(f"{name} as ({CTES[name]})" for name in _needed(sql))
    return f"with {parts}\n{sql}" if parts else sql


def _table(name: str) -> str:
    return f"select * from {name}"


def _rule(layer: str, table: str, rule: str, column: str, source: str, count: str) -> str:
    return (
        f"""select '{layer}' as layer, '{table}' as "table", '{rule}' as rule, """
        f"""'{column}' as "column", cast({count} as bigint) as violations from {source}"""
    )


def _not_null(c: str) -> tuple[str, str, str]:
    return "not_null", c, f"count(*) - count({c})"


def _unique(c: str) -> tuple[str, str, str]:
    keys = " || '/' || ".join(f"coalesce(cast({k} as varchar), '-')" for k in c.split(","))
    return "unique", c, f"count(*) - count(distinct {keys})"


def _positive(c: str) -> tuple[str, str, str]:
    return "non_negative", c, f"count(case when {c} < 0 then 1 end)"


def _filled(c: str = "*") -> tuple[str, str, str]:
    return "not_empty", c, "case when count(*) = 0 then 1 else 0 end"


def _rules(layer: str, prefix: str, rules: dict[str, list[tuple[str, str, str]]]) -> str:
    return "\nunion all\n".join(
        _rule(layer, table, rule, column, prefix + table, count)
        for table, checks in rules.items()
        for rule, column, count in checks
    )


def _staging_rules(prefix: str, allowed: str) -> str:
    status = f"count(*) - count(case when order_status in ({allowed}) then 1 end)"
    return _rules(
        "staging",
        prefix,
        {
            "orders": [
                _not_null("order_id"),
                _unique("order_id"),
                _not_null("customer_id"),
                ("allowed_values", "order_status", status),
            ],
            "customers": [_not_null("customer_id"), _unique("customer_id")],
            "products": [_not_null("product_id"), _unique("product_id")],
            "payments": [_not_null("order_id"), _positive("payment_value")],
            "order_items": [
                _not_null("order_id"),
                _not_null("product_id"),
                _positive("price"),
                _positive("shipping_charges"),
            ],
        },
    )


ALL_STATUSES = (
    "'delivered','shipped','canceled','processing','invoiced','unavailable','approved','created'"
)
# The published fact_payments and keyed dimensions are the staged tables.
STAGED_AS = {
    "fact_payments": "stg_payments",
    "dim_customers": "stg_customers",
    "dim_products": "stg_products",
}


def _published(sql: str) -> str:
    for name, staged in STAGED_AS.items():
        sql = sql.replace(f"from {name}", f"from {staged}")
    return sql


def _warehouse_rules() -> str:
    facts = _rules(
        "warehouse",
        "",
        {
            "fact_orders": [
                _not_null("order_id"),
                _unique("order_id"),
                _not_null("customer_id"),
                _positive("total_order_value"),
            ],
            "fact_order_items": [
                _not_null("order_id"),
                _not_null("product_id"),
                _positive("item_total"),
            ],
            "fact_payments": [_not_null("order_id"), _positive("payment_value")],
            "dim_customers": [_not_null("customer_id"), _unique("customer_id")],
            "dim_products": [_not_null("product_id"), _unique("product_id")],
        },
    )
    marts = _rules("mart", "", {m: [_filled()] for m in MART_TABLES})
    return _published(f"{facts}\nunion all\n{marts}")


def _output_rules() -> str:
    amounts = {"mart_payment_method_summary": "total_value"}
    rules = {
        "dim_customers": [_not_null("customer_id"), _unique("customer_id")],
        "dim_products": [
            _not_null("product_id"),
            _not_null("product_category_name"),
            _unique("product_id"),
        ],
        "dim_date": [_unique("date_id")],
        "fact_payments": [_not_null("order_id"), _positive("payment_value")],
        "fact_order_items": [_not_null("order_id"), _not_null("product_id")],
        "fact_orders": [_not_null("order_id"), _unique("order_id")],
    }
    for mart in MART_TABLES:
        rules[mart] = [_filled()]
        if mart != "mart_order_status_daily":
            rules[mart].append(_positive(amounts.get(mart, "revenue")))
    return _published(_rules("output", "", rules))


def _frequency(table: str, column: str, limit: int | None = None) -> str:
    return (
        f"""select {column}, {_rows()} as "count" from {table} where {column} is not null """
        f"""group by {column} order by "count" desc, {column}"""
        + (f" limit {limit}" if limit else "")
    )


def _describe(table: str, columns: list[str]) -> str:
    def one(c: str) -> str:
        quantiles = ", ".join(
            f"round(quantile_cont(cast({c} as double), {p}), 6) as {name}"
            for p, name in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75"))
        )
        return (
            f"""select '{c}' as "column", {_rows(c)} as "count", round(avg({c}), 6) as mean, """
            f"""round(stddev_samp({c}), 6) as std, round(cast(min({c}) as double), 6) as "min", """
            f"""{quantiles}, round(cast(max({c}) as double), 6) as "max" from {table}"""
        )

    return "\nunion all\n".join(one(c) for c in columns)


def _quantiles() -> str:
    parts = [
        f"""select '{c}' as "column", cast({p} as double) as probability,
          round(quantile_cont({c}, {p}), 6) as quantile from lineitem"""
        for c in ("l_quantity", "l_extendedprice", "l_discount")
        for p in (0.0, 0.1, 0.25, 0.5, 0.9, 1.0)
    ]
    return "\nunion all\n".join(parts)


def _nulls(table: str, columns: tuple[str, ...]) -> str:
    parts = [
        f"""select '{c}' as "column", cast(count(*) - count({c}) as bigint) as nulls from {table}"""
        for c in columns
    ]
    return "select * from (" + "\nunion all\n".join(parts) + ") where nulls > 0"


def _shapes() -> str:
    columns = {
        "orders": "order_id, customer_id, order_status, order_purchase_timestamp",
        "order_items": "order_id, product_id, price, shipping_charges",
        "customers": "customer_id, customer_city, customer_state",
        "products": "product_id, product_category_name, product_weight_g",
        "payments": "order_id, payment_type, payment_installments, payment_value",
    }
    parts = [
        f"""select '{t}' as "table", {_rows()} as "rows",
          {len(c.split(","))} as columns, '{c}' as column_list from raw_{t}"""
        for t, c in columns.items()
    ]
    return "\nunion all\n".join(parts)


def _missing() -> str:
    have = {
        "fact_orders": ("orders", "order_id customer_id order_status order_purchase_timestamp"),
        "fact_order_items": ("order_items", "order_id product_id price shipping_charges"),
        "fact_payments": (
            "payments",
            "order_id payment_type payment_installments payment_value",
        ),
    }
    parts = []
    for fact, (table, columns) in have.items():
        missing = [c for c in REQUIRED_FACT_COLUMNS[fact] if c not in columns.split()]
        parts.append(
            f"""select '{fact}' as "table", {_rows()} as "rows",
              '{",".join(missing)}' as missing from raw_{table}"""
        )
    return "\nunion all\n".join(parts)


def _job_rows() -> str:
    sources = {("read", t): f"raw_{t}" for t in RAW_SQL}
    sources |= {("built", t): f"stg_{t}" for t in RAW_SQL}
    sources |= {("built", t): t for t in ("dim_date", "fact_orders", "fact_order_items")}
    sources |= {("built", m): m for m in MART_TABLES}
    sources |= {("written", t): f"stg_{t}" for t in RAW_SQL}
    staged = {"dim_customers": "customers", "dim_products": "products", "fact_payments": "payments"}
    sources |= {("written", t): f"stg_{source}" for t, source in staged.items()}
    sources |= {("written", t): t for t in ("dim_date", "fact_orders", "fact_order_items", *MART_TABLES)}
    parts = [
        f"""select '{table}' as "table", '{step}' as step, {_rows()} as "rows" from {source}"""
        for (step, table), source in sources.items()
    ]
    parts += [
        f"""select 'payments' as "table", '{step}' as step, {_rows()} as "rows"
          from raw_payments where payment_value {condition}"""
        for step, condition in (("dropped_negative", "< 0"), ("dropped_missing", "is null"))
    ]
    return "\nunion all\n".join(parts)


def _snapshots() -> str:
    one = f"""{_rows()} as "rows", {_sum("payment_value")} as total_value from stg_payments"""
    return "\nunion all\n".join(
        f"select '{dt}' as dt, {one}" for dt in ("2024-01-01", "2024-01-02", "latest")
    )


def _profiles() -> str:
    """Every profile of every published table, in one long table."""

    def rows(table: str, part: str, item: str, measure: str, value: str, source: str, text: str = "cast(null as varchar)") -> str:
        return (
            f"""select '{table}' as "table", '{part}' as part, {item} as item, '{measure}' as measure,"""
            f""" round(cast({value} as double), 4) as value, {text} as text from {source}"""
        )

    keys = {"fact_orders": "order_id", "dim_customers": "customer_id", "dim_products": "product_id", "dim_date": "date_id"}
    numbers = {
        "fact_orders": "total_item_revenue total_shipping_cost total_order_value total_payment_value payment_diff item_count",
        "fact_order_items": "price shipping_charges item_total",
        "fact_payments": "payment_value",
    }
    frequency = {
        "fact_orders": ("order_status", 10**6),
        "fact_order_items": ("product_category_name", 10),
        "fact_payments": ("payment_type", 10**6),
        "dim_customers": ("customer_state", 10),
        "dim_products": ("product_category_name", 10),
    }
    parts = []
    for t in ("fact_orders", "fact_order_items", "fact_payments", "dim_customers", "dim_products", "dim_date", *MART_TABLES):
        gaps = f"(unpivot (select sum(case when columns(*) is null then 1 else 0 end) as \"\\0\" from {t}) on columns(*) into name item value n)"
        parts.append(rows(t, "shape", "''", "rows", "count(*)", t))
        parts.append(rows(t, "shape", "''", "columns", "count(*)", gaps))
        parts.append(rows(t, "nulls", "item", "count", "n", f"{gaps} where n > 0"))
        if t in keys:
            parts.append(rows(t, "duplicates", f"'{keys[t]}'", "count", f"count(*) - count(distinct {keys[t]})", t))
        for c in numbers.get(t, "").split():
            measures = {"count": f"count({c})", "mean": f"avg({c})", "std": f"stddev_samp({c})", "min": f"min({c})", "max": f"max({c})"}
            measures |= {f"q{round(100 * p)}": f"quantile_cont(cast({c} as double), {p})" for p in (0.25, 0.5, 0.75)}
            parts += [rows(t, "describe", f"'{c}'", m, sql, t) for m, sql in measures.items()]
        if t in frequency:
            c, most = frequency[t]
            top = f"(select {c}, count(*) as n from {t} where {c} is not null group by {c} order by n desc, {c} limit {most})"
            parts.append(rows(t, "frequency", f"'{c}'", "count", "n", top, c))
    for c in ("total_order_value", "total_payment_value"):
        parts.append(rows("fact_orders", "totals", f"'{c}'", "sum", _sum(c), "fact_orders where order_status = 'delivered'"))
    for m in ("min", "max"):
        parts.append(rows("dim_date", "range", "'date'", m, "null", "dim_date", f"cast({m}(date) as varchar)"))
    return _published("\nunion all\n".join(parts))


FACT_ORDER_COLUMNS = (
    "order_id",
    "customer_id",
    "order_status",
    "order_purchase_timestamp",
    "order_date",
    "order_year",
    "order_month",
    "order_quarter",
    "order_dow",
    "max_installments",
    "payment_diff",
)

_SQL = {
    **{t: _table(t) for t in CTES if t.startswith(("stg_", "mart_"))},
    "dedupe_first_orders": """
        select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
        from (select *, row_number() over (partition by o_custkey order by o_orderkey) as n
          from orders) where n = 1""",
    "median_impute": """
        with gaps as (select o_orderkey as order_id,
            case when o_orderkey % 5 = 0 then null else o_totalprice end as total_price,
            case when o_orderkey % 5 = 0 then cast(o_custkey as double) end as customer_number
          from orders)
        select order_id,
          coalesce(total_price, (select median(total_price) from gaps)) as total_price,
          coalesce(customer_number, (select median(customer_number) from gaps))
            as customer_number
        from gaps""",
    "quantiles_exact": _quantiles(),
    "dim_customers": _table("stg_customers"),
    "dim_products": _table("stg_products"),
    "dim_date": _table("dim_date"),
    "payment_summary": _table("payment_summary"),
    "fact_orders": _table("fact_orders"),
    "fact_order_items": _table("fact_order_items"),
    "fact_payments": _table("stg_payments"),
    "top_products_k": "select * from mart_top_products order by revenue desc, product_id limit 25",
    "dq_staging": _staging_rules("stg_", ALL_STATUSES),
    "dq_raw": _staging_rules("raw_", "'delivered'"),
    "dq_invalid_values": f"""select order_status, {_rows()} as "rows" from raw_orders
        where order_status <> 'delivered' or order_status is null group by order_status""",
    "dq_warehouse": _warehouse_rules(),
    "dq_unique_composite": _rules(
        "benchmark",
        "",
        {"lineitem": [_unique("l_orderkey,l_partkey")], "events": [_unique("user_id,event_type")]},
    ),
    "dq_required_columns": _missing(),
    "profile_shape": _shapes(),
    "profile_nulls": _nulls("fact_orders", FACT_ORDER_COLUMNS),
    "profile_duplicates": f"""select cast({_unique("order_id,payment_type")[2]} as bigint)
        as duplicates from stg_payments""",
    "profile_numeric": _describe(
        "fact_orders",
        [
            "total_item_revenue",
            "total_shipping_cost",
            "total_order_value",
            "total_payment_value",
            "payment_diff",
            "item_count",
        ],
    ),
    "profile_numeric_items": _describe(
        "stg_order_items", ["price", "shipping_charges", "item_total"]
    ),
    "profile_numeric_payments": _describe("stg_payments", ["payment_value"]),
    "profile_frequency": _frequency("stg_orders", "order_status"),
    "profile_frequency_payments": _frequency("stg_payments", "payment_type"),
    "profile_top10": _frequency("fact_order_items", "product_category_name", 10),
    "profile_top10_states": _frequency("stg_customers", "customer_state", 10),
    "profile_delivered_totals": f"""
        select {_sum("total_order_value")} as total_order_value,
          {_sum("total_payment_value")} as total_payment_value
        from fact_orders where order_status = 'delivered'""",
    "profile_date_range": "select min(date) as min_date, max(date) as max_date from dim_date",
    "sorted_mart_latest": """
        select product_id, product_category_name, quantity,
          cast(row_number() over (order by round(revenue, 6) desc, product_id) as int) as place
        from mart_top_products""",
    "fact_order_items_salted": """
        select i.order_id, i.product_id, i.price, p.product_category_name
        from (select order_id, case when order_id % 3 = 0 then 7 else product_id end as product_id, price
          from stg_order_items) i left join stg_products p on i.product_id = p.product_id""",
    "csv_roundtrip": """
        select * replace (cast(order_id as varchar) as order_id,
          cast(customer_id as varchar) as customer_id,
          cast(max_installments as double) as max_installments) from fact_orders""",
    "snapshot_rerun": _snapshots(),
    "publish_replace": _table("mart_payment_method_summary"),
    "csv_first_rows": """
        with lines as (select *, row_number() over (order by l_shipdate, l_orderkey, l_linenumber) as row_number from lineitem)
        select cast(l_orderkey as varchar) as order_id, l_linenumber as line, strftime(l_shipdate, '%Y-%m-%d') as shipped,
          cast(row_number as bigint) as row_number
        from lines qualify row_number() over (partition by l_orderkey order by lines.row_number) = 1""",
    "fact_orders_no_payments": _table("fact_orders"),
    "marts_no_items": f"""
        select order_year || '-' || order_month as period, {_sum("total_order_value")} as revenue, {_rows("order_id")} as orders
        from fact_orders where order_status = 'delivered' and order_year is not null group by order_year, order_month
        union all
        select product_category_name, {_sum("item_total")}, {_rows("order_id")} from fact_order_items
        where order_status = 'delivered' and product_category_name is not null group by product_category_name""",
    "published_profiles": _profiles(),
    "job_row_counts": _job_rows(),
    "job_output_check": _output_rules(),
}

def _to_six_places(name: str, sql: str) -> str:
    columns = MONEY_COLUMNS.get(name, ())
    rounded = ", ".join(f"round({c}, 6) as {c}" for c in columns)
    return f"select * replace ({rounded}) from ({sql}) as money" if columns else sql


# Queries over a raw table without rows.
EMPTY = {"fact_orders_no_payments": "payments", "marts_no_items": "order_items"}


def _emptied(name: str, sql: str) -> str:
    return sql.replace(f"from raw_{EMPTY[name]}", f"from (select * from raw_{EMPTY[name]} where false)") if name in EMPTY else sql


ORACLE = {name: _emptied(name, _to_six_places(name, _with(sql))) for name, sql in _SQL.items()}

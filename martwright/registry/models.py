"""The models, from staging to marts."""

from __future__ import annotations

from pyspark.sql import functions as F

from martwright.functions import cents_to_dollars, safe_divide, surrogate_key
from martwright.plans import commercial
from martwright.registry.base import case
from martwright.registry.sqltext import part, sql
from martwright.schemas import MONEY
from martwright.sources.spine import time_spine_from

part(
    "supplies",
    """
    select distinct l_partkey as pk, l_suppkey as sk from lineitem""",
)

STAGING_SQL = {
    "customer": """
        select md5(c_custkey || '-' || c_name) as customer_key, c_custkey as custkey,
               c_name as name, cast(null as varchar) as address, c_nationkey as nationkey,
               cast(null as varchar) as phone, balance as acctbal, c_mktsegment as mktsegment,
               cast(null as varchar) as comment
        from cust""",
    "lineitem": """
        select md5(l_orderkey || '-' || l_partkey) as lineitem_key, l_orderkey as orderkey,
               l_partkey as partkey, l_suppkey as suppkey, l_linenumber as linenumber,
               qty as quantity, ext as extendedprice, disc as discount, tax,
               l_returnflag as returnflag, l_linestatus as linestatus, ship as shipdate,
               due as commitdate, received as receiptdate, instruct as shipinstruct,
               mode as shipmode, cast(null as varchar) as comment
        from line""",
    "nation": """
        select md5(n_nationkey || '-' || n_name) as nation_key, n_nationkey as nationkey,
               n_name as name, n_regionkey as regionkey, cast(null as varchar) as comment
        from nation""",
    "orders": """
        select md5(o_orderkey || '-' || o_custkey) as orders_key, o_orderkey as orderkey,
               o_custkey as custkey, o_orderstatus as orderstatus, total as totalprice,
               odate as orderdate, o_orderpriority as orderpriority,
               'Clerk#' || (o_custkey % 1000) as clerk, cast(0 as integer) as shippriority,
               cast(null as varchar) as comment
        from head""",
    "part": """
        select md5(p_partkey || '-' || p_name) as part_key, p_partkey as partkey, p_name as name,
               'Manufacturer#' || (p_partkey % 5 + 1) as mfgr, p_brand as brand, p_type as type,
               p_size as size, cast(null as varchar) as container,
               cast(p_retailprice as decimal(18,2)) as retailprice,
               cast(null as varchar) as comment
        from part""",
    "partsupp": """
        select md5(pk || '-' || sk) as partsupp_key, pk as partkey, sk as suppkey,
               cast(1 + (pk + sk) % 9999 as integer) as availqty,
               cast((100 + (pk * 7 + sk * 13) % 99901) / 100.0 as decimal(18,2)) as supplycost,
               cast(null as varchar) as comment
        from supplies""",
    "region": """
        select md5(r_regionkey || '-' || r_name) as region_key, r_regionkey as regionkey,
               r_name as name, cast(null as varchar) as comment
        from region""",
    "supplier": """
        select md5(s_suppkey || '-' || s_name) as supplier_key, s_suppkey as suppkey,
               s_name as name, cast(null as varchar) as address, s_nationkey as nationkey,
               cast(null as varchar) as phone, cast(s_acctbal as decimal(18,2)) as acctbal,
               cast(null as varchar) as comment
        from supplier""",
}

for _table, _text in STAGING_SQL.items():
    part(f"stg_tpch__{_table}", _text)
    case(f"stg_tpch_{_table}", sql(_text))(lambda d, t=_table: d.staged(t))

part(
    "stg_commercial__orders",
    """
        select o_orderkey as order_key, o_custkey as customer_key, o_orderstatus as order_status,
               o_orderpriority as order_priority, 'Clerk#' || (o_custkey % 1000) as clerk_name,
               cast(0 as integer) as ship_priority, total as order_total_price,
               odate as order_date, urgent as is_high_priority, label as order_status_label,
               cast(null as varchar) as order_comment
        from head""",
)
part(
    "stg_commercial__customers",
    """
        select c_custkey as customer_key, c_nationkey as nation_key, c_name as customer_name,
               cast(null as varchar) as customer_address, cast(null as varchar) as customer_phone,
               c_mktsegment as market_segment, balance as account_balance,
               delinquent as is_delinquent, valued as is_high_value,
               cast(null as varchar) as customer_comment
        from cust""",
)
part(
    "stg_commercial__lineitems",
    """
        select line_id as lineitem_key, l_orderkey as order_key, l_linenumber as line_number,
               l_returnflag as return_flag, l_linestatus as line_status, mode as ship_mode,
               qty as quantity, ext as extended_price, disc as discount_rate, tax as tax_rate,
               net as net_price, gross as gross_price, ship as ship_date, due as commit_date,
               received as receipt_date
        from priced""",
)

case("stg_commercial_orders", sql("select * from stg_commercial__orders"))(lambda d: d.orders())
case("stg_commercial_customers", sql("select * from stg_commercial__customers"))(
    lambda d: d.customers()
)
case("stg_commercial_lineitems", sql("select * from stg_commercial__lineitems"))(
    lambda d: d.lineitems()
)

case("stg_finance_orders", sql("select * from finance"))(lambda d: d.finance_orders())
case("stg_marketing_customers", sql("select * from segmented"))(lambda d: d.marketing_customers())
case("stg_product_usage", sql("select * from usage"))(lambda d: d.usage())

case(
    "int_order_items",
    sql("""
        select line_id as lineitem_key, l_orderkey as order_key, o_custkey as customer_key,
               odate as order_date, o_orderstatus as order_status, label as order_status_label,
               o_orderpriority as order_priority, urgent as is_high_priority,
               'Clerk#' || (o_custkey % 1000) as clerk_name, l_linenumber as line_number,
               l_returnflag as return_flag, l_linestatus as line_status, mode as ship_mode,
               ship as ship_date, due as commit_date, received as receipt_date,
               date_diff('day', odate, ship) as days_to_ship,
               date_diff('day', ship, received) as days_in_transit,
               date_diff('day', due, received) as days_vs_commit,
               qty as quantity, ext as extended_price, disc as discount_rate, tax as tax_rate,
               net as net_price, gross as gross_price,
               coalesce(l_returnflag = 'R', false) as is_returned,
               coalesce(received > due, false) as is_late_delivery
        from item"""),
)(lambda d: d.order_items())

case("int_customer_orders", sql("select * from history"))(
    lambda d: commercial.int_customer_orders(d.rollup())
)
case("fct_orders_v1", sql("select * from fact"))(lambda d: d.fct_orders())
case(
    "fct_orders_v2",
    sql("select * exclude (gross_revenue), gross_revenue as total_revenue from fact"),
)(lambda d: commercial.fct_orders_v2(d.rollup()))
case("fct_orders_pinned_v1", sql("select * from fact"))(
    lambda d: d.published().fct_orders(version=1)
)
case("dim_customers_v1", sql("select * from dim"))(lambda d: d.dim_customers())
case("fct_revenue_v1", sql("select * from revenue"))(lambda d: d.fct_revenue())
case("fct_attribution_v1", sql("select * from attribution"))(lambda d: d.fct_attribution())
case("fct_usage_v1", sql("select * from usage_month"))(lambda d: d.fct_usage())
case("fct_orders_enriched", sql("select * from enriched"))(lambda d: d.published().enriched())

case(
    "time_spine",
    """
    with latest as (select max(cast(o_orderdate as date)) as d from orders)
    select cast(day as date) as date_day
    from generate_series(date '2000-01-01', date '2029-12-31', interval 1 day) as s(day), latest
    where day > d - interval 5 year and day < d + interval 30 day""",
)(lambda d: time_spine_from(d.raw("orders").agg(F.max("o_orderdate").alias("as_of"))))


# -- functions over whole tables --

case(
    "fn_surrogate_key",
    """
    select l_orderkey as order_key,
           md5(coalesce(cast(l_orderkey as varchar), '_dbt_utils_surrogate_key_null_') || '-' ||
               coalesce(nullif(l_returnflag, 'N'), '_dbt_utils_surrogate_key_null_') || '-' ||
               coalesce(l_linestatus, '_dbt_utils_surrogate_key_null_')) as row_key
    from lineitem""",
)(
    lambda d: d.raw("lineitem").select(
        F.col("l_orderkey").alias("order_key"),
        surrogate_key(
            "l_orderkey", F.nullif("l_returnflag", F.lit("N")), "l_linestatus"
        ).alias("row_key"),
    )
)

case(
    "fn_safe_divide",
    sql("""
        select l_orderkey as order_key, l_linenumber as line_number,
               case when nullif(tax, 0) is null then 0 else cast(ext as double) / cast(tax as double)
               end as price_over_tax
        from line"""),
)(
    lambda d: d.raw("lineitem").select(
        F.col("l_orderkey").alias("order_key"),
        F.col("l_linenumber").alias("line_number"),
        safe_divide(
            F.col("l_extendedprice").cast("double"), F.col("l_tax").cast("double"), F.lit(0.0)
        ).alias("price_over_tax"),
    )
)

case(
    "fn_cents_to_dollars",
    sql("""
        select l_orderkey as order_key, l_linenumber as line_number,
               cast(cast(ext * 100 as bigint) * cast(0.01 as decimal(2,2)) as decimal(18,2))
                 as dollars
        from line"""),
)(
    lambda d: d.raw("lineitem").select(
        F.col("l_orderkey").alias("order_key"),
        F.col("l_linenumber").alias("line_number"),
        cents_to_dollars((F.col("l_extendedprice") * 100).cast("long")).cast(MONEY).alias("dollars"),
    )
)

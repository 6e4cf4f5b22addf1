"""Building blocks of the check SQL: named sub-queries over the raw tables."""

from __future__ import annotations

import re



def half_up(numerator: str, denominator: str, scale: int, units: int, type: str) -> str:
    """``numerator / 10^units / denominator`` rounded half up on whole numbers, exactly."""
    lift = 10 ** (scale - units)
    whole = f"(2 * cast({numerator} as hugeint) * {lift} + {denominator}) // (2 * {denominator})"
    step = f"{10.0**-scale:.{scale}f}"
    return f"cast(cast({whole} as decimal(24,0)) * {step} as {type})"


def mean(total: str, count: str, units: int = 0) -> str:
    return half_up(f"{total} * {10**units}", count, 8, units, "decimal(24,8)")


PARTS: dict[str, str] = {
    # -- raw rows with exact money and the stand-in columns of the generated data --
    "line": """
        select l_orderkey, l_partkey, l_suppkey, l_linenumber, l_returnflag, l_linestatus,
               cast(l_quantity as decimal(18,2)) as qty,
               cast(l_extendedprice as decimal(18,2)) as ext,
               cast(l_discount as decimal(4,2)) as disc,
               cast(l_tax as decimal(4,2)) as tax,
               cast(l_shipdate as date) as ship,
               cast(l_shipdate as date) + cast(l_partkey % 61 - 30 as integer) as due,
               cast(l_shipdate as date) + cast(l_suppkey % 30 + 1 as integer) as received,
               ['COLLECT COD', 'DELIVER IN PERSON', 'NONE', 'TAKE BACK RETURN']
                 [l_orderkey % 4 + 1] as instruct,
               ['AIR', 'FOB', 'MAIL', 'RAIL', 'REG AIR', 'SHIP', 'TRUCK']
                 [(l_partkey + l_suppkey) % 7 + 1] as mode
        from lineitem""",
    "priced": """
        select *, cast(round(ext * (1 - disc), 2) as decimal(18,2)) as net,
               cast(round(ext * (1 - disc) * (1 + tax), 2) as decimal(18,2)) as gross,
               md5(l_orderkey || '-' || l_linenumber) as line_id
        from line""",
    "head": """
        select o_orderkey, o_custkey, o_orderstatus, o_orderpriority,
               cast(o_totalprice as decimal(18,2)) as total,
               cast(o_orderdate as date) as odate,
               coalesce(o_orderpriority in ('1-URGENT', '2-HIGH'), false) as urgent,
               case o_orderstatus when 'F' then 'fulfilled' when 'O' then 'open'
                 when 'P' then 'partial' else 'unknown' end as label
        from orders""",
    "cust": """
        select c_custkey, c_name, c_nationkey, c_mktsegment,
               cast(c_acctbal as decimal(18,2)) as balance,
               coalesce(c_acctbal < 0, false) as delinquent,
               coalesce(c_acctbal >= 5000, false) as valued
        from customer""",
    "item": """
        select priced.*, o_custkey, odate, o_orderstatus, label, o_orderpriority, urgent
        from head, priced where o_orderkey = l_orderkey""",
    # -- marts --
    "fact": f"""
        select l_orderkey as order_key, o_custkey as customer_key, odate as order_date,
               o_orderstatus as order_status, label as order_status_label,
               o_orderpriority as order_priority, urgent as is_high_priority,
               cast(sum(gross) as decimal(18,2)) as gross_revenue,
               cast(sum(net) as decimal(18,2)) as net_revenue,
               cast(sum(ext) as decimal(18,2)) as extended_revenue,
               cast(sum(qty) as decimal(18,2)) as total_quantity,
               count(*) as line_item_count,
               {mean("sum(disc)", "count(disc)", 2)} as avg_discount_rate,
               min(ship) as first_ship_date, max(received) as last_receipt_date,
               count(*) filter (l_returnflag = 'R') as returned_lines,
               count(*) filter (received > due) as late_lines
        from item group by all""",
    "history": f"""
        select o_custkey as customer_key,
               count(distinct l_orderkey) as total_orders,
               count(*) as total_line_items,
               cast(sum(qty) as decimal(38,2)) as total_quantity,
               cast(sum(gross) as decimal(38,2)) as lifetime_gross_revenue,
               cast(sum(net) as decimal(38,2)) as lifetime_net_revenue,
               {mean("sum(gross)", "count(gross)", 2)} as avg_line_gross_revenue,
               min(odate) as first_order_date, max(odate) as last_order_date,
               date_diff('day', min(odate), max(odate)) as customer_tenure_days,
               count(*) filter (l_returnflag = 'R') as total_returns,
               count(*) filter (received > due) as total_late_deliveries,
               count(*) filter (label = 'fulfilled') as fulfilled_orders,
               count(*) filter (urgent) as high_priority_orders
        from item group by o_custkey""",
    "dim": """
        select c_custkey as customer_key, c_nationkey as nation_key, c_mktsegment as market_segment,
               balance as account_balance, delinquent as is_delinquent, valued as is_high_value,
               coalesce(total_orders, 0) as total_orders,
               coalesce(lifetime_gross_revenue, 0) as lifetime_gross_revenue,
               coalesce(lifetime_net_revenue, 0) as lifetime_net_revenue,
               first_order_date, last_order_date,
               coalesce(customer_tenure_days, 0) as customer_tenure_days,
               coalesce(total_returns, 0) as total_returns,
               case when lifetime_gross_revenue >= 500000 then 'platinum'
                    when lifetime_gross_revenue >= 100000 then 'gold'
                    when lifetime_gross_revenue >= 10000 then 'silver'
                    else 'bronze' end as customer_tier,
               total_orders is null as is_never_ordered
        from cust left join history on customer_key = c_custkey""",
    "finance": f"""
        select order_key, customer_key, order_date, order_status, order_status_label,
               gross_revenue, net_revenue, extended_revenue, line_item_count,
               cast(gross_revenue - net_revenue as decimal(18,2)) as total_discount_amount,
               case when gross_revenue > 0
                 then {half_up("(gross_revenue - net_revenue) * 100",
                               "cast(gross_revenue * 100 as hugeint)", 4, 0, "decimal(18,4)")}
                 else cast(0 as decimal(18,4)) end
                 as effective_discount_rate,
               cast(date_trunc('month', order_date) as date) as order_month,
               cast(date_trunc('quarter', order_date) as date) as order_quarter,
               extract(year from order_date) as order_year
        from fact""",
    "revenue": f"""
        select customer_key, order_month, order_quarter, order_year,
               cast(sum(gross_revenue) as decimal(38,2)) as gross_revenue,
               cast(sum(net_revenue) as decimal(38,2)) as net_revenue,
               cast(sum(total_discount_amount) as decimal(38,2)) as total_discount_amount,
               count(distinct order_key) as order_count,
               cast(sum(line_item_count) as bigint) as total_line_items,
               {half_up("sum(effective_discount_rate) * 10000", "count(*)", 4, 4, "decimal(18,4)")}
                 as avg_discount_rate,
               {half_up("sum(gross_revenue) * 100", "count(distinct order_key)", 2, 2,
                        "decimal(18,2)")} as avg_order_value
        from finance group by all""",
    "segmented": """
        select customer_key, nation_key, market_segment, account_balance, is_high_value,
               is_delinquent, customer_tier, lifetime_gross_revenue, total_orders,
               first_order_date, last_order_date, customer_tenure_days, total_returns,
               is_never_ordered,
               case when total_orders < 3 then 'low' when total_orders < 10 then 'medium'
                    else 'high' end as frequency_segment,
               case when lifetime_gross_revenue < 50000 then 'low'
                    when lifetime_gross_revenue < 500000 then 'medium'
                    else 'high' end as monetary_segment
        from dim""",
    "attribution": f"""
        select market_segment, customer_tier, nation_key, frequency_segment, monetary_segment,
               count(customer_key) as customer_count,
               cast(sum(lifetime_gross_revenue) as decimal(38,2)) as segment_revenue,
               {mean("sum(lifetime_gross_revenue)", "count(*)", 2)} as avg_customer_revenue,
               cast(sum(total_orders) as bigint) as segment_order_count,
               {mean("sum(total_orders)", "count(*)")} as avg_orders_per_customer,
               count(*) filter (is_high_value) as high_value_count,
               count(*) filter (is_never_ordered) as never_ordered_count,
               count(*) filter (is_delinquent) as delinquent_count,
               {mean("sum(customer_tenure_days)", "count(*)")} as avg_tenure_days
        from segmented group by all""",
    "usage": """
        select md5(l_orderkey || '-' || l_linenumber) as usage_event_key,
               l_orderkey as order_key, l_linenumber as feature_id, mode as feature_category,
               qty as usage_quantity, ext as usage_value, ship as usage_date,
               cast(date_trunc('month', ship) as date) as usage_month,
               l_returnflag as usage_status, coalesce(l_returnflag = 'R', false) as is_churned
        from line where ship is not null""",
    "usage_month": f"""
        select feature_id, feature_category, usage_month, count(*) as total_events,
               count(distinct order_key) as unique_users,
               cast(sum(usage_quantity) as decimal(38,2)) as total_quantity,
               cast(sum(usage_value) as decimal(38,2)) as total_usage_value,
               count(*) filter (is_churned) as churned_events,
               {half_up("count(*) filter (is_churned)", "count(*)", 4, 0, "decimal(18,4)")}
                 as churn_rate
        from usage group by all""",
    "enriched": """
        select order_key, fact.customer_key, order_date, order_status, order_status_label,
               order_priority, is_high_priority, market_segment, customer_tier, nation_key,
               is_high_value, is_delinquent, gross_revenue, net_revenue, line_item_count,
               avg_discount_rate,
               cast(date_trunc('month', order_date) as date) as order_month,
               cast(date_trunc('quarter', order_date) as date) as order_quarter,
               extract(year from order_date) as order_year
        from fact left join dim on dim.customer_key = fact.customer_key""",
}


def part(name: str, text: str) -> None:
    """Add a named sub-query for use in later texts."""
    PARTS[name] = text


_READS = r"\b(?:from|join)\s+(\w+)(?:\s*,\s*(\w+))?"  # "from a", "from a, b", "join a"


def _needed(text: str, found: dict[str, None]) -> None:
    words = {w for pair in re.findall(_READS, text) for w in pair}
    for name in PARTS:
        if name in words and name not in found:
            _needed(PARTS[name], found)
            found[name] = None


def sql(body: str) -> str:
    """A query text preceded by the sub-queries it uses, directly or not."""
    found: dict[str, None] = {}
    _needed(body, found)
    if not found:
        return body
    return "with " + ",\n".join(f"{n} as ({PARTS[n]})" for n in found) + "\n" + body

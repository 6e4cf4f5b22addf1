"""Metric queries over the stored order mart."""

from __future__ import annotations

from pyspark.sql import functions as F

from martwright.operators.crossmart import CrossRatio, query_across
from martwright.operators.distinct import count_states, distinct_states, merge_states, number_keys
from martwright.operators.metrics import (
    ORDERS,
    at_grain,
    fill_gaps,
    fill_gaps_by_group,
    flag_discount_rate,
    list_metrics,
    query_metrics,
    reconcile_by,
    reconcile_totals,
    side_by_side,
)
from martwright.registry.base import case
from martwright.registry.sqltext import part, sql
from martwright.sources.spine import days_from

# SQL of each metric
GROSS = "cast(sum(gross_revenue) as decimal(38,2)) as gross_revenue"
NET = "cast(sum(net_revenue) as decimal(38,2)) as net_revenue"
DISCOUNT = "cast(sum(gross_revenue - net_revenue) as decimal(38,2)) as total_discount"
ORDER_COUNT = "count(distinct order_key) as order_count"
AOV = "cast(sum(gross_revenue) as double) / count(gross_revenue) as avg_order_value"
ACTIVE = "count(distinct customer_key) as active_customers"
DISCOUNT_RATE = (
    "cast(sum(gross_revenue - net_revenue) as double)"
    " / nullif(cast(sum(gross_revenue) as double), 0) as discount_rate"
)
PER_CUSTOMER = (
    "cast(sum(gross_revenue) as double)"
    " / nullif(cast(count(distinct customer_key) as double), 0) as revenue_per_customer"
)
ALL_METRICS = [m.name for m in ORDERS.metrics]
ALL_SQL = ", ".join(
    [GROSS, NET, DISCOUNT, ORDER_COUNT, AOV, DISCOUNT_RATE, ACTIVE, PER_CUSTOMER]
)

part("totals", f"select {ALL_SQL} from enriched")
part(
    "days",
    """
    select cast(day as date) as date_day
    from generate_series(date '2000-01-01', date '2029-12-31', interval 1 day) as s(day),
         (select max(cast(o_orderdate as date)) as d from orders)
    where day > d - interval 5 year and day < d + interval 30 day""",
)


def metric(name: str, text: str, *args, **kwargs) -> None:
    case(name, sql(text))(lambda d: query_metrics(d.published().enriched(), *args, **kwargs))


metric(
    "metric_gross_revenue_by_month",
    f"select order_month as metric_time__month, {GROSS} from enriched group by 1",
    ["gross_revenue"],
    ["metric_time__month"],
    order=["metric_time__month"],
)
metric(
    "metric_gross_net_by_segment",
    f"select market_segment as order__market_segment, {GROSS}, {NET} from enriched group by 1",
    ["gross_revenue", "net_revenue"],
    ["order__market_segment"],
)
metric(
    "metric_aov_by_tier",
    f"select customer_tier as order__customer_tier, {AOV} from enriched group by 1",
    ["avg_order_value"],
    ["order__customer_tier"],
)
metric(
    "metric_aov_by_tier_month",
    f"select customer_tier, order_month, {AOV} from enriched group by 1, 2",
    ["avg_order_value"],
    ["customer_tier", "order_month"],
)
metric(
    "metric_discount_rate_by_segment",
    f"select market_segment as order__market_segment, {DISCOUNT_RATE} from enriched group by 1",
    ["discount_rate"],
    ["order__market_segment"],
)
metric(
    "metric_active_customers_by_segment",
    f"select market_segment, {ACTIVE} from enriched group by 1",
    ["active_customers"],
    ["market_segment"],
)
metric(
    "metric_revenue_per_customer_by_tier",
    f"select customer_tier as order__customer_tier, {PER_CUSTOMER} from enriched group by 1",
    ["revenue_per_customer"],
    ["order__customer_tier"],
)
metric(
    "metric_order_count_by_status",
    f"select order_status, order_status_label, {ORDER_COUNT} from enriched group by 1, 2",
    ["order_count"],
    ["order_status", "order_status_label"],
)
metric("metric_all_total", "select * from totals", ALL_METRICS)
metric(
    "metric_by_quarter_and_priority",
    f"""
    select order_quarter as metric_time__quarter, order_priority as order__order_priority,
           {DISCOUNT}, {ORDER_COUNT}, {ACTIVE}
    from enriched group by 1, 2""",
    ["total_discount", "order_count", "active_customers"],
    ["metric_time__quarter", "order__order_priority"],
)
metric(
    "metric_by_year_and_value",
    f"""
    select cast(date_trunc('year', order_date) as date) as metric_time__year,
           is_high_value as order__is_high_value, {NET}, {PER_CUSTOMER}
    from enriched group by 1, 2""",
    ["net_revenue", "revenue_per_customer"],
    ["metric_time__year", "order__is_high_value"],
)
metric(
    "metric_where_high_priority",
    f"""
    select market_segment as order__market_segment, {GROSS}, {ORDER_COUNT}
    from enriched where is_high_priority and order_date >= date '1997-01-01' group by 1""",
    ["gross_revenue", "order_count"],
    ["order__market_segment"],
    where="order__is_high_priority = true and metric_time >= date '1997-01-01'",
)
metric(
    "metric_top_months",
    f"""
    select order_month as metric_time__month, {GROSS} from enriched
    group by 1 order by gross_revenue desc, 1 limit 10""",
    ["gross_revenue"],
    ["metric_time__month"],
    order=["-gross_revenue", "metric_time__month"],
    limit=10,
)


@case(
    "metric_daily_gap_filled",
    sql(f"""
        select cast(day as date) as metric_time__day, m.gross_revenue, m.order_count
        from (select unnest(generate_series(min(o_orderdate), max(o_orderdate), interval 1 day)) as day
              from orders) left join (
          select order_date, {GROSS}, {ORDER_COUNT} from enriched group by 1) m
          on order_date = cast(day as date)"""),
)
def daily_gap_filled(d):
    daily = query_metrics(
        d.published().enriched(), ["gross_revenue", "order_count"], ["metric_time__day"]
    )
    dates = d.raw("orders").agg(F.min("o_orderdate").alias("first"), F.max("o_orderdate").alias("last"))
    spine = days_from(dates, "first", "last").select("date_day")
    return fill_gaps(daily, spine, "metric_time__day")


@case(
    "metric_segment_days_gap_filled",
    sql(f"""
        select s.segment as order__market_segment, cast(s.day as date) as metric_time__day, m.gross_revenue, m.order_count
        from (select market_segment as segment, unnest(generate_series(cast(min(order_date) as timestamp),
                     cast(max(order_date) as timestamp), interval 1 day)) as day
              from enriched group by 1) s
        left join (select market_segment, order_date, {GROSS}, {ORDER_COUNT} from enriched group by 1, 2) m
          on m.market_segment is not distinct from s.segment and m.order_date = cast(s.day as date)"""),
)
def segment_days_gap_filled(d):
    keys = ["order__market_segment", "metric_time__day"]
    daily = query_metrics(d.published().enriched(), ["gross_revenue", "order_count"], keys)
    return fill_gaps_by_group(daily, "metric_time__day", ["order__market_segment"])


@case(
    "metric_discount_flag",
    sql(f"""
        select market_segment as order__market_segment, customer_tier as order__customer_tier,
               {DISCOUNT_RATE}, coalesce({DISCOUNT_RATE.split(' as discount_rate')[0]} > 0.10, false)
                 as is_over_limit
        from enriched group by 1, 2"""),
)
def discount_flag(d):
    groups = ["order__market_segment", "order__customer_tier"]
    return flag_discount_rate(query_metrics(d.published().enriched(), ["discount_rate"], groups))


@case(
    "metric_reconciliation",
    sql("""
        select commercial, finance, marketing, analytics,
               cast(greatest(commercial, finance, marketing, analytics)
                    - least(commercial, finance, marketing, analytics) as decimal(38,2))
                 as widest_gap,
               commercial = finance and finance = marketing and marketing = analytics as all_agree
        from (select cast(sum(gross_revenue) as decimal(38,2)) as commercial from fact),
             (select cast(sum(gross_revenue) as decimal(38,2)) as finance from revenue),
             (select cast(sum(segment_revenue) as decimal(38,2)) as marketing from attribution),
             (select cast(sum(gross_revenue) as decimal(38,2)) as analytics from enriched)"""),
)
def reconciliation(d):
    """The same lifetime revenue out of four domains' tables, each at its own grain."""
    marts = d.published()
    return reconcile_totals(
        {
            "commercial": (marts.fct_orders(), "gross_revenue"),
            "finance": (marts.fct_revenue(), "gross_revenue"),
            "marketing": (marts.fct_attribution(), "segment_revenue"),
            "analytics": (marts.enriched(), "gross_revenue"),
        }
    )


@case(
    "metric_reconciliation_by_month",
    sql("""
        select coalesce(f.order_month, a.order_month) as order_month, finance, analytics,
               cast(coalesce(finance, 0) - coalesce(analytics, 0) as decimal(38,2)) as gap
        from (select order_month, cast(sum(gross_revenue) as decimal(38,2)) as finance
              from revenue group by 1) f
        full join (select order_month, cast(sum(gross_revenue) as decimal(38,2)) as analytics
              from enriched group by 1) a on f.order_month = a.order_month"""),
)
def reconciliation_by_month(d):
    """Last month's revenue, from finance and from the metric."""
    marts = d.published()
    finance = marts.fct_revenue().groupBy("order_month").agg(
        F.sum("gross_revenue").cast("decimal(38,2)").alias("gross_revenue")
    )
    metric_rows = query_metrics(marts.enriched(), ["gross_revenue"], ["order_month"])
    return reconcile_by(
        finance, metric_rows, ["order_month"], "gross_revenue", ("finance", "analytics")
    )


# -- several marts in one query --


def across(name: str, text: str, models: str, *args, **kwargs) -> None:
    def build(d):
        marts = d.published()
        given = {"orders": marts.enriched, "usage": marts.fct_usage, "attribution": marts.fct_attribution,
                 "revenue": marts.fct_revenue}
        return query_across({m: given[m]() for m in models.split()}, *args, **kwargs)

    case(name, sql(text))(build)


def _over(top: str, bottom: str, name: str) -> str:
    return f"cast({top} as double) / nullif(cast({bottom} as double), 0) as {name}"


across(
    "metric_revenue_and_usage_by_month",
    f"""
    select coalesce(o.month, u.month) as metric_time__month, gross_revenue, order_count, usage_events,
           usage_value, {_over("churned", "usage_events", "churn_rate")},
           {_over("gross_revenue", "usage_events", "revenue_per_event")}
    from (select order_month as month, {GROSS}, {ORDER_COUNT} from enriched group by 1) o
    full join (select usage_month as month, cast(sum(total_events) as bigint) as usage_events,
                      cast(sum(total_usage_value) as decimal(38,2)) as usage_value,
                      sum(churned_events) as churned
               from usage_month group by 1) u on o.month is not distinct from u.month""",
    "orders usage",
    ["gross_revenue", "order_count", "usage_events", "usage_value", "churn_rate",
     CrossRatio("revenue_per_event", "gross_revenue", "usage_events")],
    ["metric_time__month"],
)
across(
    "metric_segments_across_marts",
    f"""
    select coalesce(a.market_segment, o.market_segment) as market_segment,
           coalesce(a.customer_tier, o.customer_tier) as customer_tier,
           gross_revenue, active_customers, known_customers, never_ordered,
           {_over("active_customers", "known_customers", "active_share")}
    from (select market_segment, customer_tier, cast(sum(customer_count) as bigint) as known_customers,
                 cast(sum(never_ordered_count) as bigint) as never_ordered
          from attribution group by 1, 2) a
    full join (select market_segment, customer_tier, {GROSS}, {ACTIVE} from enriched group by 1, 2) o
      on a.market_segment is not distinct from o.market_segment
      and a.customer_tier is not distinct from o.customer_tier""",
    "orders attribution",
    ["gross_revenue", "active_customers", "known_customers", "never_ordered",
     CrossRatio("active_share", "orders.active_customers", "attribution.known_customers")],
    ["market_segment", "customer_tier"],
)
across(
    "metric_quarters_of_three_marts",
    f"""
    select quarter as metric_time__quarter, gross_revenue, booked_revenue,
           {_over("booked_revenue", "booked_orders", "booked_per_order")}, paying_customers,
           usage_quantity, {_over("gross_revenue", "booked_revenue", "urgent_share")}
    from (select order_quarter as quarter, {GROSS} from enriched where is_high_priority group by 1)
    full join (select order_quarter as quarter, cast(sum(gross_revenue) as decimal(38,2)) as booked_revenue,
                      sum(order_count) as booked_orders, count(distinct customer_key) as paying_customers
               from revenue group by 1) using (quarter)
    full join (select cast(date_trunc('quarter', usage_month) as date) as quarter,
                      cast(sum(total_quantity) as decimal(38,2)) as usage_quantity
               from usage_month group by 1) using (quarter)
    where quarter >= date '1996-01-01'""",
    "orders revenue usage",
    ["gross_revenue", "booked_revenue", "booked_per_order", "paying_customers", "usage_quantity",
     CrossRatio("urgent_share", "gross_revenue", "booked_revenue")],
    ["metric_time__quarter"],
    where="metric_time__quarter >= date '1996-01-01'",
    where_in={"orders": "order__is_high_priority"},
)
across(
    "metric_totals_across_marts",
    f"""
    select gross_revenue, known_customers, usage_value,
           {_over("usage_value", "known_customers", "usage_value_per_customer")}
    from (select {GROSS} from enriched),
         (select cast(sum(customer_count) as bigint) as known_customers from attribution),
         (select cast(sum(total_usage_value) as decimal(38,2)) as usage_value from usage_month)""",
    "orders usage attribution",
    ["gross_revenue", "known_customers", "usage_value",
     CrossRatio("usage_value_per_customer", "usage_value", "known_customers")],
)


# -- distinct counts merged from day to year --

_GRAINS = ["day", "month", "quarter", "year"]


def _rolled_up(states, name: str):
    """Distinct keys per day, month, quarter and year, all from the states of days."""
    out = None
    for grain in _GRAINS:
        period = at_grain(F.col("day"), grain).alias("period")
        counted = count_states(merge_states(states, [period]), ["period"], name)
        counted = counted.select(F.lit(grain).alias("grain"), "period", name)
        out = counted if out is None else out.unionByName(counted)
    return out


@case(
    "metric_distinct_rollup",
    sql("\n union all ".join(
        f"select '{g}' as grain, cast(date_trunc('{g}', order_date) as date) as period,"
        " count(distinct order_key) as order_count, count(distinct customer_key) as active_customers"
        " from enriched group by 2" for g in _GRAINS
    )),
)
def distinct_rollup(d):
    """Orders and customers per day to year: the orders are read once per key, the years are merged."""
    orders = d.published().enriched()
    parts = []
    for key, name in (("order_key", "order_count"), ("customer_key", "active_customers")):
        states = distinct_states(orders, [F.col("order_date").alias("day")], key, sparse=True)
        parts.append(_rolled_up(states, name))
    return side_by_side(parts, ["grain", "period"])


@case(
    "metric_distinct_text_keys",
    sql("""
        select feature_category, cast(date_trunc('year', usage_month) as date) as usage_year,
               count(distinct usage_event_key) as distinct_events
        from usage group by 1, 2"""),
)
def distinct_text_keys(d):
    """Text keys are numbered once; months are merged into years."""
    usage = d.usage().select("usage_event_key", "feature_category", "usage_month")
    numbered = usage.join(number_keys(usage, "usage_event_key"), "usage_event_key")
    months = distinct_states(numbered, ["feature_category", "usage_month"], "number", sparse=True)
    year = F.trunc("usage_month", "year").alias("usage_year")
    years = merge_states(months, ["feature_category", year])
    return count_states(years, ["feature_category", "usage_year"], "distinct_events")


_LIST_SQL = "\n union all ".join(
    f"select '{m.name}' as metric, '{m.label}' as label, '{m.kind}' as type,"
    f" {repr(m.measure) if m.measure else 'null'} as measure,"
    f" {repr(m.numerator) if m.numerator else 'null'} as numerator,"
    f" {repr(m.denominator) if m.denominator else 'null'} as denominator,"
    f" '{m.owner}' as owner, cast({m.name} as double) as current_total from totals"
    for m in ORDERS.metrics
)


@case("metric_list", sql(_LIST_SQL))
def metric_list(d):
    """The registry with each metric's current total over the whole mart."""
    totals = query_metrics(d.published().enriched(), ALL_METRICS)
    current = totals.select([F.col(m).cast("double").alias(m) for m in ALL_METRICS]).unpivot(
        [], ALL_METRICS, "metric", "current_total"
    )
    return list_metrics(d.spark).join(current, "metric")

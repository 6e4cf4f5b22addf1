"""Check suites, contracts and freshness over whole tables."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martwright.functions import strip_prefix
from martwright.operators.checks import (
    Check,
    contract_checks,
    failing_rows,
    run_checks,
    suite_status,
)
from martwright.operators.contracts import (
    assert_no_pii,
    coerce_contract,
    contract_diff,
    contract_loss,
    exclude_pii,
)
from martwright.operators.freshness import NEW_SOURCE_LIMITS, SOURCE_SLA, freshness, freshness_observed
from martwright.plans.suites import checks_of
from martwright.registry.base import Domain, case
from martwright.registry.sqltext import part, sql
from martwright.schemas import CONTRACTS, PII_COLUMNS
from martwright.sources.proxies import ABSENT
from martwright.sources.spine import time_spine_from

# table name in a check -> how to get the rows, and the sub-query that states them in SQL
TABLES = {
    **{
        f"stg_tpch__{t}": (lambda d, t=t: d.staged_present(t), f"stg_tpch__{t}")
        for t in ABSENT
    },
    "stg_tpch__partsupp": (lambda d: d.published().partsupp(), "stg_tpch__partsupp"),
    "stg_commercial__orders": (lambda d: d.orders(), "stg_commercial__orders"),
    "stg_commercial__customers": (lambda d: d.customers(), "stg_commercial__customers"),
    "stg_commercial__lineitems": (lambda d: d.lineitems(), "stg_commercial__lineitems"),
    "fct_orders_v1": (lambda d: d.published().fct_orders(), "fact"),
    "dim_customers_v1": (lambda d: d.published().dim_customers(), "dim"),
    "stg_finance__orders": (lambda d: d.finance_orders(), "finance"),
    "fct_revenue_v1": (lambda d: d.published().fct_revenue(), "revenue"),
    "fct_attribution_v1": (lambda d: d.published().fct_attribution(), "attribution"),
    "fct_usage_v1": (lambda d: d.published().fct_usage(), "usage_month"),
    "fct_orders_enriched": (lambda d: d.published().enriched(), "enriched"),
    "metricflow_time_spine": (
        lambda d: time_spine_from(d.raw("orders").agg(F.max("o_orderdate").alias("as_of"))),
        "days",
    ),
}
SKIPPED = {
    f"stg_tpch__{table}": {strip_prefix(c) for c in columns} for table, columns in ABSENT.items()
}


def _failures_sql(check: Check) -> str:
    table, c = TABLES[check.table][1], check.column
    if check.kind == "not_null":
        return f"(select count(*) from {table} where {c} is null)"
    if check.kind == "unique":
        return (
            f"(select count(*) from (select {c} from {table} where {c} is not null"
            f" group by {c} having count(*) > 1))"
        )
    if check.kind == "accepted_values":
        values = ", ".join(f"'{v}'" for v in check.values)
        return f"(select count(distinct {c}) from {table} where {c} not in ({values}))"
    parent, field = TABLES[check.parent][1], check.parent_column
    return (
        f"(select count(*) from {table} as child where {c} is not null and not exists"
        f" (select 1 from {parent} as owner where owner.{field} = child.{c}))"
    )


def suite_sql(checks: list[Check]) -> str:
    rows = []
    for check in checks:
        if check.column in SKIPPED.get(check.table, ()):
            failures, status = "cast(null as bigint)", "'skipped_missing_column'"
        else:
            bad = "warn" if check.severity == "warn" else "fail"
            failures = _failures_sql(check)
            status = f"case when failures = 0 then 'pass' else '{bad}' end"
        rows.append(
            f"select '{check.name}' as check_name, '{check.table}' as table_name,"
            f" '{check.column}' as column_name, '{check.severity}' as severity, failures,"
            f" {status} as status from (select {failures} as failures)"
        )
    return sql("\nunion all ".join(rows))


def run_suite(domain: Domain, checks: list[Check]) -> DataFrame:
    names = {c.table for c in checks} | {c.parent for c in checks if c.parent}
    return run_checks({name: TABLES[name][0](domain) for name in sorted(names)}, checks)


def suite(name: str, checks: list[Check]) -> None:
    case(name, suite_sql(checks))(lambda d: run_suite(d, checks))


suite("check_not_null", checks_of("platform", kind="not_null"))
suite("check_unique", checks_of("platform", "commercial_staging", "customers", kind="unique"))
suite("check_accepted_values", checks_of("platform", "customers", kind="accepted_values"))
suite("check_relationships", checks_of("platform", "orders", kind="relationships"))
suite("check_suite_platform", checks_of("platform"))
suite("check_suite_commercial", checks_of("commercial_staging", "customers", "orders"))
suite("check_suite_commercial_sources", checks_of("commercial_sources"))
suite(
    "check_suite_consumers",
    checks_of("finance_staging", "revenue", "attribution", "usage", "enriched", "spine"),
)
suite(
    "contract_constraints",
    [c for contract in CONTRACTS.values() for c in contract_checks(contract)],
)
suite(
    "contract_primary_key",
    [c for c in contract_checks(CONTRACTS["fct_orders_v1"]) if c.kind == "unique"]
    + [c for c in contract_checks(CONTRACTS["dim_customers_v1"]) if c.kind == "unique"],
)
suite(
    "contract_foreign_key",
    [c for c in contract_checks(CONTRACTS["fct_orders_v1"]) if c.kind == "relationships"],
)

_COMMERCIAL = checks_of("commercial_staging")
case(
    "check_suite_status",
    sql(f"""
        select count(*) as checks, count(*) filter (status = 'pass') as passed,
               count(*) filter (status = 'warn') as warned,
               count(*) filter (status = 'fail') as failed,
               count(*) filter (status = 'skipped_missing_column') as skipped,
               case when count(*) filter (status = 'fail') > 0 then 'fail'
                    when count(*) filter (status = 'warn') > 0 then 'warn' else 'pass' end as status
        from ({suite_sql(_COMMERCIAL)})"""),
)(lambda d: suite_status(run_suite(d, _COMMERCIAL)))

case(
    "check_failing_rows_unique",
    sql("""
        select lineitem_key, count(*) as n_records from stg_commercial__lineitems
        where lineitem_key is not null group by 1 having count(*) > 1"""),
)(
    lambda d: failing_rows(
        d.lineitems(), Check("unique", "stg_commercial__lineitems", "lineitem_key")
    )
)


# -- contracts --

_MARTS = ("fct_orders_v1", "dim_customers_v1", "fct_revenue_v1", "fct_attribution_v1",
          "fct_usage_v1")



_MISMATCHED = {
    "fct_orders_v1": {"avg_discount_rate": ("decimal(18,2)", "decimal(24,8)"),
                      "total_quantity": ("bigint", "decimal(18,2)")},
    "dim_customers_v1": {"nation_key": ("bigint", "int"),
                         "lifetime_gross_revenue": ("decimal(18,2)", "decimal(38,2)"),
                         "lifetime_net_revenue": ("decimal(18,2)", "decimal(38,2)")},
    "fct_revenue_v1": {"gross_revenue": ("decimal(18,2)", "decimal(38,2)"),
                       "net_revenue": ("decimal(18,2)", "decimal(38,2)"),
                       "total_discount_amount": ("decimal(18,2)", "decimal(38,2)"),
                       "avg_discount_rate": ("decimal(18,2)", "decimal(18,4)")},
    "fct_attribution_v1": {"nation_key": ("bigint", "int"),
                           "segment_revenue": ("decimal(18,2)", "decimal(38,2)"),
                           "avg_customer_revenue": ("decimal(18,2)", "decimal(24,8)"),
                           "avg_tenure_days": ("decimal(18,2)", "decimal(24,8)"),
                           "avg_orders_per_customer": ("decimal(18,2)", "decimal(24,8)")},
    "fct_usage_v1": {"feature_id": ("bigint", "int"),
                     "total_usage_value": ("decimal(18,2)", "decimal(38,2)"),
                     "churn_rate": ("decimal(18,2)", "decimal(18,4)"),
                     "total_quantity": ("bigint", "decimal(38,2)")},
}
_DIFF_SQL = "\nunion all ".join(
    f"select '{table}' as table_name, '{column}' as column_name, 'type_mismatch' as issue,"
    f" '{want}' as expected, '{have}' as actual,"
    f" count(*) filter (cast({column} as {want}) <> {column}) as changed_rows"
    f" from {TABLES[table][1]}"
    for table, columns in _MISMATCHED.items()
    for column, (want, have) in columns.items()
)


_CHANGED = "fct_usage_v1_changed"
_CHANGED_SQL = "\nunion all ".join(
    [
        f"select '{_CHANGED}', '{column}', 'type_mismatch', '{want}', '{have}',"
        f" count(*) filter (cast({column} as {want}) <> {column}) from {TABLES['fct_usage_v1'][1]}"
        for column, (want, have) in _MISMATCHED["fct_usage_v1"].items()
    ]
    + [
        f"select '{_CHANGED}', 'unique_users', 'type_mismatch', 'bigint', 'string', 0",
        f"select '{_CHANGED}', 'churned_events', 'missing', 'bigint', null, null",
        f"select '{_CHANGED}', 'note', 'extra', null, 'string', null",
    ]
)


@case("check_contract_diff", sql(f"{_DIFF_SQL}\nunion all {_CHANGED_SQL}"))
def contract_differences(d):
    """Where the marts' own types differ from the contracts, and how many values that would touch."""
    parts = []
    marts = [(TABLES[table][0](d), CONTRACTS[table]) for table in _MARTS]
    # a mart that lost a column, gained one, and holds one as text
    usage = d.fct_usage()
    changed = usage.drop("churned_events").withColumns(
        {"unique_users": usage["unique_users"].cast("string"), "note": F.lit("new")}
    )
    marts.append((changed, replace(CONTRACTS["fct_usage_v1"], table=_CHANGED)))
    for mart, contract in marts:
        loss = contract_loss(mart, contract)
        parts.append(contract_diff(mart, contract).join(loss, ["table_name", "column_name"], "left"))
    result = parts[0]
    for other in parts[1:]:
        result = result.unionByName(other)
    return result


case(
    "contract_coerced_fct_orders",
    sql("""
        select order_key, customer_key, order_date, order_status, order_status_label,
               order_priority, is_high_priority, gross_revenue, net_revenue, extended_revenue,
               cast(total_quantity as bigint) as total_quantity, line_item_count,
               cast(avg_discount_rate as decimal(18,2)) as avg_discount_rate, first_ship_date,
               last_receipt_date, returned_lines, late_lines
        from fact"""),
)(lambda d: coerce_contract(d.fct_orders(), CONTRACTS["fct_orders_v1"], enforce=True))

case(
    "contract_coerced_fct_attribution",
    sql("""
        select market_segment, customer_tier, cast(nation_key as bigint) as nation_key,
               customer_count, cast(segment_revenue as decimal(18,2)) as segment_revenue,
               cast(avg_customer_revenue as decimal(18,2)) as avg_customer_revenue,
               high_value_count, never_ordered_count, frequency_segment, monetary_segment,
               delinquent_count, cast(avg_tenure_days as decimal(18,2)) as avg_tenure_days,
               segment_order_count,
               cast(avg_orders_per_customer as decimal(18,2)) as avg_orders_per_customer
        from attribution"""),
)(lambda d: coerce_contract(d.fct_attribution(), CONTRACTS["fct_attribution_v1"], enforce=True))

_PII = PII_COLUMNS["stg_commercial__customers"]
case(
    "pii_excluded_customers",
    sql("""
        select * exclude (customer_name, customer_address, customer_phone)
        from stg_commercial__customers"""),
)(lambda d: assert_no_pii(exclude_pii(d.customers(), _PII), _PII))


# -- freshness --


def _age_sql(table: str, column: str, name: str, sla: str, as_of: str, limits: str) -> str:
    return f"""
        select '{name}' as table_name, '{sla}' as sla, newest as max_loaded_at,
               date_diff('second', newest, timestamp '{as_of}') as age_seconds,
               {limits} as status
        from (select max(cast({column} as timestamp)) as newest from {table})"""


def _limits(as_of: str, warn: int, error: int) -> str:
    age = f"date_diff('second', newest, timestamp '{as_of}')"
    return (
        f"case when {age} > {error * 3600} then 'error' when {age} > {warn * 3600} then 'warn'"
        " else 'pass' end"
    )


_EVENTS_AS_OF = dt.datetime(2024, 2, 1, 1, 30)
_E = str(_EVENTS_AS_OF)
case(
    "freshness_events",
    "\nunion all ".join(
        [
            _age_sql("events", "ts", "events", "realtime", _E, _limits(_E, 1, 3)),
            _age_sql("events", "ts", "events", "daily", _E, _limits(_E, 25, 49)),
            _age_sql("events", "ts", "events", "static", _E, "'not_checked'"),
        ]
    ),
)(
    lambda d: freshness(d.table("events"), "events", "ts", _EVENTS_AS_OF, "realtime")
    .unionByName(freshness(d.table("events"), "events", "ts", _EVENTS_AS_OF, "daily"))
    .unionByName(freshness(d.table("events"), "events", "ts", _EVENTS_AS_OF, "static"))
)

_ORDERS_AS_OF = dt.datetime(2001, 8, 2, 12, 0)
_O = str(_ORDERS_AS_OF)
case(
    "freshness_orders",
    _age_sql("orders", "o_orderdate", "orders", "daily", _O, _limits(_O, 25, 49))
    + "\nunion all "
    + _age_sql("lineitem", "l_shipdate", "lineitem", "daily", _O, _limits(_O, 25, 49)),
)(
    lambda d: freshness(d.table("orders"), "orders", "o_orderdate", _ORDERS_AS_OF, "daily")
    .unionByName(
        freshness(d.table("lineitem"), "lineitem", "l_shipdate", _ORDERS_AS_OF, "hourly")
    )
)

# Published marts: their newest dates were observed while they were written, so no rows are read.
_MART_DATES = {
    "fct_orders": ("order_date", "fact"),
    "dim_customers": ("last_order_date", "dim"),
    "fct_revenue": ("order_month", "revenue"),
    "fct_usage": ("usage_month", "usage_month"),
}


@case(
    "freshness_marts",
    sql("\nunion all ".join(
        _age_sql(view, column, mart, "daily", _O, _limits(_O, 25, 49)) for mart, (column, view) in _MART_DATES.items()
    )),
)
def mart_ages(d: Domain) -> DataFrame:
    marts = d.published()
    parts = []
    for mart, (column, _) in _MART_DATES.items():
        getattr(marts, mart)()
        parts.append(freshness_observed(marts.store.results(mart, 1), mart, column, _ORDERS_AS_OF))
    return reduce(DataFrame.unionByName, parts)


# The declared sources that have a date, at their service level; events at the limits of a new source.
_DECLARED_AS_OF = dt.datetime(2024, 2, 10, 1, 30)
_D = str(_DECLARED_AS_OF)
case(
    "freshness_declared",
    "\nunion all ".join(
        [
            _age_sql("orders", "o_orderdate", "orders", "daily", _D, _limits(_D, 25, 49)),
            _age_sql("lineitem", "l_shipdate", "lineitem", "daily", _D, _limits(_D, 25, 49)),
            _age_sql("events", "ts", "events", "declared", _D, _limits(_D, 7 * 24, 30 * 24)),
        ]
    ),
)(
    lambda d: freshness(
        d.table("orders"), "orders", "o_orderdate", _DECLARED_AS_OF, SOURCE_SLA["orders"]
    )
    .unionByName(
        freshness(d.table("lineitem"), "lineitem", "l_shipdate", _DECLARED_AS_OF, SOURCE_SLA["lineitem"])
    )
    .unionByName(
        freshness(d.table("events"), "events", "ts", _DECLARED_AS_OF, limits=NEW_SOURCE_LIMITS)
    )
)

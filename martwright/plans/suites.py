"""The declared checks of all domains, as data: 164 column checks in eleven suites."""

from __future__ import annotations

from martwright.operators.checks import Check

SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")


def _table(
    table: str,
    not_null: str = "",
    unique: str = "",
    accepted: dict[str, tuple[str, ...]] | None = None,
    parents: dict[str, tuple[str, str]] | None = None,
    soft: bool = False,
    default: str = "error",
) -> list[Check]:
    """``soft`` tables only warn about values outside a list and about missing parents."""
    severity = "warn" if soft else default
    checks = [Check("not_null", table, c, default) for c in not_null.split()]
    checks += [Check("unique", table, c, default) for c in unique.split()]
    for column, values in (accepted or {}).items():
        checks.append(Check("accepted_values", table, column, severity, values))
    for column, (parent, field) in (parents or {}).items():
        checks.append(
            Check("relationships", table, column, severity, parent=parent, parent_column=field)
        )
    return checks


# Everything below.
SUITES: dict[str, list[Check]] = {
    "platform": [
        *_table(
            "stg_tpch__customer",
            "custkey name address nationkey phone acctbal mktsegment",
            accepted={"mktsegment": SEGMENTS},
            parents={"custkey": ("stg_tpch__customer", "custkey")},
            soft=True,
        ),
        *_table(
            "stg_tpch__lineitem",
            "orderkey partkey suppkey linenumber quantity extendedprice discount tax returnflag"
            " linestatus shipdate commitdate receiptdate shipinstruct shipmode",
            accepted={
                "linenumber": ("1", "2", "3", "4", "5", "6", "7"),
                "tax": (
                    "0.00", "0.01", "0.02", "0.03", "0.04", "0.05", "0.06", "0.07", "0.08",
                ),
                "returnflag": ("A", "N", "R"),
                "linestatus": ("F", "O"),
                "shipinstruct": ("COLLECT COD", "DELIVER IN PERSON", "NONE", "TAKE BACK RETURN"),
                "shipmode": ("AIR", "FOB", "MAIL", "RAIL", "REG AIR", "SHIP", "TRUCK"),
            },
            parents={
                "partkey": ("stg_tpch__part", "partkey"),
                "suppkey": ("stg_tpch__supplier", "suppkey"),
            },
            soft=True,
        ),
        *_table(
            "stg_tpch__nation",
            "nationkey name regionkey",
            parents={"regionkey": ("stg_tpch__region", "regionkey")},
            soft=True,
        ),
        *_table(
            "stg_tpch__orders",
            "orderkey custkey orderstatus totalprice orderdate orderpriority clerk shippriority",
            accepted={
                "orderstatus": ("F", "O", "P"),
                "orderpriority": ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"),
            },
            parents={"custkey": ("stg_tpch__customer", "custkey")},
            soft=True,
        ),
        *_table(
            "stg_tpch__part",
            "partkey name mfgr brand type size container retailprice",
            "partkey",
            accepted={
                "mfgr": (
                    "Manufacturer#1",
                    "Manufacturer#2",
                    "Manufacturer#3",
                    "Manufacturer#4",
                    "Manufacturer#5",
                )
            },
            soft=True,
        ),
        *_table(
            "stg_tpch__partsupp",
            "partkey suppkey availqty supplycost",
            parents={
                "partkey": ("stg_tpch__part", "partkey"),
                "suppkey": ("stg_tpch__supplier", "suppkey"),
            },
            soft=True,
        ),
        *_table(
            "stg_tpch__region",
            "regionkey name",
            "regionkey",
            accepted={"name": ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")},
            soft=True,
        ),
        *_table(
            "stg_tpch__supplier",
            "suppkey name address nationkey phone acctbal",
            parents={"suppkey": ("stg_tpch__supplier", "suppkey")},
            soft=True,
        ),
    ],
    "commercial_staging": [
        *_table(
            "stg_commercial__orders",
            "order_key customer_key order_status order_priority order_total_price order_date"
            " is_high_priority order_status_label",
            "order_key",
            accepted={
                "order_status": ("F", "O", "P"),
                "order_status_label": ("fulfilled", "open", "partial", "unknown"),
            },
        ),
        *_table(
            "stg_commercial__customers",
            "customer_key nation_key market_segment account_balance is_delinquent is_high_value",
            "customer_key",
            accepted={"market_segment": SEGMENTS},
        ),
        *_table(
            "stg_commercial__lineitems",
            "lineitem_key order_key line_number extended_price discount_rate net_price gross_price"
            " return_flag line_status",
            "lineitem_key",
            accepted={"return_flag": ("R", "A", "N"), "line_status": ("O", "F")},
        ),
    ],
    "commercial_sources": [
        *_table(
            "stg_tpch__orders",
            "orderkey custkey orderstatus totalprice orderdate",
            "orderkey",
            accepted={"orderstatus": ("F", "O", "P")},
        ),
        *_table(
            "stg_tpch__customer",
            "custkey nationkey acctbal mktsegment",
            "custkey",
            accepted={"mktsegment": SEGMENTS},
        ),
        *_table(
            "stg_tpch__lineitem",
            "orderkey linenumber quantity extendedprice discount tax returnflag linestatus",
        ),
        *_table("stg_tpch__nation", "nationkey name regionkey", "nationkey"),
    ],
    "customers": _table(
        "dim_customers_v1",
        "customer_key nation_key market_segment is_delinquent customer_tier",
        "customer_key",
        accepted={
            "market_segment": SEGMENTS,
            "customer_tier": ("platinum", "gold", "silver", "bronze"),
        },
    ),
    "orders": _table(
        "fct_orders_v1",
        "order_key customer_key order_date order_status",
        "order_key",
        accepted={"order_status": ("F", "O", "P")},
        parents={"customer_key": ("dim_customers_v1", "customer_key")},
    ),
    "finance_staging": _table(
        "stg_finance__orders", "order_key gross_revenue net_revenue", "order_key"
    ),
    "revenue": _table("fct_revenue_v1", "customer_key order_month"),
    "attribution": _table("fct_attribution_v1", "market_segment customer_tier nation_key"),
    "usage": _table("fct_usage_v1", "feature_id usage_month"),
    "enriched": _table(
        "fct_orders_enriched",
        "order_key customer_key order_date gross_revenue net_revenue",
        "order_key",
        default="warn",  # the analytics domain consumes: its checks never fail a build
    ),
    "spine": _table("metricflow_time_spine", "date_day", "date_day", default="warn"),
}


def all_checks() -> list[Check]:
    return [check for suite in SUITES.values() for check in suite]


def checks_of(*suites: str, kind: str | None = None) -> list[Check]:
    return [c for s in suites for c in SUITES[s] if kind is None or c.kind == kind]

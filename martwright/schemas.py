"""Declared schemas: raw tables, public contracts, PII columns.

Money is decimal(18,2) and rates decimal(4,2), so that sums and rounding are exact.
"""

from __future__ import annotations

from dataclasses import dataclass

MONEY = "decimal(18,2)"
RATE = "decimal(4,2)"
AVERAGE = "decimal(24,8)"  # exact means, rounded half up once
WIDE_MONEY = "decimal(38,2)"  # totals above customer grain: no overflow however many rows


Schema = dict[str, str]  # column name -> Spark type, in source order


def struct(ddl: str) -> Schema:
    return dict(field.split() for field in ddl.split(", "))


# The raw tables with their columns in source order.
RAW: dict[str, Schema] = {
    "customer": struct(
        f"c_custkey long, c_name string, c_address string, c_nationkey int, c_phone string,"
        f" c_acctbal {MONEY}, c_mktsegment string, c_comment string"
    ),
    "lineitem": struct(
        f"l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity {MONEY},"
        f" l_extendedprice {MONEY}, l_discount {RATE}, l_tax {RATE}, l_returnflag string,"
        f" l_linestatus string, l_shipdate date, l_commitdate date, l_receiptdate date,"
        f" l_shipinstruct string, l_shipmode string, l_comment string"
    ),
    "nation": struct("n_nationkey int, n_name string, n_regionkey int, n_comment string"),
    "orders": struct(
        f"o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice {MONEY},"
        f" o_orderdate date, o_orderpriority string, o_clerk string, o_shippriority int,"
        f" o_comment string"
    ),
    "part": struct(
        f"p_partkey long, p_name string, p_mfgr string, p_brand string, p_type string, p_size int,"
        f" p_container string, p_retailprice {MONEY}, p_comment string"
    ),
    "partsupp": struct(
        f"ps_partkey long, ps_suppkey long, ps_availqty int, ps_supplycost {MONEY},"
        f" ps_comment string"
    ),
    "region": struct("r_regionkey int, r_name string, r_comment string"),
    "supplier": struct(
        f"s_suppkey long, s_name string, s_address string, s_nationkey int, s_phone string,"
        f" s_acctbal {MONEY}, s_comment string"
    ),
}


@dataclass(frozen=True)
class ContractColumn:
    name: str
    data_type: str  # contract spelling, e.g. number(18,2)
    not_null: bool = False


@dataclass(frozen=True)
class Contract:
    table: str
    columns: tuple[ContractColumn, ...]
    primary_key: str | None = None
    foreign_keys: tuple[tuple[str, str, str], ...] = ()  # (column, parent table, parent column)

    @property
    def required(self) -> list[str]:
        return [c.name for c in self.columns if c.not_null]


def _contract(table: str, text: str, **keys) -> Contract:
    """``name type`` per line; a trailing ``!`` marks a not-null column."""
    columns = []
    for line in filter(None, (part.strip() for part in text.splitlines())):
        name, data_type = line.rstrip("! ").split()
        columns.append(ContractColumn(name, data_type, line.endswith("!")))
    return Contract(table, tuple(columns), **keys)


# The five enforced public contracts.
CONTRACTS: dict[str, Contract] = {
    c.table: c
    for c in (
        _contract(
            "fct_orders_v1",
            """
            order_key number(38,0) !
            customer_key number(38,0) !
            order_date date !
            order_status varchar !
            order_status_label varchar !
            order_priority varchar !
            is_high_priority boolean !
            gross_revenue number(18,2) !
            net_revenue number(18,2) !
            extended_revenue number(18,2) !
            total_quantity number(38,0) !
            line_item_count number(38,0) !
            avg_discount_rate number(18,2)
            first_ship_date date
            last_receipt_date date
            returned_lines number(38,0)
            late_lines number(38,0)
            """,
            primary_key="order_key",
            foreign_keys=(("customer_key", "dim_customers_v1", "customer_key"),),
        ),
        _contract(
            "dim_customers_v1",
            """
            customer_key number(38,0) !
            nation_key number(38,0) !
            market_segment varchar !
            account_balance number(18,2) !
            is_delinquent boolean !
            is_high_value boolean !
            total_orders number(38,0) !
            lifetime_gross_revenue number(18,2) !
            lifetime_net_revenue number(18,2) !
            first_order_date date
            last_order_date date
            customer_tenure_days number(38,0) !
            total_returns number(38,0) !
            customer_tier varchar !
            is_never_ordered boolean !
            """,
            primary_key="customer_key",
        ),
        _contract(
            "fct_revenue_v1",
            """
            customer_key number(38,0) !
            order_month date !
            gross_revenue number(18,2) !
            net_revenue number(18,2) !
            order_count number(38,0) !
            avg_order_value number(18,2)
            order_quarter date
            order_year number(38,0)
            total_discount_amount number(18,2)
            avg_discount_rate number(18,2)
            total_line_items number(38,0)
            """,
        ),
        _contract(
            "fct_attribution_v1",
            """
            market_segment varchar !
            customer_tier varchar !
            nation_key number(38,0) !
            customer_count number(38,0) !
            segment_revenue number(18,2)
            avg_customer_revenue number(18,2)
            high_value_count number(38,0)
            never_ordered_count number(38,0)
            frequency_segment varchar
            monetary_segment varchar
            delinquent_count number(38,0)
            avg_tenure_days number(18,2)
            segment_order_count number(38,0)
            avg_orders_per_customer number(18,2)
            """,
        ),
        _contract(
            "fct_usage_v1",
            """
            feature_id number(38,0) !
            feature_category varchar !
            usage_month date !
            total_events number(38,0) !
            unique_users number(38,0) !
            total_usage_value number(18,2)
            churn_rate number(18,2)
            total_quantity number(38,0)
            churned_events number(38,0)
            """,
        ),
    )
}

# Columns that may not appear in a public contract.
PII_COLUMNS: dict[str, tuple[str, ...]] = {
    "stg_tpch__customer": ("name", "address", "phone"),
    "stg_commercial__customers": ("customer_name", "customer_address", "customer_phone"),
}

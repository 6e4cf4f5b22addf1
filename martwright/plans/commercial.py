"""Commercial domain: staging, order items, the order fact and the customer dimension.

The order fact and the customer history both rest on ``order_rollup``, which adds up the lines of
an order *before* joining the order header. Lines are the largest table, so they are shuffled once,
already combined on the map side (an order with very many lines arrives as a few partial rows), and
the join, the regrouping and the marks that count a customer's orders all reuse that partitioning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martwright.functions import (
    buckets,
    days_between,
    flag,
    from_cents,
    round_cents,
    round_ratio,
    surrogate_key,
    to_cents,
)
from martwright.schemas import AVERAGE, MONEY, WIDE_MONEY

# Codes, labels and thresholds of the domain.
HIGH_PRIORITIES = ("1-URGENT", "2-HIGH")
STATUS_LABELS = {"F": "fulfilled", "O": "open", "P": "partial"}
HIGH_VALUE_BALANCE = 5000
RETURNED = "R"
CUSTOMER_TIERS = [(500000, "platinum"), (100000, "gold"), (10000, "silver")]
LOWEST_TIER = "bronze"

ORDER_ATTRIBUTES = [
    "order_key",
    "customer_key",
    "order_date",
    "order_status",
    "order_status_label",
    "order_priority",
    "is_high_priority",
]


def stg_commercial__orders(orders: DataFrame) -> DataFrame:
    status = F.col("orderstatus")
    label = F.when(F.lit(False), "unknown")
    for code, text in STATUS_LABELS.items():
        label = label.when(status == code, text)
    return orders.select(
        F.col("orderkey").alias("order_key"),
        F.col("custkey").alias("customer_key"),
        status.alias("order_status"),
        F.col("orderpriority").alias("order_priority"),
        F.col("clerk").alias("clerk_name"),
        F.col("shippriority").alias("ship_priority"),
        F.col("totalprice").alias("order_total_price"),
        F.col("orderdate").cast("date").alias("order_date"),
        flag(F.col("orderpriority").isin(*HIGH_PRIORITIES)).alias("is_high_priority"),
        label.otherwise("unknown").alias("order_status_label"),
        F.col("comment").alias("order_comment"),
    )


def stg_commercial__customers(customers: DataFrame) -> DataFrame:
    balance = F.col("acctbal")
    return customers.select(
        F.col("custkey").alias("customer_key"),
        F.col("nationkey").alias("nation_key"),
        F.col("name").alias("customer_name"),
        F.col("address").alias("customer_address"),
        F.col("phone").alias("customer_phone"),
        F.col("mktsegment").alias("market_segment"),
        balance.alias("account_balance"),
        flag(balance < 0).alias("is_delinquent"),
        flag(balance >= HIGH_VALUE_BALANCE).alias("is_high_value"),
        F.col("comment").alias("customer_comment"),
    )


def stg_commercial__lineitems(lineitems: DataFrame) -> DataFrame:
    """Net price is after discount; gross adds tax on top and is rounded once, not from net."""
    discounted = F.col("extendedprice") * (1 - F.col("discount"))
    return lineitems.select(
        surrogate_key("orderkey", "linenumber").alias("lineitem_key"),
        F.col("orderkey").alias("order_key"),
        F.col("linenumber").alias("line_number"),
        F.col("returnflag").alias("return_flag"),
        F.col("linestatus").alias("line_status"),
        F.col("shipmode").alias("ship_mode"),
        "quantity",
        F.col("extendedprice").alias("extended_price"),
        F.col("discount").alias("discount_rate"),
        F.col("tax").alias("tax_rate"),
        F.round(discounted, 2).cast(MONEY).alias("net_price"),
        F.round(discounted * (1 + F.col("tax")), 2).cast(MONEY).alias("gross_price"),
        F.col("shipdate").cast("date").alias("ship_date"),
        F.col("commitdate").cast("date").alias("commit_date"),
        F.col("receiptdate").cast("date").alias("receipt_date"),
    )


def _is_returned():
    return F.col("return_flag") == RETURNED


def _is_late():
    return F.col("receipt_date") > F.col("commit_date")


def int_order_items(orders: DataFrame, lineitems: DataFrame) -> DataFrame:
    """Order header and line side by side, one row per line."""
    return lineitems.join(orders, "order_key").select(
        "lineitem_key",
        "order_key",
        "customer_key",
        "order_date",
        "order_status",
        "order_status_label",
        "order_priority",
        "is_high_priority",
        "clerk_name",
        "line_number",
        "return_flag",
        "line_status",
        "ship_mode",
        "ship_date",
        "commit_date",
        "receipt_date",
        days_between("order_date", "ship_date").alias("days_to_ship"),
        days_between("ship_date", "receipt_date").alias("days_in_transit"),
        days_between("commit_date", "receipt_date").alias("days_vs_commit"),
        "quantity",
        "extended_price",
        "discount_rate",
        "tax_rate",
        "net_price",
        "gross_price",
        flag(_is_returned()).alias("is_returned"),
        flag(_is_late()).alias("is_late_delivery"),
    )


def _line_totals(lineitems: DataFrame) -> DataFrame:
    """Per order: line totals in whole cents, straight from the platform's staged lines."""

    def cents(name: str):
        return to_cents(name).alias(name)

    priced = lineitems.select(
        F.col("orderkey").alias("order_key"),
        cents("quantity"),
        cents("extendedprice"),
        cents("discount"),
        cents("tax"),
        flag(F.col("returnflag") == RETURNED).cast("int").alias("returned"),
        flag(F.col("receiptdate") > F.col("commitdate")).cast("int").alias("late"),
        F.col("shipdate").cast("date").alias("ship_date"),
        F.col("receiptdate").cast("date").alias("receipt_date"),
    ).withColumns(
        {
            "net": round_cents("extendedprice * (100 - discount)", 100),
            "gross": round_cents("extendedprice * (100 - discount) * (100 + tax)", 10000),
        }
    )
    return priced.groupBy("order_key").agg(
        F.sum("gross").alias("gross_revenue"),
        F.sum("net").alias("net_revenue"),
        F.sum("extendedprice").alias("extended_revenue"),
        F.sum("quantity").alias("total_quantity"),
        F.sum("discount").alias("discount_rates"),
        F.count(F.lit(1)).alias("line_item_count"),
        F.count("gross").alias("priced_lines"),
        F.count("discount").alias("discounted_lines"),
        F.sum("returned").alias("returned_lines"),
        F.sum("late").alias("late_lines"),
        F.min("ship_date").alias("first_ship_date"),
        F.max("receipt_date").alias("last_receipt_date"),
    )


def order_rollup(orders: DataFrame, platform_lineitems: DataFrame) -> DataFrame:
    """Per order: attributes and line totals, everything the marts above line grain need.

    The same numbers as grouping ``int_order_items`` by the order attributes, from commercial orders
    and platform lines. The second grouping keeps the totals right should an order header occur
    twice; it needs no shuffle, since the rows are partitioned by order key already. Nor does marking one
    row of each order and customer (``distinct_orders`` is 1 there, else 0): adding the marks up counts
    a customer's orders without bringing the stored rows of an order together again.
    """
    amounts = [
        "gross_revenue",
        "net_revenue",
        "extended_revenue",
        "total_quantity",
        "discount_rates",
    ]
    counts = [
        "line_item_count",
        "priced_lines",
        "discounted_lines",
        "returned_lines",
        "late_lines",
    ]
    grouped = (
        _line_totals(platform_lineitems)
        .join(orders.select(*ORDER_ATTRIBUTES), "order_key")
        .groupBy(*ORDER_ATTRIBUTES)
        .agg(
            *[F.sum(c).alias(c) for c in amounts + counts],
            F.min("first_ship_date").alias("first_ship_date"),
            F.max("last_receipt_date").alias("last_receipt_date"),
        )
    )
    of_customer = Window.partitionBy("order_key", "customer_key").orderBy("order_key")
    first = (F.row_number().over(of_customer) == 1).cast("int")
    return grouped.withColumns({c: from_cents(c, MONEY) for c in amounts} | {"distinct_orders": first})


def fct_orders_v1(rollup: DataFrame) -> DataFrame:
    """One row per order that has lines."""
    mean_rate = round_ratio("discount_rates", "discounted_lines", 8).cast(AVERAGE)
    return rollup.select(
        *ORDER_ATTRIBUTES,
        "gross_revenue",
        "net_revenue",
        "extended_revenue",
        "total_quantity",
        "line_item_count",
        mean_rate.alias("avg_discount_rate"),
        "first_ship_date",
        "last_receipt_date",
        "returned_lines",
        "late_lines",
    )


def fct_orders_v2(rollup: DataFrame) -> DataFrame:
    """v1 with ``gross_revenue`` under its glossary name."""
    return fct_orders_v1(rollup).withColumnRenamed("gross_revenue", "total_revenue")


def int_customer_orders(rollup: DataFrame) -> DataFrame:
    """Order history per customer. The status and priority counts count lines, not orders.

    Orders are counted by the marks of the rollup, so one shuffle on the customer, of map-side combined
    rows, is all it takes.
    """
    lines = F.col("line_item_count")
    done = F.when(F.col("order_status_label") == "fulfilled", lines).otherwise(0)
    urgent = F.when(F.col("is_high_priority"), lines).otherwise(0)
    return (
        rollup.groupBy("customer_key")
        .agg(
            F.sum("distinct_orders").alias("total_orders"),
            F.sum(lines).alias("total_line_items"),
            F.sum("total_quantity").cast(WIDE_MONEY).alias("total_quantity"),
            F.sum("gross_revenue").cast(WIDE_MONEY).alias("lifetime_gross_revenue"),
            F.sum("net_revenue").cast(WIDE_MONEY).alias("lifetime_net_revenue"),
            F.sum("priced_lines").alias("priced"),
            F.min("order_date").alias("first_order_date"),
            F.max("order_date").alias("last_order_date"),
            F.sum("returned_lines").alias("total_returns"),
            F.sum("late_lines").alias("total_late_deliveries"),
            F.sum(done).alias("fulfilled_orders"),
            F.sum(urgent).alias("high_priority_orders"),
        )
        .select(
            "customer_key",
            "total_orders",
            "total_line_items",
            "total_quantity",
            "lifetime_gross_revenue",
            "lifetime_net_revenue",
            round_ratio("lifetime_gross_revenue", "priced", 8)
            .cast(AVERAGE)
            .alias("avg_line_gross_revenue"),
            "first_order_date",
            "last_order_date",
            days_between("first_order_date", "last_order_date").alias("customer_tenure_days"),
            "total_returns",
            "total_late_deliveries",
            "fulfilled_orders",
            "high_priority_orders",
        )
    )


def dim_customers_v1(customers: DataFrame, customer_orders: DataFrame) -> DataFrame:
    """One row per customer, without names, addresses and phones."""

    def or_zero(name: str):
        return F.coalesce(F.col(name), F.lit(0).cast(kind[name])).alias(name)

    kind = dict(customer_orders.dtypes)
    lifetime = F.coalesce(F.col("lifetime_gross_revenue"), F.lit(0))
    return customers.join(customer_orders, "customer_key", "left").select(
        "customer_key",
        "nation_key",
        "market_segment",
        "account_balance",
        "is_delinquent",
        "is_high_value",
        or_zero("total_orders"),
        or_zero("lifetime_gross_revenue"),
        or_zero("lifetime_net_revenue"),
        "first_order_date",
        "last_order_date",
        or_zero("customer_tenure_days"),
        or_zero("total_returns"),
        buckets(lifetime, CUSTOMER_TIERS, LOWEST_TIER).alias("customer_tier"),
        F.col("total_orders").isNull().alias("is_never_ordered"),
    )

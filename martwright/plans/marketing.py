"""Marketing domain: customer segments and their attribution metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martwright.functions import buckets, round_ratio
from martwright.schemas import AVERAGE, WIDE_MONEY

# Segment thresholds.
FREQUENCY_STEPS = [(10, "high"), (3, "medium")]
MONETARY_STEPS = [(500000, "high"), (50000, "medium")]

SEGMENT_KEYS = [
    "market_segment",
    "customer_tier",
    "nation_key",
    "frequency_segment",
    "monetary_segment",
]


def stg_marketing__customers(dim_customers: DataFrame) -> DataFrame:
    return dim_customers.select(
        "customer_key",
        "nation_key",
        "market_segment",
        "account_balance",
        "is_high_value",
        "is_delinquent",
        "customer_tier",
        "lifetime_gross_revenue",
        "total_orders",
        "first_order_date",
        "last_order_date",
        "customer_tenure_days",
        "total_returns",
        "is_never_ordered",
        buckets(F.col("total_orders"), FREQUENCY_STEPS, "low").alias("frequency_segment"),
        buckets(F.col("lifetime_gross_revenue"), MONETARY_STEPS, "low").alias("monetary_segment"),
    )


def fct_attribution_v1(customers: DataFrame) -> DataFrame:
    """Per segment combination: sizes, revenue, order counts, averages."""

    def mean(name: str):
        return round_ratio(F.sum(name), F.count(name), 8).cast(AVERAGE)

    def members(name: str):
        return F.sum(F.when(F.col(name), 1).otherwise(0))

    return customers.groupBy(*SEGMENT_KEYS).agg(
        F.count("customer_key").alias("customer_count"),
        F.sum("lifetime_gross_revenue").cast(WIDE_MONEY).alias("segment_revenue"),
        mean("lifetime_gross_revenue").alias("avg_customer_revenue"),
        F.sum("total_orders").alias("segment_order_count"),
        mean("total_orders").alias("avg_orders_per_customer"),
        members("is_high_value").alias("high_value_count"),
        members("is_never_ordered").alias("never_ordered_count"),
        members("is_delinquent").alias("delinquent_count"),
        mean("customer_tenure_days").alias("avg_tenure_days"),
    )

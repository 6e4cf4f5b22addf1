"""Finance domain: the order contract with discount figures, and monthly revenue per customer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martwright.functions import month_of, quarter_of, round_ratio, year_of
from martwright.schemas import MONEY, WIDE_MONEY

FRACTION = "decimal(18,4)"


def stg_finance__orders(fct_orders: DataFrame) -> DataFrame:
    """``total_discount_amount`` is gross minus net, as the published name has it."""
    gross, net = F.col("gross_revenue"), F.col("net_revenue")
    discount = (gross - net).cast(MONEY)
    rate = F.when(gross > 0, round_ratio(discount, gross, 4).cast(FRACTION))
    return fct_orders.select(
        "order_key",
        "customer_key",
        "order_date",
        "order_status",
        "order_status_label",
        "gross_revenue",
        "net_revenue",
        "extended_revenue",
        "line_item_count",
        discount.alias("total_discount_amount"),
        rate.otherwise(F.lit(0).cast(FRACTION)).alias("effective_discount_rate"),
        month_of("order_date").alias("order_month"),
        quarter_of("order_date").alias("order_quarter"),
        year_of("order_date").alias("order_year"),
    )


def fct_revenue_v1(finance_orders: DataFrame) -> DataFrame:
    """Revenue per customer and month.

    The distinct order count is first reduced per order key, which the order fact is already
    partitioned by; only combined rows are shuffled to the customer and month.
    """
    rate = F.col("effective_discount_rate")
    orders = F.count_distinct("order_key")
    return finance_orders.groupBy(
        "customer_key", "order_month", "order_quarter", "order_year"
    ).agg(
        F.sum("gross_revenue").cast(WIDE_MONEY).alias("gross_revenue"),
        F.sum("net_revenue").cast(WIDE_MONEY).alias("net_revenue"),
        F.sum("total_discount_amount").cast(WIDE_MONEY).alias("total_discount_amount"),
        orders.alias("order_count"),
        F.sum("line_item_count").alias("total_line_items"),
        round_ratio(F.sum(rate), F.count(rate), 4).cast(FRACTION).alias("avg_discount_rate"),
        round_ratio(F.sum("gross_revenue"), orders, 2).cast(MONEY).alias("avg_order_value"),
    )

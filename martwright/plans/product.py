"""Product domain: order lines read as usage events, and monthly usage per feature."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martwright.functions import flag, from_cents, month_of, round_ratio, surrogate_key, to_cents
from martwright.schemas import WIDE_MONEY

CHURNED = "R"  # fixed value: the return flag that counts as churn


def stg_product__usage(lineitems: DataFrame) -> DataFrame:
    day = F.col("shipdate").cast("date")
    return lineitems.filter(F.col("shipdate").isNotNull()).select(
        surrogate_key("orderkey", "linenumber").alias("usage_event_key"),
        F.col("orderkey").alias("order_key"),
        F.col("linenumber").alias("feature_id"),
        F.col("shipmode").alias("feature_category"),
        F.col("quantity").alias("usage_quantity"),
        F.col("extendedprice").alias("usage_value"),
        day.alias("usage_date"),
        month_of(day).alias("usage_month"),
        F.col("returnflag").alias("usage_status"),
        flag(F.col("returnflag") == CHURNED).alias("is_churned"),
    )


def fct_usage_v1(usage: DataFrame) -> DataFrame:
    """Usage per feature, category and month.

    There are few groups and each is large: Spark first reduces by group and order key, which
    spreads one large group over all tasks, and only then by group.
    """

    def total(name: str):
        return from_cents(F.sum(to_cents(name)), WIDE_MONEY)

    events = F.count(F.lit(1))  # the event key is never NULL
    churned = F.sum(F.when(F.col("is_churned"), 1).otherwise(0))
    return usage.groupBy("feature_id", "feature_category", "usage_month").agg(
        events.alias("total_events"),
        F.count_distinct("order_key").alias("unique_users"),
        total("usage_quantity").alias("total_quantity"),
        total("usage_value").alias("total_usage_value"),
        churned.alias("churned_events"),
        round_ratio(churned, events, 4).cast("decimal(18,4)").alias("churn_rate"),
    )

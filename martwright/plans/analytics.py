"""Analytics domain: the cross-domain order mart behind the metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame

from martwright.functions import month_of, quarter_of, year_of

CUSTOMER_ATTRIBUTES = [
    "market_segment",
    "customer_tier",
    "nation_key",
    "is_high_value",
    "is_delinquent",
]


def fct_orders_enriched(fct_orders: DataFrame, dim_customers: DataFrame) -> DataFrame:
    """Every order of the order contract with its customer's public attributes."""
    customers = dim_customers.select("customer_key", *CUSTOMER_ATTRIBUTES)
    return fct_orders.join(customers, "customer_key", "left").select(
        "order_key",
        "customer_key",
        "order_date",
        "order_status",
        "order_status_label",
        "order_priority",
        "is_high_priority",
        *CUSTOMER_ATTRIBUTES,
        "gross_revenue",
        "net_revenue",
        "line_item_count",
        "avg_discount_rate",
        month_of("order_date").alias("order_month"),
        quarter_of("order_date").alias("order_quarter"),
        year_of("order_date").alias("order_year"),
    )

"""Metrics over several marts in one query.

Every measure is aggregated on its own mart, at the dimensions all the marts share, and only these
aggregates are joined, each group once on either side: no mart's rows are multiplied by another's, and no
rows are shuffled together. A group that only some marts have stays, with NULL for the others' metrics.
A ratio may divide a metric of one mart by a metric of another; it is divided after the join.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martwright.operators.metrics import (
    ORDERS,
    Measure,
    Metric,
    SemanticModel,
    _filtered,
    _grouped,
    _ordered,
    _ratio,
    _simple,
    dimension,
    side_by_side,
)
from martwright.schemas import WIDE_MONEY

USAGE = SemanticModel(
    name="usage",
    entities={"feature": "feature_id"},
    time_dimension="usage_month",
    time_dimensions={"usage_month": "month"},
    dimensions=("feature_category",),
    measures=(
        Measure("events", "sum", "total_events"),
        Measure("quantity", "sum", "total_quantity", WIDE_MONEY),
        Measure("value", "sum", "total_usage_value", WIDE_MONEY),
        Measure("churned", "sum", "churned_events"),
    ),
    metrics=(
        Metric("usage_events", "Usage Events", "Product", "events"),
        Metric("usage_quantity", "Usage Quantity", "Product", "quantity"),
        Metric("usage_value", "Usage Value", "Product", "value"),
        Metric("churned_events", "Churned Events", "Product", "churned"),
        Metric("churn_rate", "Churn Rate", "Product", numerator="churned_events", denominator="usage_events"),
    ),
    grain="month",
)

ATTRIBUTION = SemanticModel(
    name="attribution",
    entities={"nation": "nation_key"},
    time_dimension="",
    time_dimensions={},
    dimensions=("market_segment", "customer_tier", "frequency_segment", "monetary_segment"),
    measures=(
        Measure("customers", "sum", "customer_count"),
        Measure("revenue", "sum", "segment_revenue", WIDE_MONEY),
        Measure("never_ordered", "sum", "never_ordered_count"),
    ),
    metrics=(
        Metric("known_customers", "Known Customers", "Marketing", "customers"),
        Metric("segment_revenue", "Segment Revenue", "Marketing", "revenue"),
        Metric("never_ordered", "Never Ordered", "Marketing", "never_ordered"),
    ),
    grain="year",
)

REVENUE = SemanticModel(
    name="revenue",
    entities={"customer": "customer_key"},
    time_dimension="order_month",
    time_dimensions={"order_month": "month", "order_quarter": "quarter"},
    dimensions=("order_year",),
    measures=(
        Measure("booked", "sum", "gross_revenue", WIDE_MONEY),
        Measure("orders", "sum", "order_count"),
        Measure("payers", "count_distinct", "customer_key", dense=True),
    ),
    metrics=(
        Metric("booked_revenue", "Booked Revenue", "Finance", "booked"),
        Metric("booked_orders", "Booked Orders", "Finance", "orders"),
        Metric("paying_customers", "Paying Customers", "Finance", "payers"),
        Metric("booked_per_order", "Booked Per Order", "Finance", numerator="booked_revenue", denominator="booked_orders"),
    ),
    grain="month",
)

MODELS = (ORDERS, USAGE, ATTRIBUTION, REVENUE)


@dataclass(frozen=True)
class CrossRatio:
    """A ratio of two metrics, each written ``model.metric`` or ``metric`` where only one model has it."""

    name: str
    numerator: str
    denominator: str


def _find(name: str, models: tuple[SemanticModel, ...]) -> tuple[SemanticModel, Metric]:
    prefix, _, rest = name.rpartition(".")
    found = [(m, x) for m in models for x in m.metrics if x.name == rest and prefix in ("", m.name)]
    if len(found) != 1:
        raise ValueError(f"{'unknown' if not found else 'ambiguous'} metric: {name}")
    return found[0]


def query_across(
    marts: dict[str, DataFrame],
    metrics: list[str | CrossRatio],
    group_by: list[str] | tuple = (),
    where: str | Column | None = None,
    where_in: dict[str, str | Column] | None = None,
    order: list[str] | tuple = (),
    limit: int | None = None,
    models: tuple[SemanticModel, ...] = MODELS,
) -> DataFrame:
    """Metrics of several marts by the dimensions they share.

    ``marts`` maps a model's name to its mart. ``where`` is a condition on shared dimensions and holds for
    every mart asked; ``where_in`` adds conditions for single ones. A dimension or grain that one of the
    marts lacks is an error, as its rows could only be spread over the others' groups.
    """
    asked: dict[str, dict[str, Metric]] = {}
    by_name = {m.name: m for m in models}

    def need(name: str) -> tuple[str, Metric]:
        """Notes what the metric is made of; gives the model and the metric."""
        model, metric = _find(name, models)
        if model.name not in marts:
            raise ValueError(f"no mart given for {model.name}, which has {metric.name}")
        asked.setdefault(model.name, {}).update({m.name: m for m in _simple(metric, model)})
        return model.name, metric

    def value(found: tuple[str, Metric]) -> Column:
        model, metric = found
        if metric.measure:
            return F.col(f"{model}__in__{metric.name}")
        return _ratio(f"{model}__in__{metric.numerator}", f"{model}__in__{metric.denominator}", metric.name)

    wanted: list[Column] = []
    for item in metrics:
        if isinstance(item, CrossRatio):
            top, bottom = value(need(item.numerator)), value(need(item.denominator))
            wanted.append((top.cast("double") / F.nullif(bottom.cast("double"), F.lit(0.0))).alias(item.name))
        else:
            found = need(item)
            wanted.append(value(found).alias(found[1].name))
    parts = []
    for name, simple in asked.items():
        model, mart = by_name[name], marts[name]
        for key in group_by:
            dimension(model, key)  # raises where the model lacks it
        for condition in (where, (where_in or {}).get(name)):
            if condition is not None:
                mart = _filtered(mart, model, condition)
        grouped = _grouped(mart, model, simple, group_by)
        named = [F.col(m).alias(f"{name}__in__{m}") for m in simple]
        parts.append(grouped.select(*map(F.col, group_by), *named))
    joined = side_by_side(parts, list(group_by))
    return _ordered(joined.select(*map(F.col, group_by), *wanted), order, limit)

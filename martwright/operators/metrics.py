"""Semantic layer: named metrics over a mart, by dimension and time grain.

A metric query is one ``groupBy().agg()`` over the mart, whatever the number of metrics (only several
distinct counts take a pass each); ratios are divided after aggregation, at the grain of the query.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martwright.operators.distinct import count_states, distinct_states
from martwright.schemas import WIDE_MONEY


@dataclass(frozen=True)
class Measure:
    name: str
    agg: str  # sum, average or count_distinct
    expr: str
    type: str = "long"
    dense: bool = False  # for count_distinct: the keys are whole numbers with few gaps


@dataclass(frozen=True)
class Metric:
    name: str
    label: str
    owner: str
    measure: str | None = None
    numerator: str | None = None
    denominator: str | None = None

    @property
    def kind(self) -> str:
        return "simple" if self.measure else "ratio"


@dataclass(frozen=True)
class SemanticModel:
    name: str
    entities: dict[str, str]
    time_dimension: str
    time_dimensions: dict[str, str]  # name -> grain
    dimensions: tuple[str, ...]
    measures: tuple[Measure, ...]
    metrics: tuple[Metric, ...]
    grain: str = "day"  # of a row's time; nothing finer can be asked for

    def measure(self, name: str) -> Measure:
        return next(m for m in self.measures if m.name == name)

    def metric(self, name: str) -> Metric:
        for metric in self.metrics:
            if metric.name == name:
                return metric
        raise ValueError(f"unknown metric: {name}")


# The semantic model of orders and its eight metrics.
ORDERS = SemanticModel(
    name="orders",
    entities={"order": "order_key", "customer": "customer_key"},
    time_dimension="order_date",
    time_dimensions={"order_date": "day", "order_month": "month"},
    dimensions=(
        "order_status",
        "order_status_label",
        "market_segment",
        "customer_tier",
        "order_priority",
        "is_high_priority",
        "is_high_value",
    ),
    measures=(
        Measure("gross_revenue_amount", "sum", "gross_revenue", WIDE_MONEY),
        Measure("net_revenue_amount", "sum", "net_revenue", WIDE_MONEY),
        Measure("discount_amount", "sum", "gross_revenue - net_revenue", WIDE_MONEY),
        Measure("order_count", "count_distinct", "order_key", dense=True),
        Measure("avg_order_value", "average", "gross_revenue", "double"),
        Measure("line_item_count", "sum", "line_item_count"),
        Measure("customer_count", "count_distinct", "customer_key", dense=True),
    ),
    metrics=(
        Metric("gross_revenue", "Gross Revenue", "Analytics", "gross_revenue_amount"),
        Metric("net_revenue", "Net Revenue", "Analytics", "net_revenue_amount"),
        Metric("total_discount", "Total Discount Given", "Analytics", "discount_amount"),
        Metric("order_count", "Order Count", "Analytics", "order_count"),
        Metric("avg_order_value", "Average Order Value", "Analytics", "avg_order_value"),
        Metric(
            "discount_rate",
            "Effective Discount Rate",
            "Finance",
            numerator="total_discount",
            denominator="gross_revenue",
        ),
        Metric("active_customers", "Active Customers", "Analytics", "customer_count"),
        Metric(
            "revenue_per_customer",
            "Revenue Per Customer",
            "Analytics",
            numerator="gross_revenue",
            denominator="active_customers",
        ),
    ),
)

# Time grains and the unit names of F.trunc.
GRAINS = {"day": None, "week": "week", "month": "MM", "quarter": "quarter", "year": "year"}
# Grains that rows of a grain can be added up to.
COARSER = {
    "day": ("day", "week", "month", "quarter", "year"),
    "week": ("week",),
    "month": ("month", "quarter", "year"),
    "quarter": ("quarter", "year"),
    "year": ("year",),
}

DISCOUNT_RATE_LIMIT = 0.10  # fixed value: share of gross revenue above which a segment is flagged


def at_grain(date: Column, grain: str) -> Column:
    unit = GRAINS[grain]
    return date if unit is None else F.trunc(date, unit)


def _aggregate(measure: Measure) -> Column:
    value = F.expr(measure.expr)
    if measure.agg == "sum":
        result = F.sum(value)
    elif measure.agg == "count_distinct":
        result = F.count_distinct(value)
    else:
        result = F.sum(value).cast("double") / F.nullif(F.count(value), F.lit(0))
    return result.cast(measure.type)


def _local_name(model: SemanticModel, name: str) -> str:
    """``order__customer_tier`` -> ``customer_tier``; other names unchanged."""
    entity, _, rest = name.partition("__")
    return rest if rest and entity in model.entities else name


def dimension(model: SemanticModel, name: str) -> Column:
    """The column behind a requested dimension, under the requested name."""
    local = _local_name(model, name)
    base, _, grain = local.partition("__")
    if base == "metric_time" and model.time_dimension:
        grain = grain or model.grain
        if grain not in COARSER[model.grain]:
            raise ValueError(f"{model.name} has no {name}: its rows are of one {model.grain}")
        return at_grain(F.col(model.time_dimension), grain).alias(name)
    if base in model.time_dimensions:
        return at_grain(F.col(base), grain or model.time_dimensions[base]).alias(name)
    if local in model.dimensions:
        return F.col(local).alias(name)
    if local in model.entities:
        return F.col(model.entities[local]).alias(name)
    raise ValueError(f"unknown dimension: {name}")


def _filtered(mart: DataFrame, model: SemanticModel, where: str | Column) -> DataFrame:
    """Rows of ``mart`` under a condition that may name dimensions, with a grain too."""
    if isinstance(where, Column):
        return mart.filter(where)
    entities = "|".join(map(re.escape, model.entities))
    named: dict[str, str] = {}

    def column(found: re.Match) -> str:
        name = found[0]
        if name.startswith("'"):  # a text, not a name
            return name
        local = _local_name(model, name)
        if "__" not in local and local != "metric_time":
            return local
        return named.setdefault(name, f"where_{len(named)}")

    text = re.sub(rf"'(?:[^'\\]|\\.|'')*'|\b(?:(?:{entities})__\w+|metric_time(?:__\w+)?)\b", column, where)
    wide = mart.withColumns({alias: dimension(model, name) for name, alias in named.items()})
    return wide.filter(F.expr(text)).drop(*named.values())


def _simple(metric: Metric, model: SemanticModel) -> list[Metric]:
    """The metrics without division behind a metric."""
    if metric.measure:
        return [metric]
    return [model.metric(metric.numerator), model.metric(metric.denominator)]


def _ratio(numerator: str, denominator: str, name: str) -> Column:
    bottom = F.nullif(F.col(denominator).cast("double"), F.lit(0.0))
    return (F.col(numerator).cast("double") / bottom).alias(name)


def side_by_side(parts: list[DataFrame], keys: list[str]) -> DataFrame:
    """Aggregates of the same keys joined into one: every group that any of them has, NULL keys
    included, with NULL where a part lacks the group. Each part holds a group once."""
    if not keys:  # one row each: put together without a join, as each column has one value at most
        stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
        return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])
    out = parts[0]
    for n, part in enumerate(parts[1:]):
        right = part.withColumnsRenamed({k: f"{k}__{n}" for k in keys})
        same = [F.col(k).eqNullSafe(F.col(f"{k}__{n}")) for k in keys]
        both = [F.coalesce(k, f"{k}__{n}").alias(k) for k in keys]
        rest = [c for c in (*out.columns, *part.columns) if c not in keys]
        out = out.join(right, same, "full").select(*both, *rest)
    return out


def _grouped(
    mart: DataFrame, model: SemanticModel, simple: dict[str, Metric], group_by: list[str] | tuple
) -> DataFrame:
    """The simple metrics per group. Several distinct counts over dense keys are counted by bitmaps (sparse
    ones where there are groups), each from its own two columns, as Spark would copy every row for each of
    them."""
    keys = [dimension(model, name) for name in group_by]
    measures = {name: model.measure(m.measure) for name, m in simple.items()}
    distinct = {name: m for name, m in measures.items() if m.agg == "count_distinct"}
    if len(distinct) < 2 or not all(m.dense for m in distinct.values()):
        return mart.groupBy(*keys).agg(*[_aggregate(m).alias(name) for name, m in measures.items()])
    plain = [_aggregate(m).alias(name) for name, m in measures.items() if name not in distinct]
    parts = [mart.groupBy(*keys).agg(*plain or [F.count(F.lit(1)).alias("all_rows")])]
    for name, measure in distinct.items():
        rows = mart.select(*keys, F.expr(measure.expr).cast("long").alias("key_number"))
        states = distinct_states(rows, list(group_by), "key_number", sparse=bool(group_by))
        parts.append(count_states(states, list(group_by), name))
    joined = side_by_side(parts, list(group_by))
    counts = {name: F.coalesce(name, F.lit(0).cast("long")) for name in distinct}  # a group without keys
    return joined.withColumns(counts)


def _ordered(out: DataFrame, order: list[str] | tuple, limit: int | None) -> DataFrame:
    if order:
        out = out.orderBy(*[F.desc(n[1:]) if n.startswith("-") else F.asc(n) for n in order])
    return out.limit(limit) if limit is not None else out


def query_metrics(
    mart: DataFrame,
    metrics: list[str],
    group_by: list[str] | tuple = (),
    where: str | Column | None = None,
    order: list[str] | tuple = (),
    limit: int | None = None,
    model: SemanticModel = ORDERS,
) -> DataFrame:
    """Metrics by dimensions. ``order`` takes result names, ``-name`` for descending."""
    wanted = [model.metric(m) for m in metrics]
    simple = {part.name: part for metric in wanted for part in _simple(metric, model)}
    if where is not None:
        mart = _filtered(mart, model, where)
    grouped = _grouped(mart, model, simple, group_by)

    def result(metric: Metric) -> Column:
        if metric.measure:
            return F.col(metric.name)
        return _ratio(metric.numerator, metric.denominator, metric.name)

    return _ordered(grouped.select(*map(F.col, group_by), *map(result, wanted)), order, limit)


def fill_gaps(result: DataFrame, spine: DataFrame, time_name: str, grain: str = "day") -> DataFrame:
    """A row for every period of the spine and of the result, which loses none of its rows.

    Periods without data carry NULL metrics.
    """
    periods = spine.select(at_grain(F.col("date_day"), grain).alias(time_name))
    if grain != "day":
        periods = periods.distinct()
    return periods.join(result, time_name, "full").select(*result.columns)


# The step from one period to the next.
STEPS = {"day": "1 day", "week": "7 days", "month": "1 month", "quarter": "3 months", "year": "1 year"}


def fill_gaps_by_group(result: DataFrame, time_name: str, groups: list[str], grain: str = "day") -> DataFrame:
    """A row for every period between a group's own first and last, which loses none of the rows.

    Only the bounds of each group are aggregated; its periods are made from them, so no table of periods
    is crossed with the groups. Periods without data carry NULL metrics; rows without time stay as they are.
    """
    dated = result.where(F.col(time_name).isNotNull()).groupBy(*groups)
    bounds = dated.agg(F.min(time_name).alias("first_period"), F.max(time_name).alias("last_period"))
    every = F.sequence("first_period", "last_period", F.expr(f"interval {STEPS[grain]}"))
    periods = bounds.select(*groups, F.explode(every).alias(time_name))
    return side_by_side([periods, result], [*groups, time_name]).select(*result.columns)


def flag_discount_rate(result: DataFrame, limit: float = DISCOUNT_RATE_LIMIT) -> DataFrame:
    """Marks the groups whose discount rate is above the governed limit."""
    over = F.col("discount_rate") > F.lit(limit)
    return result.withColumn("is_over_limit", F.coalesce(over, F.lit(False)))


def list_metrics(spark: SparkSession, model: SemanticModel = ORDERS) -> DataFrame:
    """The registry: one row per metric."""
    return spark.createDataFrame(
        [(m.name, m.label, m.kind, m.measure, m.numerator, m.denominator, m.owner)
         for m in model.metrics],
        "metric string, label string, type string, measure string, numerator string,"
        " denominator string, owner string",
    )


def reconcile_totals(sources: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """One row with each source's total of the same concept, and whether all of them agree.

    A source without any amount has no total and agrees with nothing.

    ``sources`` maps a label to a table and the column holding the amount there.
    """
    totals = None
    for label, (df, column) in sources.items():
        total = df.agg(F.sum(column).cast(WIDE_MONEY).alias("total"))
        total = total.select(F.lit(label).alias("source"), "total")
        totals = total if totals is None else totals.unionByName(total)
    side_by_side = totals.agg(
        *[F.max(F.when(F.col("source") == s, F.col("total"))).alias(s) for s in sources],
        (F.max("total") - F.min("total")).cast(WIDE_MONEY).alias("widest_gap"),
        F.count("total").alias("known"),
    )
    agree = (F.col("known") == len(sources)) & (F.col("widest_gap") == 0)
    return side_by_side.withColumn("all_agree", agree).drop("known")


def reconcile_by(
    left: DataFrame, right: DataFrame, keys: list[str], value: str, names: tuple[str, str]
) -> DataFrame:
    """The same metric from two aggregates side by side, keeping groups only one of them has."""
    a = left.select(*keys, F.col(value).alias(names[0]))
    b = right.select(*keys, F.col(value).alias(names[1]))
    zero = F.lit(0).cast(WIDE_MONEY)
    gap = F.coalesce(F.col(names[0]), zero) - F.coalesce(F.col(names[1]), zero)
    return a.join(b, keys, "full").withColumn("gap", gap.cast(WIDE_MONEY))

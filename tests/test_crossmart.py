"""Metrics over several marts: groups that only some marts have, grains, ratios and errors."""

import datetime as dt
from decimal import Decimal as D

import pytest

from martwright.operators.crossmart import CrossRatio, query_across
from martwright.operators.metrics import Measure, Metric, SemanticModel

JAN, FEB, APR = dt.date(2020, 1, 1), dt.date(2020, 2, 1), dt.date(2020, 4, 1)


@pytest.fixture(scope="module")
def marts(frame):
    orders = frame(
        [(1, 1, JAN, JAN, "A", "gold", True, D(10)), (2, 1, dt.date(2020, 1, 9), JAN, "A", "gold", False, D(30)),
         (3, 2, FEB, FEB, None, "gold", True, D(5)), (4, 2, None, None, "B", "bronze", True, D(7))],
        "order_key long, customer_key long, order_date date, order_month date, market_segment string,"
        " customer_tier string, is_high_priority boolean, gross_revenue decimal(18,2)",
    )
    usage = frame(
        [(1, "AIR", JAN, 4, D(2), D(8), 1), (2, "AIR", JAN, 6, D(3), D(2), 0), (1, "RAIL", APR, 0, D(0), D(0), 0),
         (1, "RAIL", None, 5, D(1), D(1), 5)],
        "feature_id int, feature_category string, usage_month date, total_events long, total_quantity decimal(38,2),"
        " total_usage_value decimal(38,2), churned_events long",
    )
    attribution = frame(
        [("A", "gold", "low", "low", 3, D(40), 1), ("A", "gold", "high", "low", 1, D(0), 1), (None, "gold", "low", "low", 2, D(5), 0),
         ("C", "silver", "low", "low", 9, D(0), 9)],
        "market_segment string, customer_tier string, frequency_segment string, monetary_segment string,"
        " customer_count long, segment_revenue decimal(38,2), never_ordered_count long",
    )
    return {"orders": orders, "usage": usage, "attribution": attribution}


def rows(df):
    return {tuple(r)[0]: tuple(r)[1:] for r in df.collect()}


def test_months_of_either_mart_and_a_ratio_across(marts):
    got = rows(query_across(
        marts, ["gross_revenue", "order_count", "active_customers", "usage_events", "churn_rate",
                CrossRatio("per_event", "gross_revenue", "usage_events")], ["metric_time__month"],
    ))
    assert got == {
        JAN: (D(40), 2, 1, 10, 0.1, 4.0),
        FEB: (D(5), 1, 1, None, None, None),
        APR: (None, None, None, 0, None, None),
        None: (D(7), 1, 1, 5, 1.0, 1.4),
    }


def test_null_segments_meet(marts):
    got = rows(query_across(
        marts, ["known_customers", "gross_revenue", CrossRatio("share", "orders.active_customers", "attribution.known_customers")],
        ["market_segment"],
    ))
    assert got == {"A": (4, D(40), 0.25), None: (2, D(5), 0.5), "B": (None, D(7), None), "C": (9, None, None)}


def test_whole_totals_conditions_order_and_limit(marts):
    total = query_across(marts, ["usage_events", "gross_revenue", "known_customers"], where_in={"orders": "order__is_high_priority"})
    assert [tuple(r) for r in total.collect()] == [(15, D(22), 15)]
    late = query_across(
        marts, ["gross_revenue", "usage_events"], ["metric_time__quarter"], where="metric_time__quarter < date '2020-03-01'"
    )
    assert rows(late) == {JAN: (D(45), 10)}
    top = query_across(marts, ["usage_events", "gross_revenue"], ["metric_time__month"], order=["-usage_events"], limit=1)
    assert rows(top) == {JAN: (10, D(40))}
    one = query_across({"usage": marts["usage"]}, ["usage_quantity"], ["feature_category"])
    assert rows(one) == {"AIR": (D(5),), "RAIL": (D(1),)}


def test_what_marts_do_not_share_is_an_error(marts):
    for names, keys, message in [
        (["gross_revenue", "usage_events"], ["metric_time__day"], "usage has no metric_time__day"),
        (["usage_events"], ["metric_time__week"], "no metric_time__week"),
        (["gross_revenue", "usage_events"], ["market_segment"], "unknown dimension"),
        (["gross_revenue", "known_customers"], ["metric_time__month"], "unknown dimension"),
        (["nonsense"], [], "unknown metric"),
        (["usage.gross_revenue"], [], "unknown metric"),
        (["booked_revenue"], [], "no mart given for revenue"),
    ]:
        with pytest.raises(ValueError, match=message):
            query_across(marts, names, keys)


def test_names_of_two_models_must_be_qualified(frame):
    models = tuple(
        SemanticModel(n, {}, "", {}, ("g",), (Measure("m", "sum", "v"),), (Metric("total", "Total", "x", "m"),)) for n in ("one", "two")
    )
    given = {"one": frame([("a", 1)], "g string, v int"), "two": frame([("a", 4), ("b", 5)], "g string, v int")}
    with pytest.raises(ValueError, match="ambiguous"):
        query_across(given, ["total"], models=models)
    got = query_across(given, [CrossRatio("r", "one.total", "two.total")], ["g"], models=models)
    assert rows(got) == {"a": (0.25,), "b": (None,)}


def test_only_aggregates_are_joined(marts):
    plan = query_across(marts, ["gross_revenue", "usage_events"], ["metric_time__month"])._jdf.queryExecution().executedPlan().toString()
    join = plan.index("Join")
    assert plan.index("HashAggregate") > join  # both sides are aggregated below the join
    assert "Cartesian" not in plan and "NestedLoop" not in plan

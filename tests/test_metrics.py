import datetime as dt
from decimal import Decimal as D

import pytest
from helpers import as_dicts
from pyspark.sql import functions as F

from martwright.operators.metrics import (
    ORDERS,
    fill_gaps,
    flag_discount_rate,
    list_metrics,
    query_metrics,
    reconcile_by,
    reconcile_totals,
)
from martwright.sources.spine import date_spine, time_spine, time_spine_from

MART = (
    "order_key long, customer_key long, order_date date, order_month date, order_status string,"
    " order_status_label string, order_priority string, is_high_priority boolean,"
    " market_segment string, customer_tier string, is_high_value boolean,"
    " gross_revenue decimal(18,2), net_revenue decimal(18,2), line_item_count long"
)


def sale(key, customer, date, segment, gross, net, urgent=False):
    return (key, customer, date, date.replace(day=1), "F", "fulfilled", "1-URGENT", urgent, segment,
            "gold", True, D(gross), D(net), 1)


@pytest.fixture
def mart(frame):
    return frame(
        [
            sale(1, 1, dt.date(2020, 1, 5), "A", "100.00", "80.00", True),
            sale(2, 1, dt.date(2020, 1, 9), "A", "300.00", "300.00"),
            sale(3, 2, dt.date(2020, 4, 1), "A", "20.00", "20.00"),
            sale(4, 3, dt.date(2020, 4, 2), "B", "0.00", "0.00"),
            sale(4, 3, dt.date(2020, 4, 2), "B", "0.00", "0.00"),
        ],
        MART,
    )


def test_every_metric_at_once(mart):
    names = [m.name for m in ORDERS.metrics]
    rows = as_dicts(query_metrics(mart, names, ["market_segment"]), "market_segment")
    assert rows[0] == {
        "market_segment": "A",
        "gross_revenue": D("420.00"),
        "net_revenue": D("400.00"),
        "total_discount": D("20.00"),
        "order_count": 3,
        "avg_order_value": 140.0,
        "discount_rate": 20 / 420,
        "active_customers": 2,
        "revenue_per_customer": 210.0,
    }
    assert rows[1]["order_count"] == 1
    assert rows[1]["discount_rate"] is None  # nothing to divide by
    assert rows[1]["revenue_per_customer"] == 0.0


def test_grains_and_names(mart):
    got = query_metrics(
        mart, ["order_count"], ["metric_time__quarter", "order__market_segment", "order"]
    )
    assert got.columns == ["metric_time__quarter", "order__market_segment", "order", "order_count"]
    assert got.count() == 4
    assert query_metrics(mart, ["order_count"], ["metric_time"]).count() == 4
    assert query_metrics(mart, ["order_count"], ["order_month"]).count() == 2
    assert query_metrics(mart, ["order_count"], ["order_date__year"]).count() == 1
    assert query_metrics(mart, ["order_count"], ["customer"]).count() == 3


def test_where_order_limit(mart):
    got = query_metrics(
        mart,
        ["gross_revenue"],
        ["metric_time__month"],
        where="order__market_segment = 'A' and metric_time < date '2021-01-01'",
        order=["-gross_revenue"],
        limit=1,
    )
    assert [tuple(r) for r in got.collect()] == [(dt.date(2020, 1, 1), D("400.00"))]
    urgent = query_metrics(mart, ["order_count"], where=F.col("is_high_priority"))
    assert urgent.first()[0] == 1


def test_unknown_names(mart):
    with pytest.raises(ValueError, match="unknown metric: sales"):
        query_metrics(mart, ["sales"])
    with pytest.raises(ValueError, match="unknown dimension: order__color"):
        query_metrics(mart, ["order_count"], ["order__color"])


def test_metric_query_reads_only_what_it_needs(mart, spark, tmp_path):
    mart.write.parquet(str(tmp_path / "mart"))
    stored = spark.read.parquet(str(tmp_path / "mart"))
    plan = query_metrics(stored, ["gross_revenue"], ["metric_time__month"],
                         where="order__is_high_priority")._jdf.queryExecution().executedPlan()
    text = plan.toString()
    assert "ReadSchema: struct<order_date:date,is_high_priority:boolean,gross_revenue" in text
    assert "customer_key" not in text and "EqualTo(is_high_priority,true)" in text


def test_gaps_are_filled(mart, spark):
    spine = date_spine(spark, dt.date(2020, 1, 1), dt.date(2020, 5, 1))
    monthly = query_metrics(mart, ["gross_revenue"], ["metric_time__month"])
    got = as_dicts(
        fill_gaps(monthly, spine, "metric_time__month", "month"), "metric_time__month"
    )
    assert [r["gross_revenue"] for r in got] == [D("400.00"), None, None, D("20.00")]
    daily = query_metrics(mart, ["order_count"], ["metric_time__day"])
    assert fill_gaps(daily, spine, "metric_time__day").count() == 121


def test_discount_flag(mart):
    rates = query_metrics(mart, ["discount_rate"], ["market_segment", "metric_time__day"])
    got = as_dicts(flag_discount_rate(rates), "metric_time__day")
    assert [r["is_over_limit"] for r in got] == [True, False, False, False]


def test_metric_list(spark):
    rows = as_dicts(list_metrics(spark), "metric")
    assert len(rows) == 8 and len(ORDERS.measures) == 7
    assert {r["metric"] for r in rows if r["type"] == "ratio"} == {
        "discount_rate", "revenue_per_customer",
    }
    assert {r["metric"] for r in rows if r["owner"] == "Finance"} == {"discount_rate"}


def test_reconciliation(frame):
    a = frame([(D("1.00"),), (D("2.00"),)], "x decimal(18,2)")
    b = frame([(D("3.00"),)], "y decimal(38,2)")
    row = as_dicts(reconcile_totals({"a": (a, "x"), "b": (b, "y")}))[0]
    assert row == {"a": D("3.00"), "b": D("3.00"), "widest_gap": D("0.00"), "all_agree": True}
    row = as_dicts(reconcile_totals({"a": (a, "x"), "b": (b.filter("y > 3"), "y"), "c": (b, "y")}))
    assert row[0]["b"] is None and row[0]["all_agree"] is False


def test_reconcile_by_keeps_both_sides(frame):
    a = frame([(1, D("5.00")), (2, D("1.00"))], "k int, v decimal(38,2)")
    b = frame([(1, D("4.00")), (3, D("2.00"))], "k int, v decimal(38,2)")
    got = as_dicts(reconcile_by(a, b, ["k"], "v", ("left", "right")), "k")
    assert [(r["k"], r["gap"]) for r in got] == [(1, D("1.00")), (2, D("1.00")), (3, D("-2.00"))]


def test_spine(spark, frame):
    as_of = dt.date(2026, 6, 10)
    spine = time_spine(spark, as_of)
    days = sorted(r[0] for r in spine.collect())
    assert len(days) == len(set(days)) == 1855
    assert (days[0], days[-1]) == (dt.date(2021, 6, 11), dt.date(2026, 7, 9))
    latest = frame([(as_of,)], "as_of date")
    assert sorted(r[0] for r in time_spine_from(latest).collect()) == days
    leap = [r[0] for r in time_spine(spark, dt.date(2024, 2, 29)).collect()]
    assert min(leap) == dt.date(2019, 3, 1)
    assert date_spine(spark, as_of, as_of).isEmpty()


def test_gap_filling_keeps_days_outside_the_spine(spark):
    spine = date_spine(spark, dt.date(2020, 1, 1), dt.date(2020, 1, 4))
    days = ["1999-12-31", "2020-01-02", "2031-05-05"]
    result = spark.createDataFrame([(d, 1) for d in days], "day string, n int")
    result = result.withColumn("metric_time__day", F.to_date("day")).drop("day")
    filled = fill_gaps(result, spine, "metric_time__day").collect()
    assert len(filled) == 5 and sum(r["n"] or 0 for r in filled) == 3


def test_where_takes_grains_and_leaves_texts_alone(spark):
    mart = spark.createDataFrame(
        [("2020-01-15", "metric_time"), ("2020-02-01", "order__x")], "d string, market_segment string"
    ).select(F.to_date("d").alias("order_date"), "market_segment", F.col("d").alias("order_key"))
    for where, n in (
        ("metric_time__month = date '2020-01-01'", 1),
        ("order__market_segment = 'metric_time'", 1),
        ("order__market_segment = 'order__x' and metric_time__year = date '2020-01-01'", 1),
        ("metric_time >= date '2020-01-15'", 2),
    ):
        got = query_metrics(mart, ["order_count"], where=where).first()
        assert got["order_count"] == n, where


def test_gaps_are_filled_within_each_group(frame):
    import datetime as dt

    from martwright.operators.metrics import fill_gaps_by_group

    day = lambda m, d=1: dt.date(2020, m, d)
    rows = [("a", day(1), 1), ("a", day(4), 2), (None, day(2), 3), (None, day(3), 4), ("b", None, 5), ("b", day(6), 6)]
    df = frame(rows, "g string, month date, n int")
    got = {(r["g"], r["month"]): r["n"] for r in fill_gaps_by_group(df, "month", ["g"], "month").collect()}
    assert got == {(g, m): n for g, m, n in rows} | {("a", day(2)): None, ("a", day(3)): None}
    plan = fill_gaps_by_group(df, "month", ["g"], "month")._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    assert fill_gaps_by_group(df.where("false"), "month", ["g"], "month").isEmpty()

"""Distinct counts by bitmaps: dense, sparse and text keys, merges, plans, and reach by bits."""

import datetime as dt
import random

import pytest
from helpers import TINY, as_dicts
from pyspark.sql import functions as F

from martwright.operators import catalog
from martwright.operators.distinct import count_states, distinct_states, merge_states, number_keys
from martwright.operators.metrics import query_metrics, side_by_side
from martwright.registry import CASES
from martwright.registry.base import Domain


def test_numbers_have_no_gaps_and_follow_the_keys(frame, spark):
    keys = [f"k{random.Random(i).randrange(400):03d}" for i in range(900)] + [None, ""]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        rows = number_keys(frame([(k, 1) for k in keys], "k string, other int"), "k").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert [r["k"] for r in sorted(rows, key=lambda r: r["number"])] == sorted({k for k in keys if k is not None})
    assert sorted(r["number"] for r in rows) == list(range(len(rows)))
    assert number_keys(frame([], "k string"), "k").isEmpty()


def test_states_merge_to_exact_counts(frame):
    rng = random.Random(1)
    rows = [
        (rng.choice(["a", "b", None]), rng.randrange(6), rng.choice([None, 0, 32767, 32768, 32769, -5, 10**9, rng.randrange(200_000)]))
        for _ in range(3000)
    ]
    states = distinct_states(frame(rows, "g string, day int, k long"), ["g", "day"], "k")
    by_day = {(r["g"], r["day"]): r["n"] for r in count_states(states, ["g", "day"], "n").collect()}
    want, whole, weeks = {}, {}, {}
    for g, day, k in rows:
        if k is not None:
            want.setdefault((g, day), set()).add(k)
            whole.setdefault(g, set()).add(k)
            weeks.setdefault(day // 3, set()).add(k)
    assert by_day == {key: len(v) for key, v in want.items()}
    merged = count_states(merge_states(states, ["g"]), ["g"], "n")
    assert {r["g"]: r["n"] for r in merged.collect()} == {g: len(v) for g, v in whole.items()}
    week = (F.floor(F.col("day") / 3)).alias("week")
    merged = count_states(merge_states(states, [week]), ["week"], "n")
    assert {r["week"]: r["n"] for r in merged.collect()} == {w: len(v) for w, v in weeks.items()}
    assert count_states(merge_states(states, []), [], "n").first()["n"] == len(set().union(*whole.values()))
    assert count_states(distinct_states(frame([], "k long"), [], "k"), [], "n").first()["n"] == 0


def test_sparse_states_are_as_many_as_their_keys_at_most(frame):
    rng = random.Random(3)
    rows = [(rng.choice(["a", None]), d, rng.choice([None, -1, -64, 63, 64, 2**62, rng.randrange(10**9)])) for d in range(40) for _ in range(30)]
    df = frame(rows, "g string, day int, k long")
    states = distinct_states(df, ["g", "day"], "k", sparse=True)
    assert states.schema["keys"].dataType.simpleString() == "bigint"
    assert states.count() <= len({r for r in rows if r[2] is not None})
    for groups in (["g", "day"], ["g"], []):
        got = count_states(merge_states(states, groups), groups, "n")
        plain = df.where("k is not null").groupBy(*groups).agg(F.count_distinct("k").alias("n"))
        assert sorted(map(str, got.collect())) == sorted(map(str, plain.collect()))
    assert count_states(distinct_states(df.where("false"), [], "k", sparse=True), [], "n").first()["n"] == 0


def test_keys_scattered_over_groups_make_no_bitmaps(spark):
    for name in ("metric_distinct_text_keys", "metric_distinct_rollup", "metric_by_quarter_and_priority"):
        plan = CASES[name].run(spark, TINY)._jdf.queryExecution().executedPlan().toString()
        assert "bit_or" in plan and "bitmap_" not in plan


ENRICHED = "order_key long, customer_key long, order_date date, order_month date, market_segment string, gross_revenue decimal(18,2)"


def test_several_distinct_counts_equal_the_plain_ones(frame):
    rng, day = random.Random(2), dt.date(2020, 1, 1)
    rows = []
    for _ in range(400):
        date = rng.choice([None, day + dt.timedelta(rng.randrange(90))])
        rows.append((rng.choice([None, rng.randrange(300)]), rng.choice([None, 7, rng.randrange(50)]), date,
                     date and date.replace(day=1), rng.choice(["A", "B", None]), None))
    rows.append((None, None, None, None, "nothing", None))
    mart = frame(rows, ENRICHED)
    names = ["order_count", "active_customers", "gross_revenue"]
    for keys in ([], ["market_segment"], ["metric_time__month", "order__market_segment"]):
        got = query_metrics(mart, names, keys)
        column = {"market_segment": "market_segment", "order__market_segment": "market_segment", "metric_time__month": "order_month"}
        plain = mart.groupBy(*[F.col(column[k]).alias(k) for k in keys]).agg(
            F.count_distinct("order_key").alias("order_count"), F.count_distinct("customer_key").alias("active_customers")
        )
        take = lambda df: sorted(map(str, df.select(*keys, *names[:2]).collect()))
        assert take(got) == take(plain)
    empty = query_metrics(mart.where("false"), names).first()
    assert (empty["order_count"], empty["active_customers"], empty["gross_revenue"]) == (0, 0, None)


def test_no_row_is_copied_for_distinct_counts(spark):
    for name in ("metric_all_total", "metric_by_quarter_and_priority", "metric_distinct_rollup"):
        plan = CASES[name].run(spark, TINY)._jdf.queryExecution().executedPlan().toString()
        assert "Expand" not in plan and "CartesianProduct" not in plan
    orders = Domain(spark, TINY).published().enriched()
    states = distinct_states(orders, ["order_date"], "customer_key")
    plan = states._jdf.queryExecution().executedPlan().toString()
    assert "partial_bitmap_construct_agg" in plan and plan.count("Exchange hashpartitioning") == 1


def test_sides_keep_all_groups_with_null_keys(frame):
    a = frame([(None, "x", 1), (1, "x", 2), (2, None, 3)], "k int, s string, a int")
    b = frame([(None, "x", 10), (2, None, 20), (None, None, 30)], "k int, s string, b int")
    c = frame([(None, None, 100)], "k int, s string, c int")
    got = {(r["k"], r["s"]): (r["a"], r["b"], r["c"]) for r in side_by_side([a, b, c], ["k", "s"]).collect()}
    assert got == {
        (None, "x"): (1, 10, None), (1, "x"): (2, None, None), (2, None): (3, 20, None), (None, None): (None, 30, 100)
    }


def test_reach_of_more_starts_than_a_word_holds(frame):
    """150 starts reach a common tail through a diamond, a chain and a cycle."""
    edges = [(f"s{i:03d}", f"s{i:03d}c{j}") for i in range(150) for j in range(3)]
    edges += [(f"s{i:03d}c{j}", "left" if j else "right") for i in range(150) for j in range(2)]
    edges += [("left", "tail"), ("right", "tail"), ("tail", "end"), ("end", "left")]
    df = frame([(p, c, "model") for p, c in edges], "parent_id string, child_id string, child_type string")
    rows = as_dicts(catalog.blast_radius(df), "model_id")
    assert len(rows) == 150 and {(r["direct_children"], r["transitive_count"]) for r in rows} == {(3, 7)}
    children = as_dicts(catalog.wide_children(df), "model_id", "child_id")
    assert len(children) == 450 and children[0] == {"model_id": "s000", "child_id": "s000c0"}


@pytest.mark.parametrize("threshold", [1, 2])
def test_a_level_holds_a_row_per_node_and_word(frame, spark, tmp_path, threshold):
    edges = [(f"s{i}", "hub") for i in range(128)] + [("hub", f"n{i}") for i in range(5)]
    links = frame(edges, "parent_id string, child_id string")
    starts = number_keys(links.where("parent_id <> 'hub'"), "parent_id")
    rows = catalog.reached(links, starts, f"file://{tmp_path}/{threshold}").collect()
    assert len(rows) == 6 * 2 and all(r["bits"] == -1 for r in rows)
    assert {r["transitive_count"] for r in catalog.reach_counts(spark.createDataFrame(rows)).collect()} == {6}

"""Hot keys: a third of all rows under one key, results against brute force, plans that spread it."""

import collections
import datetime as dt
import random
from decimal import ROUND_HALF_UP, Decimal as D

import pytest
from helpers import TINY, as_dicts
from pyspark.sql import functions as F

from martwright.operators import catalog
from martwright.operators.checks import Check, failing_rows, run_checks
from martwright.operators.profiling import profile
from martwright.plans import commercial, product
from martwright.registry import CASES
from martwright.registry.base import Domain
from test_models import LINES, ORDERS

HOT_ORDER, HOT_CUSTOMER = 1, 1


def money(x):
    return x.quantize(D("0.01"), ROUND_HALF_UP)


@pytest.fixture(scope="module")
def hot(frame):
    rng = random.Random(7)
    day = dt.date(2020, 1, 1)
    customers = {k: HOT_CUSTOMER if rng.random() < 0.35 else rng.randint(2, 40) for k in range(1, 301)}
    orders = [
        (k, c, rng.choice("FOP"), D(1), day + dt.timedelta(rng.randint(0, 400)),
         rng.choice(["1-URGENT", "3-MEDIUM"]), "c", 0, None)
        for k, c in customers.items()
    ]
    lines = []
    for _ in range(3000):
        key = HOT_ORDER if rng.random() < 0.34 else rng.randint(2, 290)
        ship = day + dt.timedelta(rng.randint(0, 400))
        lines.append(
            (key, rng.randint(1, 7), D(rng.randint(1, 50)), D(rng.randint(100, 99999)) / 100,
             D(rng.randint(0, 10)) / 100, D(rng.randint(0, 8)) / 100, rng.choice("ANR"), "O", ship,
             ship, ship + dt.timedelta(rng.randint(-1, 3)), rng.choice(["AIR", "RAIL"]))
        )
    return orders, lines, frame(orders, ORDERS), frame(lines, LINES)


def test_order_and_customer_totals(hot):
    orders, lines, orders_df, lines_df = hot
    gross, by_customer, of = collections.Counter(), collections.Counter(), {}
    for o in orders:
        of[o[0]] = o[1]
    used = collections.defaultdict(set)
    for key, _, _, price, discount, tax, *_ in lines:
        amount = money(price * (1 - discount) * (1 + tax))
        gross[key] += amount
        by_customer[of[key]] += amount
        used[of[key]].add(key)
    rollup = commercial.order_rollup(commercial.stg_commercial__orders(orders_df), lines_df)
    got = {r["order_key"]: r["gross_revenue"] for r in rollup.collect()}
    assert got == dict(gross)
    history = {r["customer_key"]: r for r in as_dicts(commercial.int_customer_orders(rollup))}
    assert {k: r["lifetime_gross_revenue"] for k, r in history.items()} == dict(by_customer)
    assert {k: r["total_orders"] for k, r in history.items()} == {k: len(v) for k, v in used.items()}


def test_usage(hot):
    _, lines, _, lines_df = hot
    want = collections.defaultdict(lambda: [0, set(), D(0)])
    for key, number, quantity, *rest in lines:
        group = want[(number, rest[8], rest[5].replace(day=1))]
        group[0] += 1
        group[1].add(key)
        group[2] += quantity
    got = as_dicts(product.fct_usage_v1(product.stg_product__usage(lines_df)))
    assert {
        (r["feature_id"], r["feature_category"], r["usage_month"]): (
            r["total_events"], r["unique_users"], r["total_quantity"],
        )
        for r in got
    } == {k: (n, len(u), q) for k, (n, u, q) in want.items()}


def test_checks(hot, frame):
    _, lines, _, lines_df = hot
    counts = collections.Counter(line[0] for line in lines)
    tables = {"lines": lines_df, "few": frame([(k,) for k in range(2, 200)], "k long")}
    checks = [
        Check("unique", "lines", "orderkey"),
        Check("relationships", "lines", "orderkey", parent="few", parent_column="k"),
    ]
    got = {r["check_name"].split("_")[0]: r["failures"] for r in run_checks(tables, checks).collect()}
    orphans = {k: n for k, n in counts.items() if not 2 <= k < 200}
    assert got == {
        "unique": sum(n > 1 for n in counts.values()), "relationships": sum(orphans.values()),
    }
    rows = failing_rows(lines_df, checks[1], tables["few"])
    assert {r[0]: r[1] for r in rows.collect()} == orphans
    row = profile(lines_df.select("orderkey"), "lines").first()
    assert row["distinct_count"] == len(counts)


def test_reach_through_a_hub(frame):
    """One node holds a third of all edges and is reached from many starts."""
    rng = random.Random(3)
    edges = [("hub", f"leaf{i}") for i in range(300)]
    for i in range(60):
        edges.append((f"n{i}", "hub"))
        edges += [(f"n{i}", f"n{rng.randint(0, 59)}") for _ in range(10)]
    links = set(edges)
    children = collections.defaultdict(set)
    for parent, child in links:
        children[parent].add(child)

    def reach(start):
        seen, queue = set(), list(children[start])
        while queue:
            node = queue.pop()
            if node not in seen:
                seen.add(node)
                queue += children[node]
        return len(seen)

    df = frame([(p, c, "model") for p, c in edges], "parent_id string, child_id string, child_type string")
    got = {r["model_id"]: r["transitive_count"] for r in catalog.blast_radius(df).collect()}
    assert got == {n: reach(n) for n in list(children) if len(children[n]) >= 3}


@pytest.fixture
def no_broadcast(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")
    before = [spark.conf.get(k) for k in keys]
    spark.conf.set(keys[0], "-1")
    spark.conf.set(keys[1], "false")
    yield
    for key, value in zip(keys, before):
        spark.conf.set(key, value)


def plan_of(spark, name):
    df = CASES[name].run(spark, TINY)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name, shuffles",
    [
        ("fct_orders_v1", 2),  # combined lines, order headers
        ("int_customer_orders", 3),  # and combined orders to the customer
        ("dim_customers_v1", 4),  # and the customers
        ("stg_finance_orders", 0),  # reads the stored order fact
        ("fct_revenue_v1", 2),  # distinct orders of a group first, then the group
        ("fct_attribution_v1", 1),  # reads the stored customer mart
        ("fct_usage_v1", 2),
        ("int_order_items", 2),
        ("stg_product_usage", 0),
    ],
)
def test_shuffles(spark, no_broadcast, name, shuffles):
    assert plan_of(spark, name).count("Exchange hashpartitioning") == shuffles


@pytest.mark.parametrize(
    "name, most",
    [
        ("stg_finance_orders", 0), ("stg_marketing_customers", 0), ("fct_revenue_v1", 0),
        ("fct_attribution_v1", 0), ("check_suite_consumers", 0), ("check_suite_platform", 4),
    ],
)
def test_scans_of_lines(spark, name, most):
    assert plan_of(spark, name).count("lineitem.parquet") <= most


def test_lines_are_combined_before_they_are_shuffled(spark, no_broadcast):
    lines = plan_of(spark, "fct_orders_v1").split("Exchange hashpartitioning(order_key")[1]
    assert "partial_sum" in lines.splitlines()[1]


def test_history_of_stored_orders_takes_one_shuffle(spark, no_broadcast, tmp_path):
    Domain(spark, TINY).rollup().write.parquet(str(tmp_path / "rollup"))
    stored = spark.read.parquet(str(tmp_path / "rollup"))
    history = commercial.int_customer_orders(stored)
    plan = history._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_scan_reads_only_used_columns(spark, no_broadcast):
    plan = plan_of(spark, "dim_customers_v1")
    for unused in ("l_quantity", "l_shipmode", "l_linenumber", "c_name", "o_totalprice"):
        assert unused not in plan
    assert "md5" not in plan
    assert "IsNotNull(l_shipdate)" in plan_of(spark, "fct_usage_v1")


def test_no_row_functions_outside_codegen(spark):
    plan = CASES["fct_orders_v1"].run(spark, TINY)._jdf.queryExecution().executedPlan().toString()
    assert "ObjectHashAggregate" not in plan and "SortAggregate" not in plan


def test_salt_free_joins_may_be_split_by_adaptive_execution(spark, tmp_path):
    """The line join's shuffled side can be cut: with low limits the plan reports a skewed join."""
    keys = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        orders = spark.range(1, 2001).selectExpr(
            "id as order_key", "id % 9 as customer_key", "date'2020-01-01' as order_date",
            "'F' as order_status", "'fulfilled' as order_status_label", "'x' as order_priority",
            "true as is_high_priority", "'c' as clerk_name",
        )
        lines = spark.range(0, 40000, 1, 8).selectExpr(
            "md5(cast(id as string)) as lineitem_key",
            "if(id % 3 = 0, 1L, 2 + id % 1900) as order_key",
            "cast(id % 7 as int) as line_number", "cast(1 as decimal(18,2)) as quantity",
            "cast(id as decimal(18,2)) as extended_price", "cast(0 as decimal(4,2)) as discount_rate",
            "cast(0 as decimal(4,2)) as tax_rate", "cast(id as decimal(18,2)) as net_price",
            "cast(id as decimal(18,2)) as gross_price", "'N' as return_flag", "'O' as line_status",
            "'AIR' as ship_mode", "date'2020-01-02' as ship_date", "date'2020-01-03' as commit_date",
            "date'2020-01-04' as receipt_date",
        )
        items = commercial.int_order_items(orders, lines)
        collected = items.collect()
        assert len(collected) == 40000
        assert "skew=true" in items._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)

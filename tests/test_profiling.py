import datetime as dt
from decimal import Decimal

import pytest
from helpers import TINY, as_dicts
from pyspark.sql import functions as F

from martwright.operators import profiling as pr
from martwright.sources.footers import footer_table


@pytest.fixture
def table(frame):
    rows = [
        (i, i % 10, i % 11, None, "free text", i % 2 == 0, dt.date(2020, 1, 1), 7)
        for i in range(110)
    ]
    return frame(
        rows,
        "itemkey long, ten int, eleven int, empty string, item_comment string, is_even boolean,"
        " day date, ownerkey int",
    )


def test_profile(table):
    got = {r["column_name"]: r for r in as_dicts(pr.profile(table, "items"))}
    assert {c: (r["distinct_count"], r["null_count"]) for c, r in got.items()} == {
        "itemkey": (110, 0), "ten": (10, 0), "eleven": (11, 0), "empty": (0, 110),
        "item_comment": (1, 0), "is_even": (2, 0), "day": (1, 0), "ownerkey": (1, 0),
    }
    assert {r["row_count"] for r in got.values()} == {110}
    assert got["empty"]["null_rate"] == 1.0 and got["ten"]["null_rate"] == 0.0
    assert [c for c, r in got.items() if r["is_unique"]] == ["itemkey"]
    assert [got[c]["ordinal"] for c in ("itemkey", "ownerkey")] == [1, 8]
    assert got["day"]["data_type"] == "date" and got["itemkey"]["data_type"] == "number"


def test_profile_of_empty_table(frame):
    row = as_dicts(pr.profile(frame([], "a int"), "t"))[0]
    assert (row["row_count"], row["null_count"], row["distinct_count"]) == (0, 0, 0)
    assert row["null_rate"] == 0.0 and row["is_unique"] is True


def test_null_beside_distinct_values_is_not_unique(frame):
    row = as_dicts(pr.profile(frame([(1,), (2,), (None,)], "a int"), "t"))[0]
    assert (row["null_count"], row["distinct_count"], row["is_unique"]) == (1, 2, False)


def test_values_of_every_type_are_told_apart(frame):
    nan = float("nan")
    rows = [
        (0.0, 1.5, Decimal("1.10"), Decimal(10) ** 30, [1, 2], b"\x00", "a", True, dt.datetime(2020, 1, 1), (1, "x")),
        (-0.0, nan, Decimal("1.1"), Decimal("1000000000000000000000000000001"), [1], b"", "", False, dt.datetime(2020, 1, 1, 1), (1, "y")),
        (nan, nan, None, None, None, None, "a ", None, None, None),
        (-1.0, None, Decimal("-1.1"), Decimal(10) ** 30, [2, 1], b"\x00\x00", None, True, None, (1, "x")),
    ]
    df = frame(
        rows,
        "`f loat` float, `d.ouble` double, small decimal(9,2), wide decimal(38,2), list array<int>, raw binary, `t``ext` string,"
        " flag boolean, at timestamp, pair struct<a int, b string>",
    )
    plain = {c: n for c, n in zip(df.columns, df.agg(*[F.count_distinct(F.col(f"`{c.replace('`', '``')}`")) for c in df.columns]).first())}
    for width in (1, 30, 10_000):  # a column a scan, a few, all
        got = {r["column_name"]: r for r in pr.profile_tables({"t": df}, width).collect()}
        assert {c: r["distinct_count"] for c, r in got.items()} == plain
        assert [got[c]["null_count"] for c in df.columns] == [0, 1, 1, 1, 1, 1, 1, 1, 2, 1]
        assert all(r["row_count"] == 4 for r in got.values())
    assert plain["f loat"] == 3 and plain["wide"] == 2


def test_a_table_is_read_once_and_shuffled_once(spark):
    lines = spark.read.parquet(f"{TINY}/lineitem.parquet")
    plan = pr.profile(lines, "lineitem")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") <= 2
    assert plan.count("Exchange hashpartitioning(i") == 2  # by column and code, then the closing one
    assert "partial_count" in plan and "Window" not in plan


def test_samples(table):
    profiled = pr.profile(table, "items")
    got = {r["column_name"]: r["sample_values"]
           for r in pr.sample_values(table, "items", profiled).collect()}
    assert set(got) == {"ten", "item_comment", "is_even", "day", "ownerkey"}
    assert got["ten"] == [str(i) for i in range(10)]  # in the order of the values, not of the text
    assert got["is_even"] == ["false", "true"]
    assert pr.sample_values(table, "other", profiled).isEmpty()


def test_suggestions(table, frame):
    owners = frame([(7,), (8,)], "ownerkey int")
    profiled = pr.profile(table, "items").unionByName(pr.profile(owners, "owners"))
    samples = pr.sample_values(table, "items", profiled)
    got = {(r["table_name"], r["column_name"], r["check_kind"], r["severity"], str(r["argument"]))
           for r in pr.suggest_checks(profiled, samples).collect()}
    ten = str([str(i) for i in range(10)])
    assert got == {
        ("items", "itemkey", "not_null", "error", "None"),
        ("items", "ten", "not_null", "error", "None"),
        ("items", "eleven", "not_null", "error", "None"),
        ("items", "is_even", "not_null", "error", "None"),
        ("items", "day", "not_null", "error", "None"),
        ("items", "ownerkey", "not_null", "error", "None"),
        ("owners", "ownerkey", "not_null", "error", "None"),
        ("owners", "ownerkey", "unique", "error", "None"),
        ("items", "itemkey", "relationships", "warn", "['items']"),
        ("items", "ownerkey", "relationships", "warn", "['owners']"),
        ("items", "ten", "accepted_values", "warn", ten),
        ("items", "is_even", "accepted_values", "warn", "['false', 'true']"),
    }
    index = {r["column_name"]: r["owner"] for r in pr.key_index(profiled).collect()}
    assert index == {"itemkey": "items", "ownerkey": "owners"}


def test_static_checks(spark, frame):
    tables = {
        "single": frame([], "S_KEY long, label string, amount double"),
        "double": frame([], "a_key long, b_key long, c string"),
        "late": frame([], "id long, x string, y string, z_key long"),
    }
    columns = pr.schema_columns(spark, tables)
    strict = columns.withColumn("nullable", F.col("column_name") != "amount")
    got = {(r["table_name"], r["column_name"], r["check_kind"])
           for r in pr.static_checks(strict).collect()}
    assert got == {
        ("single", "S_KEY", "not_null"), ("single", "S_KEY", "unique"),
        ("single", "amount", "not_null"), ("double", "a_key", "not_null"),
        ("double", "b_key", "not_null"), ("late", "z_key", "not_null"),
    }


@pytest.mark.parametrize(
    "name, want",
    [("customer_key", "number"), ("order_date", "date"), ("is_late", "boolean"),
     ("gross_price", "number"), ("comment", "varchar"), ("orderpriority", "number"),
     ("returnflag", "boolean"), ("update_id", "number"), ("acctbal", "varchar"),
     ("created_at", "date"), ("tax", "varchar")],
)
def test_guessed_types(frame, name, want):
    df = frame([(name,)], "n string")
    assert df.select(pr.inferred_type(F.col("n"))).first()[0] == want


def test_type_diff(spark, frame):
    columns = pr.schema_columns(spark, {"t": frame([], "order_date string, note string, qty int")})
    got = [(r["column_name"], r["guessed_type"]) for r in pr.type_inference_diff(columns).collect()]
    assert got == [("order_date", "date"), ("qty", "varchar")]


def test_row_counts(frame):
    got = pr.row_counts({"a": frame([(1,), (2,)], "x int"), "b": frame([], "x int")})
    assert {tuple(r) for r in got.collect()} == {("a", 2), ("b", 0)}


def test_counts_come_from_footers(spark, tmp_path):
    rows = [(i if i % 3 else None, None, dt.datetime(2020, 1, 1, i % 24), "x" * i if i % 2 else None, [i] if i % 5 else None, {"a": i}) for i in range(100)]
    path = str(tmp_path / "t")
    schema = "`a``b c` int, none date, at timestamp_ntz, text string, list array<int>, map map<string,int>"
    spark.createDataFrame(rows, schema).repartition(3).write.parquet(path)
    table = footer_table(spark, path)
    plan = pr.row_counts({"t": table})._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*)]" in plan
    assert as_dicts(pr.row_counts({"t": table})) == [{"table_name": "t", "row_count": 100}]
    counts = pr.null_counts({"t": table, "same": spark.read.parquet(path)})
    plan = pr.null_counts({"t": table})._jdf.queryExecution().executedPlan().toString()
    assert "COUNT(none)" in plan and "COUNT(text)" in plan and "Exchange hashpartitioning" not in plan
    want = {"a`b c": 34, "none": 100, "at": 0, "text": 50, "list": 20, "map": 0}
    for name in ("t", "same"):
        got = {r["column_name"]: (r["row_count"], r["null_count"]) for r in as_dicts(counts.where(f"table_name = '{name}'"))}
        assert got == {c: (100, n) for c, n in want.items()}
    empty = str(tmp_path / "empty")
    spark.createDataFrame([], "a int, b string").write.parquet(empty)
    assert [tuple(r) for r in pr.null_counts({"e": footer_table(spark, empty)}).collect()] == [("e", 0, "a", 0), ("e", 0, "b", 0)]
    assert as_dicts(pr.row_counts({"e": footer_table(spark, empty)})) == [{"table_name": "e", "row_count": 0}]
    mixed = spark.createDataFrame([(1, None), (None, "y"), (3, None)], "a int, b string").coalesce(1)
    mixed.write.mode("append").parquet(empty)  # a file without rows beside one with three
    assert [tuple(r) for r in pr.null_counts({"e": footer_table(spark, empty)}).collect()] == [("e", 3, "a", 1), ("e", 3, "b", 2)]

import datetime as dt
from decimal import Decimal as D

import pytest
from helpers import TINY, as_dicts
from pyspark.sql import functions as F

from martwright.operators.checks import (
    _entries,
    Check,
    contract_checks,
    failing_rows,
    run_checks,
    suite_failures,
    suite_status,
)
from martwright.operators.contracts import (
    CAST_TYPES,
    CONTRACT_TYPES,
    assert_no_pii,
    coerce_contract,
    contract_diff,
    contract_loss,
    exclude_pii,
    cast_type,
    normalise_type,
    spark_type,
)
from martwright.operators.freshness import freshness, freshness_observed
from martwright.plans.suites import SUITES, all_checks
from martwright.schemas import CONTRACTS, Contract, ContractColumn
from martwright.sources.sinks import as_view, store_failures, store_suite_failures, write_report, write_table
from martwright.sources.scans import read_contract


@pytest.fixture
def tables(frame):
    child = frame(
        [(1, 1, "a", 0.0), (1, 2, "b", 0.07), (None, 9, "z", 0.5), (None, None, None, None),
         (3, 9, "z", 0.5), (4, 8, "it's", 0.08)],
        "id int, parent_id int, code string, rate double",
    )
    parent = frame([(1,), (2,), (2,), (None,)], "id int")
    return {"child": child, "parent": parent}


CHECKS = [
    Check("not_null", "child", "id"),
    Check("unique", "child", "id", "warn"),
    Check("accepted_values", "child", "code", "warn", ("a", "b", "it's")),
    Check("accepted_values", "child", "rate", values=("0.00", "0.07", "0.08", "0.50")),
    Check("relationships", "child", "parent_id", parent="parent", parent_column="id"),
    Check("relationships", "parent", "id", parent="parent", parent_column="id"),
    Check("not_null", "child", "absent"),
    Check("unique", "parent", "id"),
]


def test_failures_and_statuses(tables):
    got = {r["check_name"]: (r["failures"], r["status"]) for r in run_checks(tables, CHECKS).collect()}
    assert got == {
        "not_null_child_id": (2, "fail"),
        "unique_child_id": (1, "warn"),
        "accepted_values_child_code": (1, "warn"),  # one distinct value, twice
        "accepted_values_child_rate": (0, "pass"),  # compared as numbers, not as text
        "relationships_child_parent_id": (3, "fail"),
        "relationships_parent_id": (0, "pass"),
        "not_null_child_absent": (None, "skipped_missing_column"),
        "unique_parent_id": (1, "fail"),
    }


def test_suite_status(tables):
    def status(checks):
        return as_dicts(suite_status(run_checks(tables, checks)))[0]

    whole = status(CHECKS)
    assert (whole["checks"], whole["passed"], whole["warned"], whole["failed"], whole["skipped"]) == (
        8, 2, 2, 3, 1,
    )
    assert whole["status"] == "fail"
    assert status(CHECKS[1:3])["status"] == "warn"
    assert status(CHECKS[3:4])["status"] == "pass"


def test_only_missing_columns(tables):
    assert [r["status"] for r in run_checks(tables, CHECKS[6:7]).collect()] == [
        "skipped_missing_column"
    ]


def test_empty_table_passes(frame):
    empty = {"t": frame([], "id int, code string")}
    checks = [Check("not_null", "t", "id"), Check("unique", "t", "id"),
              Check("accepted_values", "t", "code", values=("a",)),
              Check("relationships", "t", "id", parent="t", parent_column="id")]
    assert {r["failures"] for r in run_checks(empty, checks).collect()} == {0}


def test_failing_rows_are_stored(tables, spark, tmp_path):
    for check, want in zip(CHECKS[:5], (2, 1, 1, 0, 2)):
        rows = failing_rows(tables["child"], check, tables["parent"])
        store_failures(rows, str(tmp_path), check.name)
        assert spark.read.parquet(str(tmp_path / check.name)).count() == want
    orphans = failing_rows(tables["child"], CHECKS[4], tables["parent"])
    assert sorted(map(tuple, orphans.collect())) == [(8, 1), (9, 2)]


def test_declared_checks():
    checks = all_checks()
    kinds = [c.kind for c in checks]
    assert [kinds.count(k) for k in ("not_null", "unique", "accepted_values", "relationships")] == [
        121, 13, 21, 9,
    ]
    assert len(SUITES["platform"]) == 74
    assert len(checks) == 164
    for suite in SUITES.values():
        assert len({c.name for c in suite}) == len(suite)
    assert {c.severity for c in SUITES["enriched"] + SUITES["spine"]} == {"warn"}


# -- contracts --


def test_contracts_declare_the_published_columns():
    sizes = {name: len(c.columns) for name, c in CONTRACTS.items()}
    required = {name: len(c.required) for name, c in CONTRACTS.items()}
    assert sizes == {
        "fct_orders_v1": 17, "dim_customers_v1": 15, "fct_revenue_v1": 11,
        "fct_attribution_v1": 14, "fct_usage_v1": 9,
    }
    assert required == {
        "fct_orders_v1": 12, "dim_customers_v1": 13, "fct_revenue_v1": 5,
        "fct_attribution_v1": 4, "fct_usage_v1": 5,
    }


SMALL = Contract(
    "t",
    (
        ContractColumn("id", "number(38,0)", True),
        ContractColumn("rate", "number(18,2)"),
        ContractColumn("gone", "varchar"),
    ),
    primary_key="id",
    foreign_keys=(("id", "p", "id"),),
)


def test_contract_diff(frame):
    df = frame([(1, 0.125, True)], "id long, rate double, more boolean")
    got = {(r["column_name"], r["issue"], r["expected"], r["actual"])
           for r in contract_diff(df, SMALL).collect()}
    assert got == {
        ("rate", "type_mismatch", "decimal(18,2)", "double"),
        ("gone", "missing", "string", None),
        ("more", "extra", None, "boolean"),
    }
    same = frame([], "gone string, rate decimal(18,2), id long")
    assert contract_diff(same, SMALL).isEmpty()


def test_contract_loss_counts_changed_values(frame):
    df = frame([(1, 0.125), (2, 0.5), (3, None)], "id long, rate double")
    assert [tuple(r) for r in contract_loss(df, SMALL).collect()] == [("t", "rate", 1)]
    assert contract_loss(frame([], "id long"), SMALL).isEmpty()


def test_contract_checks_cover_constraints():
    kinds = [(c.kind, c.column) for c in contract_checks(SMALL)]
    assert kinds == [("not_null", "id"), ("unique", "id"), ("relationships", "id")]


def test_coercion_and_guard(frame, spark, tmp_path):
    good = frame([(None, "a", 0.125), (None, "b", 2.0)], "gone string, id string, rate double")
    plain = coerce_contract(good.withColumn("id", good.gone), SMALL)
    assert dict(plain.dtypes) == {"id": "bigint", "rate": "decimal(18,2)", "gone": "string"}
    df = frame([(1, 0.125, "x"), (None, 1.0, "y")], "id long, rate double, gone string")
    assert coerce_contract(df, SMALL).count() == 2
    with pytest.raises(Exception, match="NULL in t.id"):
        coerce_contract(df, SMALL, enforce=True).collect()
    with pytest.raises(Exception):
        write_table(df, "t", str(tmp_path), SMALL)
    with pytest.raises(ValueError, match="gone: missing"):
        write_table(df.drop("gone"), "t", str(tmp_path), SMALL)
    write_table(df.filter("id is not null"), "t_v1", str(tmp_path), SMALL)
    row = read_contract(spark, "t", 1, str(tmp_path)).first()
    assert (row["id"], str(row["rate"]), row["gone"]) == (1, "0.13", "x")


def test_catalog_tables_and_views(frame, spark):
    df = frame([(1, "a"), (2, "b")], "id int, v string")
    write_table(df, "stored_v2", bucket_by=(2, "id"))
    assert read_contract(spark, "stored", 2).count() == 2
    write_table(df.limit(1), "stored_v2")
    assert read_contract(spark, "stored", 2).count() == 1
    as_view(df, "lazy_model")
    assert spark.sql("select max(id) from lazy_model").first()[0] == 2
    with pytest.raises(ValueError, match="catalog name"):
        write_table(df, "x", "/nowhere", bucket_by=(2, "id"))
    spark.sql("drop table stored_v2")


def test_tables_are_sorted_within_files(spark, tmp_path):
    import pyarrow.parquet as pq

    df = spark.range(0, 1000, 1, 3).selectExpr("id", "(id * 7919) % 1000 as day")
    write_table(df, "sorted", str(tmp_path), sort_by="day")
    files = [p for p in (tmp_path / "sorted").iterdir() if p.suffix == ".parquet"]
    assert len(files) == 3
    for file in files:
        days = pq.read_table(file)["day"].to_pylist()
        assert days == sorted(days)
    assert spark.read.parquet(str(tmp_path / "sorted")).exceptAll(df).isEmpty()


def test_bucketed_tables_join_without_shuffle(spark):
    df = spark.range(100).selectExpr("id as k", "id * 2 as v")
    write_table(df, "bucketed_a", bucket_by=(4, "k"))
    write_table(df, "bucketed_b", bucket_by=(4, "k"))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table("bucketed_a").join(spark.table("bucketed_b"), "k")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 100
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        spark.sql("drop table bucketed_a")
        spark.sql("drop table bucketed_b")


def test_report_sink(frame, spark, tmp_path):
    rows = frame([("b", 2), ("a", 1)], "name string, score int").orderBy("name")
    write_report(rows, lambda stored: stored.groupBy().count(), str(tmp_path))
    assert [r["name"] for r in spark.read.json(str(tmp_path / "rows")).collect()] == ["a", "b"]
    assert spark.read.json(str(tmp_path / "summary")).first()["count"] == 2


@pytest.mark.parametrize(
    "raw, want",
    [("VARCHAR(255)", "varchar"), ("number(18,2)", "number"), ("", "varchar"), (None, "varchar"),
     ("Double", "float"), ("TIMESTAMP_NTZ(9)", "timestamp_ntz"), ("Geography", "geography"),
     ("number(18 , 2)", "number"), ("INT", "number"), ("double precision", "double precision")],
)
def test_type_names(raw, want):
    assert normalise_type(raw) == want


@pytest.mark.parametrize(
    "contract, want",
    [("number(38,0)", "bigint"), ("number", "bigint"), ("number(18,2)", "decimal(18,2)"),
     ("varchar", "string"), ("boolean", "boolean"), ("FLOAT8", "double"), ("smallint", "smallint"),
     ("timestamp_ntz", "timestamp_ntz"), ("timestamp_tz", "timestamp"), ("variant", "variant"),
     ("object", "map<string,variant>"), ("array", "array<variant>"), ("time", "string"),
     ("int", "int"), ("character", "string"), ("tinyint", "tinyint"), ("number(18 , 2)", "decimal(18,2)")],
)
def test_spark_types(contract, want):
    assert spark_type(contract).simpleString() == want


def test_every_type_name_has_a_spark_type():
    for name in {*CONTRACT_TYPES, *CONTRACT_TYPES.values(), *CAST_TYPES, *CAST_TYPES.values()}:
        spark_type(name)
    with pytest.raises(ValueError, match="unknown type"):
        spark_type("geography")
    assert [cast_type(t) for t in ("INT", "Character(3)", "bigint", "time", None)] == [
        "integer", "varchar", "bigint", "time", "varchar",
    ]


def test_pii_guard(frame):
    df = frame([("a", 1)], "customer_name string, id int")
    assert exclude_pii(df, ("customer_name",)).columns == ["id"]
    with pytest.raises(ValueError, match="customer_name"):
        assert_no_pii(df, ("customer_name",))


# -- freshness --

AS_OF = dt.datetime(2024, 3, 10, 12, 0)


@pytest.mark.parametrize(
    "hours, sla, want",
    [(0.5, "realtime", "pass"), (1, "realtime", "pass"), (2, "realtime", "warn"),
     (4, "realtime", "error"), (24, "daily", "pass"), (26, "daily", "warn"), (50, "daily", "error"),
     (5000, "static", "not_checked"), (26, "hourly", "warn"), (26, "DAILY", "warn")],
)
def test_freshness(frame, hours, sla, want):
    newest = AS_OF - dt.timedelta(hours=hours)
    df = frame([(newest,), (newest - dt.timedelta(days=9),), (None,)], "ts timestamp_ntz")
    row = as_dicts(freshness(df, "t", "ts", AS_OF, sla))[0]
    assert (row["age_seconds"], row["status"]) == (int(hours * 3600), want)
    assert row["sla"] in ("realtime", "daily", "static")


def test_freshness_from_observed_results(frame):
    rows = [("day", "2024-03-09"), ("at", "2024-03-10 11:00:00.5"), ("name", "zebra"), ("none", None)]
    results = frame(rows, "column_name string, greatest string")
    ages = {c: as_dicts(freshness_observed(results, "t", c, AS_OF))[0] for c in ("day", "at", "none", "absent")}
    assert {c: (r["age_seconds"], r["status"]) for c, r in ages.items()} == {
        "day": (36 * 3600, "warn"), "at": (3600, "pass"), "none": (None, "error"), "absent": (None, "error")}


def test_mart_freshness_reads_no_mart(spark):
    from martwright.registry import CASES

    df = CASES["freshness_marts"].run(spark, TINY)
    read = [f.split("/")[-2] for f in df.inputFiles()]
    assert read and all(name.endswith("__results") for name in read)


def test_freshness_of_nothing_is_an_error(frame):
    assert as_dicts(freshness(frame([], "ts date"), "t", "ts", AS_OF))[0]["status"] == "error"


@pytest.mark.parametrize(
    "days, limits, want",
    [(6, ((7, "day"), (30, "day")), "pass"), (8, ((7, "day"), (30, "day")), "warn"),
     (31, ((7, "day"), (30, "day")), "error"), (31, ((7, "day"), None), "warn"),
     (2, (None, (47, "hour")), "error"), (2, (None, (3, "day")), "pass"), (9, (None, None), "not_checked")],
)
def test_freshness_with_given_limits(frame, days, limits, want):
    df = frame([(AS_OF - dt.timedelta(days=days),)], "ts timestamp_ntz")
    row = as_dicts(freshness(df, "t", "ts", AS_OF, limits=limits))[0]
    assert (row["sla"], row["status"]) == ("declared", want)


def test_rows_that_pass_are_not_shuffled(spark, frame):
    df = frame([(1, "a"), (None, "z"), (None, "z"), (2, None)], "id int, code string")
    checks = [Check("not_null", "t", "id"), Check("not_null", "t", "code"),
              Check("accepted_values", "t", "code", values=("a",))]
    got = run_checks({"t": df}, checks)
    assert {r["check_name"]: r["failures"] for r in got.collect()} == {
        "not_null_t_id": 2, "not_null_t_code": 1, "accepted_values_t_code": 1,
    }
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate") == 1


def test_contract_coercion_rounds_and_counts_what_does_not_fit(spark):
    from decimal import Decimal

    from martwright.operators.contracts import coerce_contract, contract_loss
    from martwright.schemas import CONTRACTS

    contract = CONTRACTS["fct_usage_v1"]
    names = {c.name for c in contract.columns}
    assert {"total_quantity", "total_usage_value"} <= names
    row = spark.range(2).select(
        *[
            F.when(F.col("id") == 0, F.lit(Decimal("2.50"))).otherwise(F.lit(Decimal("3.00"))).cast("decimal(38,2)").alias(c.name)
            if c.name == "total_quantity"
            else F.when(F.col("id") == 0, F.lit("1" + "0" * 30)).otherwise(F.lit("1")).cast("decimal(38,2)").alias(c.name)
            if c.name == "total_usage_value"
            else F.lit(None).alias(c.name)
            for c in contract.columns
        ]
    )
    loss = {r["column_name"]: r["changed_rows"] for r in contract_loss(row, contract).collect()}
    assert loss["total_quantity"] == 1 and loss["total_usage_value"] == 1
    fits = row.where("total_usage_value < 10").union(row.where("total_quantity < 3").withColumn("total_usage_value", F.lit(Decimal(0)).cast("decimal(38,2)")))
    assert sorted(r["total_quantity"] for r in coerce_contract(fits, contract).collect()) == [3, 3]
    with pytest.raises(Exception, match="does not fit"):
        coerce_contract(row, contract).collect()


def test_sessions_without_ansi_are_refused(spark):
    from martwright.registry.base import Domain

    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(RuntimeError, match="ansi"):
            Domain(spark, "nowhere")
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_suite_failures_hold_what_the_suite_counts(frame, spark, tmp_path):
    child = frame(
        [(1, "a", 1.0, 1), (1, "b", 2.0, 2), (2, None, -0.0, 9), (None, None, 0.0, 9), (3, "z", None, None), (3, "z", None, None)],
        "k int, letter string, amount double, ref int",
    )
    parent = frame([(D("1.00"),), (D("2.50"),), (None,)], "id decimal(9,2)")
    checks = [
        Check("not_null", "child", "letter"),
        Check("unique", "child", "k"),
        Check("unique", "child", "amount"),
        Check("accepted_values", "child", "letter", values=("a", "b")),
        Check("relationships", "child", "ref", parent="parent", parent_column="id"),
        Check("relationships", "child", "k", parent="child", parent_column="k"),
        Check("not_null", "child", "nowhere"),
    ]
    tables = {"child": child, "parent": parent}
    found = suite_failures(tables, checks)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
    store_suite_failures(found, str(tmp_path / "failures"))
    rows = spark.read.parquet(str(tmp_path / "failures")).collect()
    got = {}
    for r in rows:
        got.setdefault(r["check_name"], {})[r["row"] or r["value"]] = r["n_records"]
    assert got == {
        "not_null_child_letter": {'{"k":2,"amount":-0.0,"ref":9}': 1, '{"amount":0.0,"ref":9}': 1},
        "unique_child_k": {"1": 2, "3": 2},
        "unique_child_amount": {"0.0": 2},
        "accepted_values_child_letter": {"z": 2},
        "relationships_child_ref": {"2.000000000000": 1, "9.000000000000": 2},
    }
    counted = {r["check_name"]: r["failures"] for r in run_checks(tables, checks).collect()}
    assert counted == {
        "not_null_child_letter": 2, "unique_child_k": 2, "unique_child_amount": 1, "accepted_values_child_letter": 1,
        "relationships_child_ref": 3, "relationships_child_k": 0, "not_null_child_nowhere": None,
    }


def test_a_suite_reads_each_table_once(spark):
    from martwright.plans.suites import checks_of
    from martwright.registry.base import Domain
    from martwright.registry.checks import run_suite

    plan = run_suite(Domain(spark, TINY), checks_of("commercial_staging"))._jdf.queryExecution().executedPlan().toString()
    tables = {c.table for c in checks_of("commercial_staging")} | {c.parent for c in checks_of("commercial_staging") if c.parent}
    assert plan.count("FileScan parquet") <= len(tables) and "Join" not in plan


@pytest.mark.parametrize("kind", ["int", "bigint"])
def test_whole_numbers_are_their_own_codes(frame, kind):
    """The entries that a suite shuffles hold neighbouring keys as they are, not as hashes."""
    df = frame([(5,), (5,), (-7,), (None,)], f"k {kind}")
    checks = {0: Check("unique", "t", "k"), 1: Check("relationships", "t", "k", parent="p", parent_column="k")}
    entries = _entries({"t": df, "p": frame([(5,)], "k bigint")}, checks, False)
    assert {(r["i"], r["x"], r["y"], r["n"]) for r in entries.collect()} == {
        (0, 5, 0, 2), (0, -7, 0, 1), (1, 5, 0, 2), (1, -7, 0, 1),
    }

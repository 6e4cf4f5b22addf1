"""Views, stored tables, failing rows and reports, each read back as written."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martwright.operators import catalog
from martwright.operators.checks import Check, failing_rows, suite_failures
from martwright.plans.suites import checks_of
from martwright.registry.base import CASES, Domain, case
from martwright.registry.checks import SKIPPED, TABLES
from martwright.registry.sqltext import sql
from martwright.schemas import CONTRACTS
from martwright.session import shared_folder
from martwright.sources.proxies import generated_catalog
from martwright.sources.scans import read_contract
from martwright.sources.sinks import as_view, store_failures, store_suite_failures, write_report, write_table


def _folder(d: Domain, kind: str) -> str:
    """A new folder per run below the shared one."""
    return f"{shared_folder(d.spark)}/{kind}-{uuid.uuid4().hex}"


@case("sink_view_customers", CASES["stg_commercial_customers"].sql)
def view(d):
    as_view(d.customers(), "stg_commercial__customers")
    return d.spark.table("stg_commercial__customers")


@case("sink_contract_table", CASES["contract_coerced_fct_orders"].sql)
def contract_table(d):
    """Written under its contract, read by a consumer at the pinned version."""
    folder = _folder(d, "tables")
    write_table(d.fct_orders(), "fct_orders_v1", folder, CONTRACTS["fct_orders_v1"])
    return read_contract(d.spark, "fct_orders", 1, folder)


@case("sink_failing_rows", CASES["check_failing_rows_unique"].sql)
def failures(d):
    folder, check = _folder(d, "failures"), Check("unique", "stg_commercial__lineitems", "lineitem_key")
    store_failures(failing_rows(d.lineitems(), check), folder, check.name)
    return d.spark.read.parquet(f"{folder}/{check.name}")


def _stored_failures_sql(checks: list[Check]) -> str:
    """Per check that fails: entries stored, rows behind them, and the failures the suite counts."""
    parts = []
    for check in checks:
        if check.column in SKIPPED.get(check.table, ()):
            continue
        table, c = TABLES[check.table][1], check.column
        if check.kind == "relationships":
            parent = f"select {check.parent_column} from {TABLES[check.parent][1]} where {check.parent_column} is not null"
            bad = f"select {c} as v, count(*) as n from {table} where {c} is not null and {c} not in ({parent}) group by 1"
        elif check.kind == "unique":
            bad = f"select {c} as v, count(*) as n from {table} where {c} is not null group by 1 having count(*) > 1"
        elif check.kind == "accepted_values":
            listed = ", ".join(f"'{v}'" for v in check.values)
            bad = f"select {c} as v, count(*) as n from {table} where {c} not in ({listed}) group by 1"
        else:
            bad = f"select t as v, count(*) as n from {table} as t where {c} is null group by t"
        parts.append(
            f"select '{check.name}' as check_name, count(*) as entries, cast(sum(n) as bigint) as n_records from ({bad})"
            " having count(*) > 0"
        )
    return sql("\n union all ".join(parts))


_SUITE = [c for c in checks_of("platform", "commercial_staging") if c.kind != "not_null"]


@case("sink_suite_failures", _stored_failures_sql(_SUITE))
def suite_rows(d):
    """What fails in the suites, stored in one write by check, and counted from there."""
    folder = _folder(d, "suite")
    names = {c.table for c in _SUITE} | {c.parent for c in _SUITE if c.parent}
    store_suite_failures(suite_failures({n: TABLES[n][0](d) for n in sorted(names)}, _SUITE), folder)
    stored = d.spark.read.parquet(folder)
    return stored.groupBy("check_name").agg(F.count(F.lit(1)).alias("entries"), F.sum("n_records").alias("n_records"))


@case("sink_scorecard_report", CASES["catalog_scorecard"].sql)
def report(d):
    folder = _folder(d, "report")
    scores = catalog.scorecard(**generated_catalog(d.spark, d.folder))
    write_report(catalog.ranked(scores), catalog.summary, folder)
    rows = d.spark.read.schema(scores.schema).json(f"{folder}/rows")
    return rows.withColumn("issues", F.concat_ws("; ", "issues"))


_MARTS = {"fct_orders": "fact", "dim_customers": "dim", "fct_revenue": "revenue", "fct_attribution": "attribution",
          "fct_usage": "usage_month"}
_RESULTS_SQL = "\n union all ".join(
    f"select '{mart}' as mart, '{c.name}' as column_name, count(*) as row_count,"
    f" count(*) - count({c.name}) as null_count, cast(min({c.name}) as varchar) as least,"
    f" cast(max({c.name}) as varchar) as greatest from {_MARTS[mart]}"
    for mart in _MARTS
    for c in CONTRACTS[f"{mart}_v1"].columns
)


@case("sink_mart_results", sql(_RESULTS_SQL))
def mart_results(d):
    """Rows, NULLs, least and greatest values of the stored marts, as observed while they were written."""
    marts = d.published()
    parts = []
    for mart in _MARTS:
        getattr(marts, mart)()
        parts.append(marts.store.results(mart, 1).drop("ordinal").select(F.lit(mart).alias("mart"), "*"))
    return reduce(DataFrame.unionByName, parts)

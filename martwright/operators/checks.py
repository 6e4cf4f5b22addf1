"""Data checks: not_null, unique, accepted_values, relationships, and a suite runner.

What counts as a failure: a NULL row, a value occurring more than once, a distinct value outside the
list, a row whose key has no parent.

A suite reads each table once for all checks that concern it, as child or as parent: a row becomes an
entry (check, value) for each check that has to look at it, and the entries of all tables meet in one
aggregate. Values are counted inside the tasks first, so a key holding a large share of the rows reaches
the shuffle as one combined entry per task. A child's value and its parent's are the same entry, so
relationships need no join.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martwright.functions import value_codes
from martwright.schemas import Contract


@dataclass(frozen=True)
class Check:
    kind: str
    table: str
    column: str
    severity: str = "error"
    values: tuple[str, ...] = ()
    parent: str | None = None
    parent_column: str | None = None

    @property
    def name(self) -> str:
        return f"{self.kind}_{self.table}_{self.column}"


def _text(value: str) -> str:
    """SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _outside(df: DataFrame, check: Check) -> str:
    """Non-NULL value outside the list, compared in the column's own type."""
    kind = df.schema[check.column].dataType.simpleString()
    accepted = ", ".join(f"try_cast({_text(v)} as {kind})" for v in check.values)
    # a listed value that is none of the column's type is NULL there and matches nothing
    listed = f"coalesce(`{check.column}` in ({accepted}), false)"
    return f"(`{check.column}` is not null and not {listed})"


def _repeated(df: DataFrame, column: str) -> DataFrame:
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(
        F.count(F.lit(1)).alias("n_records")
    )
    return counts.filter("n_records > 1")


def _orphan_keys(df: DataFrame, check: Check, parent: DataFrame) -> DataFrame:
    """Distinct child keys without a parent, with their row counts."""
    keys = df.filter(F.col(check.column).isNotNull()).groupBy(
        F.col(check.column).alias("child_key")
    )
    keys = keys.agg(F.count(F.lit(1)).alias("n_records"))
    owners = parent.select(F.col(check.parent_column).alias("parent_key"))
    return keys.join(owners, F.col("child_key") == F.col("parent_key"), "left_anti")


def failing_rows(df: DataFrame, check: Check, parent: DataFrame | None = None) -> DataFrame:
    """The rows, values or keys behind a check's failures, for storing."""
    if check.kind == "not_null":
        return df.filter(F.col(check.column).isNull())
    if check.kind == "unique":
        return _repeated(df, check.column)
    if check.kind == "accepted_values":
        bad = df.filter(F.expr(_outside(df, check)))
        return bad.groupBy(check.column).agg(F.count(F.lit(1)).alias("n_records"))
    if check.kind == "relationships":
        return _orphan_keys(df, check, parent).withColumnRenamed("child_key", check.column)
    raise ValueError(f"unknown check kind: {check.kind}")


def _key(column: str, kind: T.DataType, other: T.DataType | None = None) -> tuple[str, T.DataType]:
    """A key as a value that equals an equal key of the ``other`` type, and that value's type."""
    value, kinds = f"`{column}`", (kind, other or kind)
    floating = (T.FloatType, T.DoubleType)
    if kind != kinds[1] and all(isinstance(k, T.NumericType) for k in kinds):
        if all(isinstance(k, T.IntegralType) for k in kinds):
            kind, value = T.LongType(), f"cast({value} as bigint)"
        elif any(isinstance(k, floating) for k in kinds):
            kind, value = T.DoubleType(), f"cast({value} as double)"
        else:
            kind, value = T.DecimalType(38, 12), f"try_cast({value} as decimal(38,12))"
    return (f"({value} + 0)", kind) if isinstance(kind, floating) else (value, kind)  # one zero


def _codes(value: str, kind: T.DataType) -> tuple[str, str]:
    """SQL of two longs that tell the values of a type apart. A whole number is its own code: neighbours
    share most of their bytes, which the shuffle packs, where hashes share none."""
    if isinstance(kind, T.IntegralType):
        return f"cast({value} as bigint)", "0L"
    return value_codes(value, kind)


def _as_text(value: str, kind: T.DataType) -> str:
    """Text that tells the values of a type apart."""
    if isinstance(kind, T.TimestampType):
        return f"cast(unix_micros({value}) as string)"
    if isinstance(kind, T.BinaryType):
        return f"hex({value})"
    if isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        return f"to_json({value})"
    return f"cast({value} as string)"


def _entries(tables: dict[str, DataFrame], checks: dict[int, Check], whole: bool) -> DataFrame:
    """Per check i and value: ``n`` rows that have it, and whether a parent does (``owner``).

    With ``whole`` the value is text, and a failed not_null check's entry carries the row as JSON. Else
    it is two longs that tell values apart, as only their number is asked for.
    """
    found: dict[str, list[str]] = {}

    def add(table: str, i: int, condition: str, key: tuple[str, T.DataType] | None, child: int = 1, row: str = "null"):
        if whole:
            text = _as_text(*key) if key else "cast(null as string)"
            of = f"'value', {text}, 'row', cast({row} as string)"
        else:
            first, second = _codes(*key) if key else ("null", "0L")
            of = f"'x', cast({first} as bigint), 'y', {second}"
        found.setdefault(table, []).append(f"if({condition}, named_struct('i', {i}, 'n', {child}L, {of}), null)")

    for i, check in checks.items():
        df, column = tables[check.table], f"`{check.column}`"
        kind = df.schema[check.column].dataType
        if check.kind == "not_null":
            row = f"to_json(struct({', '.join(f'`{c}`' for c in df.columns)}))"
            add(check.table, i, f"{column} is null", None, row=row)
        elif check.kind == "accepted_values":
            add(check.table, i, _outside(df, check), _key(check.column, kind))
        elif check.kind == "unique":
            add(check.table, i, f"{column} is not null", _key(check.column, kind))
        elif check.kind == "relationships":
            owner, parent = tables[check.parent].schema[check.parent_column].dataType, f"`{check.parent_column}`"
            add(check.table, i, f"{column} is not null", _key(check.column, kind, owner))
            add(check.parent, i, f"{parent} is not null", _key(check.parent_column, owner, kind), 0)
        else:
            raise ValueError(f"unknown check kind: {check.kind}")
    parts = [
        tables[name].selectExpr(f"inline(array_compact(array({', '.join(entries)})))")
        for name, entries in found.items()
    ]
    spark = next(iter(tables.values())).sparkSession
    columns = ["value", "row"] if whole else ["x", "y"]
    none = spark.createDataFrame([], "i int, n long, " + ("value string, row string" if whole else "x long, y long"))
    return reduce(DataFrame.unionByName, parts or [none]).groupBy("i", *columns).agg(
        F.sum("n").alias("n"), F.max(F.col("n") == 0).alias("owner")
    )


def _failed(tables: dict[str, DataFrame], checks: dict[int, Check], whole: bool = False) -> DataFrame:
    """The entries that are failures, with the number of ``failures`` each counts for."""
    kinds = {k: [i for i, c in checks.items() if c.kind == k] for k in ("unique", "relationships", "not_null")}
    of = {k: F.col("i").isin(numbers) for k, numbers in kinds.items()}
    fails = F.when(of["unique"], F.col("n") > 1).when(of["relationships"], (F.col("n") > 0) & ~F.col("owner"))
    by_row = of["not_null"] | of["relationships"]
    entries = _entries(tables, checks, whole).where(fails.otherwise(True))
    return entries.withColumn("failures", F.when(by_row, F.col("n")).otherwise(F.lit(1).cast("long"))).drop("owner")


def _ready(tables: dict[str, DataFrame], checks: dict[int, Check]) -> dict[int, Check]:
    """The checks whose columns are there."""
    columns = {name: set(df.columns) for name, df in tables.items()}
    return {
        i: c
        for i, c in checks.items()
        if c.column in columns[c.table]
        and (c.kind != "relationships" or c.parent_column in columns[c.parent])
    }


def _declared(values: list[str]) -> str:
    return f"element_at(array({', '.join(values)}), i + 1)"


def suite_failures(tables: dict[str, DataFrame], checks: Iterable[Check]) -> DataFrame:
    """What failed in a suite: (check_name, table_name, column_name, severity, value, row, n_records).

    A not_null check gives the rows as JSON, equal ones once with their number; the others give the value
    outside the list, occurring more than once or without parent, and how many rows have it (timestamps
    as microseconds, binary as hex). One scan per table and one shuffle for all checks.
    """
    numbered = dict(enumerate(checks))
    every = list(numbered.values())
    names = {"check_name": "name", "table_name": "table", "column_name": "column", "severity": "severity"}
    labels = [f"{_declared([_text(getattr(c, a)) for c in every])} as {name}" for name, a in names.items()]
    return _failed(tables, _ready(tables, numbered), whole=True).selectExpr(*labels, "value", "row", "n as n_records")


def run_checks(tables: dict[str, DataFrame], checks: Iterable[Check]) -> DataFrame:
    """One result row per check. A check on a column its table lacks is reported as skipped.

    The failures of all checks end in one aggregate by check, which sees rows already combined.
    """
    numbered = dict(enumerate(checks))
    ready = _ready(tables, numbered)
    spark = next(iter(tables.values())).sparkSession
    seeds = spark.createDataFrame([(i, 0) for i in numbered], "i int, n long")
    counts = seeds.unionByName(_failed(tables, ready).selectExpr("i", "failures as n"))
    every = list(numbered.values())
    ready_at = _declared([str(i in ready).lower() for i in numbered])
    return (
        counts.groupBy("i")
        .agg(F.sum("n").alias("n"))
        .selectExpr(
            f"{_declared([_text(c.name) for c in every])} as check_name",
            f"{_declared([_text(c.table) for c in every])} as table_name",
            f"{_declared([_text(c.column) for c in every])} as column_name",
            f"{_declared([_text(c.severity) for c in every])} as severity",
            f"if({ready_at}, n, null) as failures",
        )
        .withColumn(
            "status",
            F.when(F.col("failures").isNull(), "skipped_missing_column")
            .when(F.col("failures") == 0, "pass")
            .when(F.col("severity") == "warn", "warn")
            .otherwise("fail"),
        )
    )


def suite_status(results: DataFrame) -> DataFrame:
    """One row: how many checks ended how, and the suite's own status."""
    n = {s: F.count_if(F.col("status") == s) for s in ("pass", "warn", "fail")}
    return results.agg(
        F.count(F.lit(1)).alias("checks"),
        n["pass"].alias("passed"),
        n["warn"].alias("warned"),
        n["fail"].alias("failed"),
        F.count_if(F.col("status") == "skipped_missing_column").alias("skipped"),
        F.when(n["fail"] > 0, "fail").when(n["warn"] > 0, "warn").otherwise("pass").alias("status"),
    )


def contract_checks(contract: Contract) -> list[Check]:
    """A contract's constraints: not-null columns, the primary key, foreign keys."""
    table = contract.table
    checks = [Check("not_null", table, column) for column in contract.required]
    if contract.primary_key:
        if contract.primary_key not in contract.required:
            checks.append(Check("not_null", table, contract.primary_key))
        checks.append(Check("unique", table, contract.primary_key))
    for column, parent, parent_column in contract.foreign_keys:
        checks.append(
            Check("relationships", table, column, parent=parent, parent_column=parent_column)
        )
    return checks

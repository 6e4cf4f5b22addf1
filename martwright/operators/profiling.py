"""Column profiles, and the checks and types they suggest.

Profiling is the distributed part. Columns are read in batches, a scan each; their values are told apart
by codes of fixed size and counted in one aggregate for all columns and tables. Profile a stored table: a
computed one would be recomputed for every batch. The rules then run on the profile, which has one row
per column.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martwright.functions import value_codes
from martwright.operators.checks import Check

MAX_CARDINALITY = 10  # most distinct values a column may have to be listed

# Parts of a name that mark free text.
FREE_TEXT_NAMES = ("comment", "note", "remark", "description")

# Type guessed from parts of a column name, first match wins.
TYPE_BY_NAME = [
    ("number", ("_key", "key", "_id", "id", "_count", "count", "_num", "number", "quantity",
                "priority")),
    ("date", ("_date", "date", "_at", "_time", "time")),
    ("boolean", ("is_", "has_", "_flag", "flag")),
    ("number", ("_amount", "amount", "_price", "price", "_cost", "cost", "_revenue", "revenue",
                "_value", "value", "_rate", "rate", "_balance", "balance")),
]
DEFAULT_TYPE = "varchar"


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def contract_type(kind: T.DataType) -> str:
    """Contract type name of a Spark type."""
    if isinstance(kind, T.StringType):
        return "varchar"
    if isinstance(kind, (T.IntegralType, T.DecimalType)):
        return "number"
    if isinstance(kind, T.FractionalType):
        return "float"
    names = {
        T.BooleanType: "boolean",
        T.DateType: "date",
        T.TimestampNTZType: "timestamp_ntz",
        T.TimestampType: "timestamp_ltz",
        T.ArrayType: "array",
        T.MapType: "object",
        T.StructType: "object",
        T.VariantType: "variant",
    }
    return names.get(type(kind), kind.simpleString())


# -- scans --


#: Bytes that a row may be widened to while its columns' values are told apart: columns of one scan.
BATCH_BYTES = 256


def _value_codes(name: str, kind: T.DataType) -> tuple[list[str], int]:
    """Two longs that tell the values of a column apart, the first NULL for NULL, and their bytes."""
    value = f"`{name.replace('`', '``')}`"
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        hashed = f"({value} + 0)"  # one zero
    else:
        hashed = value
    first, second = value_codes(hashed, kind)
    return [f"if({value} is null, null, {first})", second], 12 if second == "0L" else 20


def _batches(fields: list[T.StructField], most: int) -> list[list[tuple[int, list[str]]]]:
    """Columns by scan: as many as fit into ``most`` bytes, one at least."""
    out: list[list[tuple[int, list[str]]]] = []
    left = 0
    for i, field in enumerate(fields):
        codes, width = _value_codes(field.name, field.dataType)
        if width > left:
            out.append([])
            left = most
        out[-1].append((i, codes))
        left -= width
    return out


def profile_tables(tables: dict[str, DataFrame], batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """Per column of every table: rows, NULLs, share of NULLs, exact distinct values, uniqueness.

    A table is read once per batch of columns. There a row becomes a row (column, value code) per column,
    which is counted inside the task before the one shuffle by column and code, so frequent values
    collapse and a hot value is spread. A closing aggregate by column sees a partial row per task.
    """
    described, parts = [], []
    for table, df in tables.items():
        first = len(described)
        for ordinal, field in enumerate(df.schema, start=1):
            described.append((table, field.name, ordinal, contract_type(field.dataType)))
        for batch in _batches(df.schema.fields, batch_bytes):
            codes = df.selectExpr(*[f"{c} as {'xy'[k]}{i}" for i, two in batch for k, c in enumerate(two)])
            cells = ", ".join(f"(x{i}, y{i}) as `{first + i}`" for i, _ in batch)
            long = f"select cast(i as int) as i, x, y from {{codes}} unpivot include nulls ((x, y) for i in ({cells}))"
            parts.append(df.sparkSession.sql(long, codes=codes))
    spark = next(iter(tables.values())).sparkSession
    # a row without weight per column, so that columns of empty tables are reported too
    seeds = spark.range(len(described)).selectExpr("cast(id as int) as i", "0L as n_rows", "true as is_null")
    values = _union(parts).groupBy("i", "x", "y").agg(F.count(F.lit(1)).alias("n_rows"))
    values = values.selectExpr("i", "n_rows", "x is null as is_null")
    counts = seeds.unionByName(values).groupBy("i").agg(
        F.expr("sum(n_rows) as row_count"),
        F.expr("sum(if(is_null, n_rows, 0)) as null_count"),
        F.expr("count_if(not is_null) as distinct_count"),
    )

    def described_as(position: int) -> str:
        values = ", ".join(repr(row[position]) for row in described)
        return f"element_at(array({values}), i + 1)"

    return counts.selectExpr(
        f"{described_as(0)} as table_name",
        f"{described_as(1)} as column_name",
        f"{described_as(2)} as ordinal",
        f"{described_as(3)} as data_type",
        "row_count",
        "null_count",
        "distinct_count",
        "if(row_count > 0, cast(null_count as double) / row_count, 0.0D) as null_rate",
        "distinct_count = row_count and null_count = 0 as is_unique",
    )


def profile(df: DataFrame, table: str) -> DataFrame:
    return profile_tables({table: df})


def sample_tables(
    tables: dict[str, DataFrame], profiled: DataFrame, limit: int = MAX_CARDINALITY
) -> DataFrame:
    """Sorted distinct values, as text, of the columns that have between 1 and ``limit`` of them.

    Which columns qualify is read from the profile (one row per column); their values are then
    collected in one aggregate per table, whose size the limit bounds.
    """
    listed = profiled.filter(F.col("distinct_count").between(1, limit))
    names: dict[str, list[str]] = {}
    for row in listed.select("table_name", "column_name").collect():
        names.setdefault(row["table_name"], []).append(row["column_name"])
    parts = []
    for table, df in tables.items():
        columns = names.get(table)
        if not columns:
            continue
        lists = df.agg(
            *[
                F.expr(
                    f"transform(sort_array(collect_set(`{c}`)), v -> cast(v as string)) as `{c}`"
                )
                for c in columns
            ]
        )
        rows = lists.unpivot([], columns, "column_name", "sample_values")
        parts.append(rows.select(F.lit(table).alias("table_name"), "column_name", "sample_values"))
    if not parts:
        schema = "table_name string, column_name string, sample_values array<string>"
        return profiled.sparkSession.createDataFrame([], schema)
    return _union(parts)


def sample_values(
    df: DataFrame, table: str, profiled: DataFrame, limit: int = MAX_CARDINALITY
) -> DataFrame:
    return sample_tables({table: df}, profiled, limit)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    return _union(
        [
            df.agg(F.count(F.lit(1)).alias("row_count")).select(
                F.lit(name).alias("table_name"), "row_count"
            )
            for name, df in tables.items()
        ]
    )


def null_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows and NULLs of every column, a row per column; a table is one aggregate without shuffled rows.

    Tables read by ``sources.footers`` are counted from their files' footers. Those know no counts of nested
    columns, so these are an aggregate of their own: the only columns that are read. A table without columns
    gives no rows.
    """
    nested = (T.ArrayType, T.MapType, T.StructType, T.VariantType)
    parts = []
    for name, df in tables.items():
        flat = [f.name for f in df.schema if not isinstance(f.dataType, nested)]
        for columns in (flat, [c for c in df.columns if c not in flat]):
            if not columns:
                continue
            quoted = [f"`{c.replace('`', '``')}`" for c in columns]
            counts = [F.count(F.col(q)).alias(f"n_{i}") for i, q in enumerate(quoted)]
            one = df.agg(F.count(F.lit(1)).alias("row_count"), *counts)
            rows = [
                F.struct(F.lit(c).alias("column_name"), (F.col("row_count") - F.col(f"n_{i}")).alias("null_count"))
                for i, c in enumerate(columns)
            ]
            parts.append(one.select(F.lit(name).alias("table_name"), "row_count", F.inline(F.array(*rows))))
    return _union(parts)


# -- schema --


def schema_columns(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """One row per column of the tables' schemas."""
    return spark.createDataFrame(
        [
            (name, field.name, ordinal, contract_type(field.dataType), field.nullable)
            for name, df in tables.items()
            for ordinal, field in enumerate(df.schema, start=1)
        ],
        "table_name string, column_name string, ordinal int, data_type string, nullable boolean",
    )


def inferred_type(name: Column) -> Column:
    """Type guessed from a column name."""
    lowered, guess = F.lower(name), F.when(F.lit(False), DEFAULT_TYPE)
    for kind, parts in TYPE_BY_NAME:
        hits = reduce(lambda a, b: a | b, [F.contains(lowered, F.lit(p)) for p in parts])
        guess = guess.when(hits, kind)
    return guess.otherwise(DEFAULT_TYPE)


def type_inference_diff(columns: DataFrame) -> DataFrame:
    """Columns whose name suggests another type than they have."""
    guessed = columns.withColumn("guessed_type", inferred_type(F.col("column_name")))
    return guessed.filter(F.col("guessed_type") != F.col("data_type"))


# -- rules --


def _is_key(name: Column) -> Column:
    return F.lower(name).endswith("key")


def _is_free_text(name: Column) -> Column:
    return F.lower(name).rlike("|".join(FREE_TEXT_NAMES))


def static_checks(columns: DataFrame) -> DataFrame:
    """Checks that follow from the schema alone: table, column and check kind."""
    key = _is_key(F.col("column_name"))
    early = columns.filter(key & (F.col("ordinal") <= 3)).groupBy("table_name")
    marked = columns.join(early.agg(F.count(F.lit(1)).alias("keys")), "table_name", "left")
    sole = key & (F.col("ordinal") == 1) & (F.col("keys") == 1)
    required = key | (~F.col("nullable") & (F.col("data_type") != "varchar"))
    kinds = F.when(sole, F.array(F.lit("not_null"), F.lit("unique"))).when(
        required, F.array(F.lit("not_null"))
    )
    return marked.select("table_name", "column_name", F.explode(kinds).alias("check_kind"))


def key_index(profiled: DataFrame) -> DataFrame:
    """Per column name: the table in which it is the first proven-unique column."""
    first = (
        profiled.filter(F.col("is_unique") & (F.col("row_count") > 0))
        .groupBy("table_name")
        .agg(F.min_by("column_name", "ordinal").alias("column_name"))
    )
    return first.groupBy("column_name").agg(F.min("table_name").alias("owner"))


def suggest_checks(
    profiled: DataFrame, samples: DataFrame, limit: int = MAX_CARDINALITY
) -> DataFrame:
    """Suggested checks from the profiles of one or more tables.

    ``argument`` is the list of values for accepted_values and the owning table for relationships.
    """
    name = F.col("column_name")
    keys = profiled.filter(_is_key(name)).groupBy("table_name").agg(
        F.count(F.lit(1)).alias("keys")
    )
    facts = (
        profiled.join(keys, "table_name", "left")
        .join(key_index(profiled), "column_name", "left")
        .join(samples, ["table_name", "column_name"], "left")
        .withColumn("is_key", _is_key(name))
        .withColumn("is_free_text", _is_free_text(name))
    )
    sole = F.col("is_unique") & F.col("is_key") & (F.col("ordinal") == 1) & (F.col("keys") == 1)
    listed = (
        F.col("sample_values").isNotNull()
        & ~F.col("is_key")
        & ~F.col("is_free_text")
        & F.col("distinct_count").between(2, limit)
    )
    none = F.lit(None).cast("array<string>")

    def suggestion(kind: str, severity: str, argument: Column) -> Column:
        return F.struct(
            F.lit(kind).alias("check_kind"),
            F.lit(severity).alias("severity"),
            argument.alias("argument"),
        )

    found = F.array_compact(
        F.array(
            F.when(
                (F.col("null_count") == 0) & ~F.col("is_free_text"),
                suggestion("not_null", "error", none),
            ),
            F.when(sole, suggestion("unique", "error", none)),
            F.when(
                F.col("is_key") & ~sole & F.col("owner").isNotNull(),
                suggestion("relationships", "warn", F.array("owner")),
            ),
            F.when(listed, suggestion("accepted_values", "warn", F.col("sample_values"))),
        )
    )
    return facts.select("table_name", "column_name", F.explode(found).alias("s")).select(
        "table_name", "column_name", "s.check_kind", "s.severity", "s.argument"
    )


def to_checks(suggested: DataFrame) -> list[Check]:
    """Suggestions (a few rows per column) as checks the suite runner takes."""
    checks = []
    for row in suggested.orderBy("table_name", "column_name", "check_kind").collect():
        table, column, kind = row["table_name"], row["column_name"], row["check_kind"]
        severity = row["severity"] if "severity" in row else "error"
        argument = (row["argument"] if "argument" in row else None) or []
        if kind == "accepted_values":
            checks.append(Check(kind, table, column, severity, tuple(argument)))
        elif kind == "relationships":
            checks.append(
                Check(kind, table, column, severity, parent=argument[0], parent_column=column)
            )
        else:
            checks.append(Check(kind, table, column, severity))
    return checks

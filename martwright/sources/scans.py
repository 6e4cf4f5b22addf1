"""Scans of raw tables and of other domains' published tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from martwright.schemas import RAW, Schema


def conform(df: DataFrame, schema: Schema) -> DataFrame:
    """Declared columns in declared order and type; a missing column is an error.

    Amounts stored as doubles become their declared decimals here, so every model rounds alike.
    """
    missing = sorted(set(schema) - set(df.columns))
    if missing:
        raise ValueError(f"source lacks declared columns: {', '.join(missing)}")
    return df.selectExpr(*[f"cast(`{c}` as {kind}) as `{c}`" for c, kind in schema.items()])


def read_source(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Typed scan of one raw table; unused columns are pruned from the parquet read."""
    return conform(spark.read.parquet(f"{folder}/{name}.parquet"), RAW[name])


def read_contract(
    spark: SparkSession,
    name: str,
    version: int | None = None,
    folder: str | None = None,
    snapshot: str | None = None,
) -> DataFrame:
    """Another domain's published table at a pinned version: by catalog name (``contracts.orders_v1`` is the
    newest build), at a pinned snapshot of its sources too, or below a folder."""
    table = name if version is None else f"{name}_v{version}"
    if snapshot is not None:
        table = f"{table}__{snapshot}"
    if folder is None:
        return spark.table(table)
    return spark.read.parquet(f"{folder}/{table}")

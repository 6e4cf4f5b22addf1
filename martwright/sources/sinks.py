"""Views, stored tables, failing rows and reports."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from martwright.operators.contracts import coerce_contract, contract_diff
from martwright.schemas import Contract


def as_view(df: DataFrame, name: str) -> DataFrame:
    """Register a model as a lazy view; nothing runs until the view is read."""
    df.createOrReplaceTempView(name)
    return df


def write_table(
    df: DataFrame,
    name: str,
    folder: str | None = None,
    contract: Contract | None = None,
    bucket_by: tuple[int, str] | None = None,
    sort_by: str | None = None,
) -> None:
    """Store a model as a table, replacing what was there.

    With a contract, the column set must match before anything is written, and a NULL in a
    not-null column fails the write itself: no extra pass over the data. ``bucket_by`` stores a
    catalog table by key, so that later joins and aggregates on that key need no shuffle. ``sort_by``
    orders the rows within each task, without a shuffle: row groups then cover narrow ranges of that
    column, and filters on it skip most of them.
    """
    if contract is not None:
        wrong = [
            f"{r['column_name']}: {r['issue']}"
            for r in contract_diff(df, contract).collect()  # one row per declared column
            if r["issue"] != "type_mismatch"
        ]
        if wrong:
            raise ValueError(f"contract of {contract.table} broken: {'; '.join(wrong)}")
        df = coerce_contract(df, contract, enforce=True)
    if sort_by is not None:
        df = df.sortWithinPartitions(sort_by)
    writer = df.write.mode("overwrite")
    if folder is not None:
        if bucket_by:
            raise ValueError("bucketed tables need a catalog name, not a folder")
        writer.parquet(f"{folder}/{name}")
        return
    if bucket_by:
        buckets, key = bucket_by
        writer = writer.bucketBy(buckets, key).sortBy(key)
    writer.saveAsTable(name)


def store_failures(failing_rows: DataFrame, folder: str, check: str) -> None:
    """Keep the rows behind a failed check."""
    failing_rows.write.mode("overwrite").parquet(f"{folder}/{check}")


def store_suite_failures(failures: DataFrame, folder: str) -> None:
    """Keep what failed in a whole suite, in one write, with a folder per check."""
    failures.write.mode("overwrite").partitionBy("check_name").parquet(folder)


def write_report(
    rows: DataFrame, summarise: Callable[[DataFrame], DataFrame], folder: str
) -> None:
    """Report rows as JSON lines in the order of the frame, and the summary made from the stored
    rows, so that the report is computed once."""
    rows.write.mode("overwrite").json(f"{folder}/rows")
    stored = rows.sparkSession.read.schema(rows.schema).json(f"{folder}/rows")
    summarise(stored).write.mode("overwrite").json(f"{folder}/summary")

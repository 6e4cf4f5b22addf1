"""Tables read so that counts come from the footers of their Parquet files, not from their rows.

Spark answers count(*) and count(column) of an unfiltered Parquet table from the footers, if the table is
read by its newer reader and the push-down is on. Both are settings of a session, so such tables are read in
a session beside the caller's; frames of the two can be joined. Counting 100 TB then reads a footer per
file. Least and greatest values are left to scans and to what is observed while marts are written: Spark
raises on a row group without a value, and footers do not order timestamps or whole texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

FOOTER_SETTINGS = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}
#: What the session beside takes from the caller's.
KEPT_SETTINGS = ("spark.sql.session.timeZone", "spark.sql.shuffle.partitions", "spark.sql.ansi.enabled")


def footer_table(spark: SparkSession, path: str) -> DataFrame:
    """The Parquet table at ``path``, with counts pushed down to its files' footers.

    Files without rows add nothing. A table without any row is read the usual way, as Spark answers a
    pushed count with NULL where there is no row group at all.
    """
    beside = spark.newSession()
    for key in KEPT_SETTINGS:
        beside.conf.set(key, spark.conf.get(key))
    for key, value in FOOTER_SETTINGS.items():
        beside.conf.set(key, value)
    table = beside.read.parquet(path)
    return spark.read.parquet(path) if table.isEmpty() else table

"""Freshness: age of the newest row against the limits of the table's service level, or its own."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Limit = tuple[int, str] | None  # a count of hours or days, or no limit

PERIOD_SECONDS = {"hour": 3600, "day": 86400}

# Age for a warning and for an error; static tables are not checked.
SLA_LIMITS: dict[str, tuple[Limit, Limit]] = {
    "realtime": ((1, "hour"), (3, "hour")),
    "daily": ((25, "hour"), (49, "hour")),
    "static": (None, None),
}
# Declared service levels of the raw sources, and the limits a new source starts with.
SOURCE_SLA = {
    "customer": "daily",
    "lineitem": "daily",
    "nation": "daily",
    "orders": "daily",
    "part": "daily",
    "partsupp": "daily",
    "region": "daily",
    "supplier": "daily",
}
NEW_SOURCE_LIMITS: tuple[Limit, Limit] = ((7, "day"), (30, "day"))
DEFAULT_SLA = "daily"  # also stands in for an unknown service level


def _seconds(moment: Column) -> Column:
    """Seconds since 1970 by the clock on the wall, whatever the session's time zone."""
    clock = F.hour(moment) * 3600 + F.minute(moment) * 60 + F.second(moment)
    days = F.date_diff(moment.cast("date"), F.lit(dt.date(1970, 1, 1))).cast("long")
    return days * 86400 + clock


def _limit_seconds(limit: Limit) -> int | None:
    return None if limit is None else limit[0] * PERIOD_SECONDS[limit[1]]


def freshness(
    df: DataFrame,
    table: str,
    loaded_at: str,
    as_of: dt.datetime,
    sla: str = DEFAULT_SLA,
    limits: tuple[Limit, Limit] | None = None,
) -> DataFrame:
    """One row: newest ``loaded_at``, its age and pass, warn, error or not_checked.

    ``limits`` (warn_after, error_after) take the place of the service level's; sla is then "declared".
    """
    known = sla.lower() if sla.lower() in SLA_LIMITS else DEFAULT_SLA
    warn_after, error_after = map(_limit_seconds, SLA_LIMITS[known] if limits is None else limits)
    newest = df.agg(F.max(F.col(loaded_at).cast("timestamp_ntz")).alias("max_loaded_at"))
    now = F.lit(as_of.isoformat(sep=" ")).cast("timestamp_ntz")
    age = F.col("age_seconds")
    if warn_after is None and error_after is None:
        status = F.lit("not_checked")
    else:
        older = {k: age > v for k, v in (("error", error_after), ("warn", warn_after)) if v is not None}
        status = F.when(age.isNull(), "error")
        for name, is_older in older.items():
            status = status.when(is_older, name)
        status = status.otherwise("pass")
    return newest.withColumn(
        "age_seconds", _seconds(now) - _seconds(F.col("max_loaded_at"))
    ).select(
        F.lit(table).alias("table_name"),
        F.lit(known if limits is None else "declared").alias("sla"),
        "max_loaded_at",
        "age_seconds",
        status.alias("status"),
    )


def freshness_observed(
    results: DataFrame,
    table: str,
    loaded_at: str,
    as_of: dt.datetime,
    sla: str = DEFAULT_SLA,
    limits: tuple[Limit, Limit] | None = None,
) -> DataFrame:
    """``freshness`` of a stored mart from what was observed while it was written (``MartStore.results``).

    No row of the mart is read. A column that was not observed, or holds no value, has no age: an error.
    """
    newest = results.where(F.col("column_name") == loaded_at).select(
        F.col("greatest").cast("timestamp_ntz").alias(loaded_at)
    )
    return freshness(newest, table, loaded_at, as_of, sla, limits)

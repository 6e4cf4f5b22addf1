"""Daily date spine."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martwright.functions import day_offset

# The base range [start, end) and the window around the as-of date.
SPINE_START = dt.date(2000, 1, 1)
SPINE_END = dt.date(2030, 1, 1)
YEARS_BACK = 5
DAYS_AHEAD = 30


def days_from(bounds: DataFrame, first: str, last: str) -> DataFrame:
    """One row per day from ``first`` to ``last`` of a one-row frame; none where either is NULL."""
    known = bounds.where(F.col(first) <= F.col(last))
    days = F.sequence(F.col(first).cast("date"), F.col(last).cast("date"))
    return known.select("*", F.explode(days).alias("date_day"))


def date_spine(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """One row per day of the half-open range [start, end)."""
    bounds = spark.range(1).select(
        F.lit(start).alias("first"), F.lit(end - dt.timedelta(days=1)).alias("last")
    )
    return days_from(bounds, "first", "last").select("date_day")


def window_around(day: Column, as_of: Column) -> Column:
    """Days strictly between five years before and thirty days after the as-of date."""
    return (day > day_offset(as_of, years=-YEARS_BACK)) & (
        day < day_offset(as_of, days=DAYS_AHEAD)
    )


def time_spine(
    spark: SparkSession, as_of: dt.date, start: dt.date = SPINE_START, end: dt.date = SPINE_END
) -> DataFrame:
    return time_spine_from(spark.range(1).select(F.lit(as_of).alias("as_of")), "as_of", start, end)


def time_spine_from(
    latest: DataFrame, as_of: str = "as_of", start: dt.date = SPINE_START, end: dt.date = SPINE_END
) -> DataFrame:
    """The days of [start, end) around an as-of date that is the one row of an aggregate."""
    bounds = latest.select(
        as_of, F.lit(start).alias("first"), F.lit(end - dt.timedelta(days=1)).alias("last")
    )
    days = days_from(bounds, "first", "last")
    return days.filter(window_around(F.col("date_day"), F.col(as_of))).select("date_day")

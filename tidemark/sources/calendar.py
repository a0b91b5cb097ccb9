"""Date ranges, the calendar dimension and its CSV form."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.calendar import BRAZIL_HOLIDAYS, calendar_columns
from tidemark.schemas import CALENDAR_SCHEMA

# First and last day of the calendar dimension.
CALENDAR_START = dt.date(2019, 1, 1)
CALENDAR_END = dt.date(2030, 12, 31)


def days_between(bounds: DataFrame, first: str, last: str) -> DataFrame:
    """One row per day (column ``day``) of each range given, both ends in."""
    step = F.make_dt_interval(F.lit(1))
    return bounds.select(F.explode(F.sequence(F.col(first), F.col(last), step)).alias("day"))


def calendar_of(days: DataFrame, holidays: Sequence[str] = BRAZIL_HOLIDAYS) -> DataFrame:
    """The calendar dimension for a column ``day``."""
    return days.select(*calendar_columns(F.col("day"), holidays))


def dim_calendar(
    spark: SparkSession,
    start: dt.date = CALENDAR_START,
    end: dt.date = CALENDAR_END,
    holidays: Sequence[str] = BRAZIL_HOLIDAYS,
) -> DataFrame:
    bounds = spark.range(1).select(F.lit(start).alias("first"), F.lit(end).alias("last"))
    return calendar_of(days_between(bounds, "first", "last"), holidays)


def date_spine(bounds: DataFrame, first: str, end: str, unit: str = "day") -> DataFrame:
    """Start of every ``unit`` from ``first`` up to but not including ``end``."""
    step = F.expr(f"interval 1 {unit}")
    column = F.explode(F.sequence(F.col(first), F.col(end), step)).alias(f"date_{unit}")
    return bounds.select(F.col(end).alias("_end"), column).filter(
        F.col(f"date_{unit}") < F.col("_end")
    ).drop("_end")


def write_calendar_csv(calendar: DataFrame, path: str) -> None:
    """CSV with a header, dates as ISO text."""
    calendar.write.option("header", True).mode("overwrite").csv(path)


def read_calendar_csv(spark: SparkSession, path: str) -> DataFrame:
    """The calendar with its declared types, nothing inferred."""
    return spark.read.schema(CALENDAR_SCHEMA).option("header", True).csv(path)

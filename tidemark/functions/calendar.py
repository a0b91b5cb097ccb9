"""Calendar attributes of a date column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# National holidays, MM-dd for every year, yyyy-MM-dd for one.
BRAZIL_HOLIDAYS = (
    "01-01", "04-21", "05-01", "09-07", "10-12", "11-02", "11-15", "12-25",
    "2020-02-24", "2020-02-25", "2020-04-10", "2020-06-11",
    "2021-02-15", "2021-02-16", "2021-04-02", "2021-06-03",
    "2022-02-28", "2022-03-01", "2022-04-15", "2022-06-16",
    "2023-02-20", "2023-02-21", "2023-04-07", "2023-06-08",
    "2024-02-12", "2024-02-13", "2024-03-29", "2024-05-30",
    "2025-03-03", "2025-03-04", "2025-04-18", "2025-06-19",
    "2026-02-16", "2026-02-17", "2026-04-03", "2026-06-04",
)


def is_weekend(day: Column) -> Column:
    return F.weekday(day) >= 5


def is_holiday(day: Column, holidays: Sequence[str] = BRAZIL_HOLIDAYS) -> Column:
    yearly = [h for h in holidays if len(h) == 5]
    dated = [h for h in holidays if len(h) == 10]
    return F.date_format(day, "MM-dd").isin(yearly) | F.date_format(day, "yyyy-MM-dd").isin(dated)


def calendar_columns(day: Column, holidays: Sequence[str] = BRAZIL_HOLIDAYS) -> list[Column]:
    """All attributes of the calendar dimension, in table order."""
    return [
        F.date_format(day, "yyyyMMdd").cast("int").alias("date_id"),
        day.alias("full_date"),
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.weekofyear(day).alias("week"),
        (F.weekday(day) + 1).alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        is_weekend(day).alias("is_weekend"),
        (~is_weekend(day) & ~is_holiday(day, holidays)).alias("is_business_day"),
    ]

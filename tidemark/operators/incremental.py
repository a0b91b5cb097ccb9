"""Incremental tables: look-back, delete and insert, added columns."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import materialize
from tidemark.sources import versions
from tidemark.sources.tables import (
    check_unit,
    newest_date,
    periods_in,
    read_periods,
    replace_periods,
    write_table,
)

LOOKBACK_DAYS = 7


def lookback_start(target: DataFrame, date_col: str, days: int = LOOKBACK_DAYS) -> dt.date | None:
    """First date to refresh: the newest date of the target less ``days``.

    One high-water mark for all keys; None for an empty target.
    """
    newest = target.agg(F.max(date_col)).head()[0]
    return None if newest is None else newest - dt.timedelta(days=days)


def lookback_start_of_table(
    spark: SparkSession, path: str, date_col: str, days: int = LOOKBACK_DAYS
) -> dt.date | None:
    """The same for a stored table, of which only the latest period is read."""
    newest = newest_date(spark, path, date_col)
    return None if newest is None else newest - dt.timedelta(days=days)


def since(source: DataFrame, date_col: str, start: dt.date | None) -> DataFrame:
    """Source rows from the start date on, all of them without one."""
    return source if start is None else source.filter(F.col(date_col) >= F.lit(start))


def since_by_key(
    source: DataFrame, target: DataFrame, key: str, date_col: str, days: int = LOOKBACK_DAYS
) -> DataFrame:
    """Look-back with a high-water mark per key: a late key loads in full."""
    marks = materialize(target.groupBy(key).agg(F.max(date_col).alias("_mark")), "high-water")
    recent = F.col("_mark").isNull() | (F.col(date_col) >= F.date_sub("_mark", days))
    return source.join(marks, key, "left").filter(recent).select(*source.columns)


def delete_insert(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Delete the batch's keys from the target, then add the batch.

    Columns new in the batch come last, NULL in the rows that stay; columns
    gone from the batch stay, NULL in its rows.
    """
    kept = target.join(batch.select(*keys).distinct(), list(keys), "left_anti")
    return kept.select(*target.columns).unionByName(batch, allowMissingColumns=True)


def refresh_table(
    spark: SparkSession,
    path: str,
    batch: DataFrame,
    keys: Sequence[str],
    date_col: str,
    unit: str = "month",
    full_refresh: bool = False,
) -> None:
    """Delete and insert in the stored table, or replace it.

    ``batch`` is already cut to its look-back; only its periods are rewritten.
    """
    base = versions.newest(spark, path)
    if full_refresh or base is None or not base.parts:
        write_table(batch, path, date_col, unit, create=base is None)
        return
    check_unit(base, path, unit)
    rows = materialize(batch, "refresh-batch")
    periods = periods_in(rows, date_col, unit)
    if periods:
        target = read_periods(spark, path, periods, version=base)
        replace_periods(delete_insert(target, rows, keys), path, date_col, unit, base)

"""Stored tables: versioned, their data in parts by a period of their date.

Months suit tables of ordinary size. Days let a load of one day into a very
large table rewrite that day alone. A write publishes all that it changes in one
step (see ``versions``).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources import versions
from tidemark.sources.versions import NULL_PART, Version

PERIOD = versions.PART

# The letter keeps partition values text, whatever the reader would infer.
_PATTERNS = {"day": "'d'yyyy-MM-dd", "month": "'m'yyyy-MM", "year": "'y'yyyy"}


class NoTable(Exception):
    """There is no stored table at the path."""


def period_of(date: str | Column, unit: str) -> Column:
    return F.date_format(date, _PATTERNS[unit])


def present(spark: SparkSession, path: str) -> Version:
    """The newest version of a table that must be there."""
    version = versions.newest(spark, path)
    if version is None:
        raise NoTable(path)
    return version


def read_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    version: Version | None = None,
) -> DataFrame:
    """A stored table, or the columns of a schema with NULL for those it lacks.

    ``version`` may be an earlier one; the newest is read without.
    """
    version = version or present(spark, path)
    return shaped(versions.read_parts(spark, path, version), schema)


def read_since(
    spark: SparkSession, path: str, date_col: str, start: dt.date, unit: str = "month"
) -> DataFrame:
    """Rows from a date on; older periods are pruned before the scan."""
    first = period_of(F.lit(start), unit)
    recent = (F.col(PERIOD) >= first) & (F.col(date_col) >= F.lit(start))
    rows = versions.read_parts(spark, path, present(spark, path))
    return rows.filter(recent).drop(PERIOD)


def read_periods(
    spark: SparkSession,
    path: str,
    periods: Sequence[str],
    schema: T.StructType | None = None,
    version: Version | None = None,
) -> DataFrame:
    """Only the named periods of a stored table; no other folder is listed."""
    version = version or present(spark, path)
    return shaped(versions.read_parts(spark, path, version, periods), schema)


def newest_date(spark: SparkSession, path: str, date_col: str) -> dt.date | None:
    """Latest date of a stored table, read from its latest period alone."""
    version = present(spark, path)
    periods = periods_of(version)
    if not periods:
        return None
    latest = versions.read_parts(spark, path, version, periods[-1:])
    return latest.agg(F.max(date_col)).head()[0]


def stored_periods(spark: SparkSession, path: str) -> list[str]:
    """The periods that a stored table has rows for, from its manifest."""
    return periods_of(present(spark, path))


def check_unit(version: Version, path: str, unit: str) -> None:
    """Refuse a load by another period unit than the table's own.

    Parts of two units would each hold rows of the same key.
    """
    letter = _PATTERNS[unit][1]
    others = [p for p in periods_of(version) if not p.startswith(letter)]
    if others:
        raise ValueError(f"{path} is not stored by {unit}: it has the period {others[0]}")


def table_exists(spark: SparkSession, path: str) -> bool:
    """True when there is a table, empty or not."""
    return versions.newest(spark, path) is not None


def write_sorted(
    df: DataFrame, path: str, order_by: Sequence[str], notes: Mapping[str, str] | None = None
) -> Version:
    """Replace a whole table, its files in the given order."""
    ordered = df.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
    return write_whole(ordered, path, notes)


def write_whole(df: DataFrame, path: str, notes: Mapping[str, str] | None = None) -> Version:
    """Replace a whole table by rows that are laid out already, with their columns."""
    spark = df.sparkSession
    base = versions.newest(spark, path)
    schema = versions.replaced(base, df.schema)
    parts = versions.stage(df, path, schema, by_part=False)
    return versions.commit(spark, path, base, schema, parts, notes, whole=True)


def write_table(
    df: DataFrame,
    path: str,
    date_col: str,
    unit: str = "month",
    order_by: Sequence[str] = (),
    notes: Mapping[str, str] | None = None,
    create: bool = False,
) -> Version:
    """Replace a whole table, one part per period; ``create`` demands that there is none."""
    spark = df.sparkSession
    base = None if create else versions.newest(spark, path)
    schema = versions.replaced(base, df.schema)
    rows = _rebalanced(df.withColumn(PERIOD, period_of(date_col, unit)))
    if order_by:
        rows = rows.sortWithinPartitions(PERIOD, *order_by)
    parts = versions.stage(rows, path, schema, by_part=True)
    return versions.commit(spark, path, base, schema, parts, notes, whole=True)


def replace_periods(
    df: DataFrame,
    path: str,
    date_col: str,
    unit: str = "month",
    base: Version | None = None,
    order_by: Sequence[str] = (),
    emptied: Sequence[str] = (),
    notes: Mapping[str, str] | None = None,
) -> Version:
    """Replace the periods that occur in ``df`` and drop ``emptied`` ones without rows.

    ``base`` is the version that ``df`` was derived from, if it was.
    """
    spark = df.sparkSession
    base = base or present(spark, path)
    schema = versions.next_schema(base, df.schema)
    rows = _rebalanced(df.withColumn(PERIOD, period_of(date_col, unit)))
    if order_by:
        rows = rows.sortWithinPartitions(PERIOD, *order_by)
    parts = versions.stage(rows, path, schema, by_part=True)
    dropped = {period: [] for period in emptied}
    return versions.commit(spark, path, base, schema, {**dropped, **parts}, notes)


def periods_in(df: DataFrame, date_col: str, unit: str = "month") -> list[str]:
    """The distinct periods of a column, no more than there are days."""
    return sorted(r[0] for r in df.select(period_of(date_col, unit)).distinct().collect())


def periods_of(version: Version) -> list[str]:
    """The periods that a version has rows for; rows without a date are in none."""
    return sorted(part for part in version.parts if part != NULL_PART)


def shaped(rows: DataFrame, schema: T.StructType | None) -> DataFrame:
    """Rows of a table with the columns of a schema, NULL for those it lacks."""
    if schema is None:
        return rows.drop(PERIOD)
    stored = set(rows.columns)
    return rows.select(
        *(
            (F.col(f.name) if f.name in stored else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        )
    )


def _rebalanced(rows: DataFrame) -> DataFrame:
    """Small periods gathered into few files, a hot one split over several."""
    return rows.hint("rebalance", F.col(PERIOD))

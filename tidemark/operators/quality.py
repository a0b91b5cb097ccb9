"""Declarative data checks and source freshness."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.keys import run_stamp


class ChecksFailed(Exception):
    """Raised when a layer has failing checks; carries (table, check, columns, failures)."""


@dataclass(frozen=True)
class RowCheck:
    """A condition that every single row must meet."""

    name: str
    columns: str
    failing: Callable[[], Column]

    def failures(self, df: DataFrame) -> DataFrame:
        return df.filter(self.failing())


@dataclass(frozen=True)
class GroupCheck:
    """A condition on the groups of equal values; failures are groups."""

    name: str
    keys: tuple[str, ...]
    considered: Callable[[], Column]
    failing: Callable[[], Column]

    @property
    def columns(self) -> str:
        return ", ".join(self.keys)

    def failures(self, df: DataFrame) -> DataFrame:
        groups = df.filter(self.considered()).groupBy(*self.keys)
        return groups.agg(F.count(F.lit(1)).alias("n_records")).filter(self.failing())


Check = RowCheck | GroupCheck


def not_null(column: str) -> RowCheck:
    return RowCheck("not_null", column, lambda: F.col(column).isNull())


def between(column: str, low: float, high: float) -> RowCheck:
    """Within both limits; a NULL passes."""
    return RowCheck("between", column, lambda: ~F.col(column).between(low, high))


def unique(column: str) -> GroupCheck:
    """No value twice; NULLs are not counted."""
    return GroupCheck("unique", (column,), lambda: F.col(column).isNotNull(), _repeated)


def unique_combination(*columns: str) -> GroupCheck:
    return GroupCheck("unique_combination", columns, lambda: F.lit(True), _repeated)


def accepted_values(column: str, values: Sequence[str]) -> GroupCheck:
    """Only listed values; a NULL passes."""
    return GroupCheck(
        "accepted_values",
        (column,),
        lambda: ~F.col(column).isin(list(values)),
        lambda: F.lit(True),
    )


def _repeated() -> Column:
    return F.col("n_records") > 1


def run_checks(df: DataFrame, table: str, checks: Iterable[Check]) -> DataFrame:
    """Failures per check as (table, check, columns, failures).

    All row checks of the table share one aggregate pass; a group check takes
    one aggregate of its own.
    """
    checks = list(checks)
    results = []
    row_checks = [c for c in checks if isinstance(c, RowCheck)]
    if row_checks:
        counts = df.agg(*(F.count_if(c.failing()).alias(f"c{i}") for i, c in enumerate(row_checks)))
        entries = [_entry(table, c, F.col(f"c{i}")) for i, c in enumerate(row_checks)]
        results.append(counts.select(F.explode(F.array(*entries)).alias("r")).select("r.*"))
    for check in checks:
        if isinstance(check, GroupCheck):
            count = check.failures(df).agg(F.count(F.lit(1)).alias("c"))
            results.append(count.select(_entry(table, check, F.col("c")).alias("r")).select("r.*"))
    return reduce(DataFrame.unionByName, results)


def require(report: DataFrame) -> None:
    """Raise if any check of the report failed; the report is a row per check."""
    failed = [tuple(r) for r in report.filter("failures > 0").collect()]
    if failed:
        raise ChecksFailed(failed)


def freshness(
    df: DataFrame,
    loaded_at: str,
    as_of: dt.datetime | str,
    warn_days: int,
    error_days: int,
) -> DataFrame:
    """One row: newest load time and pass, warn or error for its age.

    Older than the limit fails, exactly as old passes; no rows at all is an error.
    """
    newest = F.col("max_loaded_at")

    def older_than(days: int) -> Column:
        return newest < run_stamp(as_of) - F.make_dt_interval(F.lit(days))

    status = (
        F.when(newest.isNull() | older_than(error_days), "error")
        .when(older_than(warn_days), "warn")
        .otherwise("pass")
    )
    return df.agg(F.max(loaded_at).alias("max_loaded_at")).select(newest, status.alias("status"))


def _entry(table: str, check: Check, failures: Column) -> Column:
    return F.struct(
        F.lit(table).alias("table_name"),
        F.lit(check.name).alias("check_name"),
        F.lit(check.columns).alias("column_name"),
        failures.alias("failures"),
    )

"""Checks of stored tables that look at changed parts only.

The outcome of each check is kept per part of the table (a period, say) in a table of
its own: for checks of rows the number that fail, for checks of groups the groups that
fail. Parts that are the same files as at the last time keep their outcome; the others
are checked again. Outcomes of all parts merge to those of the whole table if a group
never spans parts, which holds for keys with the date that the parts are made of, and
for accepted values, of which a failing one counts once however many parts it is in.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.quality import Check, GroupCheck, RowCheck
from tidemark.sources import versions
from tidemark.sources.tables import present
from tidemark.sources.versions import PART

OUTCOME = "check int, failing string, n_records long"
_CHECKED, _CHECKS = "checked", "checks"


def outcomes(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Per part (column PART) and check the failing rows counted, or the failing groups.

    Every part gets a row for each check of rows, so that none is without an outcome.
    """
    rows = [(i, c) for i, c in enumerate(checks) if isinstance(c, RowCheck)]
    counts = df.groupBy(PART).agg(
        F.count(F.lit(1)).alias("_all"),
        *(F.count_if(c.failing()).alias(f"_c{i}") for i, c in rows),
    )
    entries = [
        F.struct(F.lit(i).alias("check"), F.col(f"_c{i}").alias("n_records")) for i, _ in rows
    ]
    entries.append(F.struct(F.lit(-1).alias("check"), F.col("_all").alias("n_records")))
    found = [
        counts.select(PART, F.explode(F.array(*entries)).alias("_entry")).select(
            PART,
            "_entry.check",
            F.lit(None).cast("string").alias("failing"),
            "_entry.n_records",
        )
    ]
    for i, check in enumerate(checks):
        if isinstance(check, GroupCheck):
            groups = df.filter(check.considered()).groupBy(PART, *check.keys)
            failing = groups.agg(F.count(F.lit(1)).alias("n_records")).filter(check.failing())
            found.append(
                failing.select(
                    PART,
                    F.lit(i).alias("check"),
                    F.to_json(F.struct(*check.keys), {"ignoreNullFields": "false"}).alias(
                        "failing"
                    ),
                    "n_records",
                )
            )
    return reduce(DataFrame.unionByName, found)


def report(state: DataFrame, table: str, checks: Sequence[Check]) -> DataFrame:
    """Failures per check as (table, check, columns, failures), as ``run_checks`` has them."""
    names = state.sparkSession.createDataFrame(
        [
            (i, table, c.name, c.columns, isinstance(c, GroupCheck))
            for i, c in enumerate(checks)
        ],
        "check int, table_name string, check_name string, column_name string, by_group boolean",
    )
    merged = state.groupBy("check").agg(
        F.sum("n_records").alias("_rows"), F.count_distinct("failing").alias("_groups")
    )
    failures = F.when(F.col("by_group"), F.col("_groups")).otherwise(F.col("_rows"))
    return names.join(merged, "check", "left").select(
        "table_name",
        "check_name",
        "column_name",
        F.coalesce(failures, F.lit(0)).cast("long").alias("failures"),
    )


def incremental_checks(
    spark: SparkSession,
    path: str,
    state_path: str,
    table: str,
    checks: Sequence[Check],
    model: Callable[[DataFrame], DataFrame] | None = None,
    part_key: str | None = None,
) -> DataFrame:
    """Check a stored table, reading only the parts that changed since the last time.

    ``model`` makes the rows to be checked from the stored ones, with their PART.
    ``part_key`` is the column that the parts are made of: a combination is unique per
    part only if it is among its columns. Other checks than at the last time, or a state
    whose version of the table is gone, check every part.
    """
    now = present(spark, path)
    for check in checks:
        whole = part_key is None or part_key in check.columns.split(", ")
        if check.name.startswith("unique") and not whole:
            raise ValueError(f"{check.columns} may repeat in different parts of {table}")
    state = versions.newest(spark, state_path)
    listed = repr([(c.name, c.columns) for c in checks])
    before = None
    if state is not None and state.notes.get(_CHECKS) == listed:
        number = int(state.notes[_CHECKED])
        if number in versions.version_numbers(spark, path):
            before = versions.read_version(spark, path, number)
    changed = versions.changed_parts(before, now)
    if before is None or changed:
        stored = versions.read_parts(spark, path, now, sorted(changed))
        found = outcomes(stored if model is None else model(stored), checks)
        schema = versions.next_schema(state, spark.createDataFrame([], OUTCOME).schema)
        staged = versions.stage(found, state_path, schema, by_part=True)
        state = versions.commit(
            spark,
            state_path,
            state,
            schema,
            {**{name: [] for name in changed}, **staged},
            {_CHECKED: str(now.number), _CHECKS: listed},
            whole=before is None,
        )
    return report(versions.read_parts(spark, state_path, state).drop(PART), table, checks)

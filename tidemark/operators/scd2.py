"""Type 2 history of slowly changing attributes."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.keys import run_stamp
from tidemark.sources import versions
from tidemark.sources.tables import present

SCD_ID, UPDATED_AT, VALID_FROM, VALID_TO = (
    "dbt_scd_id",
    "dbt_updated_at",
    "dbt_valid_from",
    "dbt_valid_to",
)
_HISTORY_COLUMNS = [SCD_ID, UPDATED_AT, VALID_FROM, VALID_TO]
_OPEN, _RUNS = "open", "runs"
_RUN_NAME = "yyyyMMdd'T'HHmmss.SSSSSS"


def one_row_per_key(source: DataFrame, key: str) -> DataFrame:
    """The source itself, failing the job on a key with two different rows."""
    rest = [c for c in source.columns if c != key]
    rows = source.groupBy(key).agg(
        F.min(F.struct(*rest)).alias("_row"), F.max(F.struct(*rest)).alias("_other")
    )
    conflict = F.raise_error(F.concat(F.lit(f"several rows for {key} "), F.col(key).cast("string")))
    row = F.when(F.col("_row").eqNullSafe(F.col("_other")), F.col("_row")).otherwise(
        conflict.cast(rows.schema["_row"].dataType)
    )
    return rows.select(key, row.alias("_row")).select(key, "_row.*").select(*source.columns)


def newest_row_per_key(source: DataFrame, key: str, order_by: str) -> DataFrame:
    """Optional answer to conflicting rows: the newest by ``order_by`` wins."""
    rest = [c for c in source.columns if c not in (key, order_by)]
    newest = source.groupBy(key).agg(F.max(F.struct(order_by, *rest)).alias("_row"))
    return newest.select(key, *(F.col(f"_row.{c}").alias(c) for c in rest))


def scd2_start(source: DataFrame, key: str, run_ts: dt.datetime | str) -> DataFrame:
    """First run: every key opens a row."""
    return one_row_per_key(source, key).withColumns(_opened(F.col(key), run_ts))


def scd2_merge(
    history: DataFrame,
    source: DataFrame,
    key: str,
    check_cols: Sequence[str],
    run_ts: dt.datetime | str,
) -> DataFrame:
    """History after one more run over the present state of the source.

    New keys open a row; keys with a changed column close theirs and open
    another; keys gone from the source close theirs; the rest is untouched.
    """
    closed = history.filter(F.col(VALID_TO).isNotNull())
    merged = _merge_open(history.filter(F.col(VALID_TO).isNull()), source, key, check_cols, run_ts)
    return closed.unionByName(merged)


def scd2_table(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    key: str,
    check_cols: Sequence[str],
    run_ts: dt.datetime | str,
) -> None:
    """One run on a stored history.

    The open rows are one part of the table, those closed by a run another, named after
    the run to the microsecond; parts of earlier runs are not read again. A run
    publishes both of its parts in one step, so that one that fails leaves the history
    as it was. A run that is repeated, with the same or a corrected source, first undoes
    what it did: it opens the rows again that it had closed and forgets those that it
    had opened. A run dated before the newest one is put where it belongs
    (``scd2_late_merge``).
    """
    base = versions.newest(spark, path)
    name = spark.range(1).select(F.date_format(run_stamp(run_ts), _RUN_NAME)).first()[0]
    own = f"closed-{name}"
    runs = json.loads(base.notes.get(_RUNS, "[]")) if base is not None else []
    notes = {_RUNS: json.dumps(sorted({*runs, name}))}
    if base is None:
        rows = scd2_start(source, key, run_ts)
    elif runs and name < runs[-1]:
        _late_run(spark, path, base, source, key, check_cols, run_ts, name, runs, notes)
        return
    else:
        state = versions.read_parts(spark, path, base, [_OPEN]).drop(versions.PART)
        again = versions.read_parts(spark, path, base, [own]).drop(versions.PART)
        state = state.unionByName(again.withColumn(VALID_TO, _never()))
        state = state.filter(F.col(VALID_FROM) != run_stamp(run_ts)).dropDuplicates([SCD_ID])
        rows = _merge_open(state, source, key, check_cols, run_ts)
    schema = versions.next_schema(base, rows.schema)
    part = F.when(F.col(VALID_TO).isNull(), F.lit(_OPEN)).otherwise(F.lit(own))
    staged = versions.stage(rows.withColumn(versions.PART, part), path, schema, by_part=True)
    versions.commit(spark, path, base, schema, {_OPEN: [], own: [], **staged}, notes)


def scd2_late_merge(
    later: DataFrame,
    source: DataFrame,
    key: str,
    check_cols: Sequence[str],
    run_ts: dt.datetime | str,
    next_ts: dt.datetime | str,
) -> DataFrame:
    """History rows that end after ``run_ts`` (or are open), with a run at that time put in.

    ``next_ts`` is the first later run. A row that was valid at the late run and differs
    from its state ends there; the state is valid until the next run, or begins the row
    of the next run if that is the same; a row that went on through the next run begins
    again there. That is the history of the runs in order, but that a row that begins
    again takes what is not checked from the one before it.
    """
    late, after = run_stamp(run_ts), run_stamp(next_ts)
    ends = F.col(VALID_TO)
    at_late = (F.col(VALID_FROM) < late) & (ends.isNull() | (ends > late))
    at_next = F.col(VALID_FROM) == after
    columns = [*source.columns, *_HISTORY_COLUMNS]
    was = later.filter(at_late).select(F.col(key), F.struct(*columns).alias("_was"))
    then = later.filter(at_next).select(F.col(key), F.struct(*columns).alias("_then"))
    state = one_row_per_key(source, key).withColumns(_opened(F.col(key), run_ts))
    state = state.select(F.col(key), F.struct(*columns).alias("_state"))

    def same(a: str, b: str) -> Column:
        return reduce(
            lambda x, y: x & y,
            (F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in check_cols),
        )

    def known(name: str) -> Column:
        return F.col(name).isNotNull()

    kept = known("_was") & known("_state") & same("_was", "_state")
    starts_next = known("_state") & known("_then") & same("_state", "_then")
    cut = F.when(known("_was"), F.col("_was").withField(VALID_TO, late))
    until_next = F.when(known("_state"), F.col("_state").withField(VALID_TO, after))
    joined_on = F.col("_state").withField(VALID_TO, F.col(f"_then.{VALID_TO}"))
    again = F.col("_was")
    for column, value in _opened(F.col(key), next_ts).items():
        if column != VALID_TO:
            again = again.withField(column, value)
    through = known("_was") & F.coalesce(F.col(f"_was.{VALID_TO}") > after, F.lit(True))
    goes_on = F.when(through, again)
    pieces = (
        F.when(kept, F.array("_was", "_then"))
        .when(starts_next, F.array(cut, joined_on))
        .otherwise(F.array(cut, until_next, goes_on, F.col("_then")))
    )
    changed = (
        was.join(then, key, "full_outer")
        .join(state, key, "full_outer")
        .select(F.explode(F.filter(pieces, lambda row: row.isNotNull())).alias("_row"))
        .select("_row.*")
    )
    untouched = later.filter(~at_late & ~at_next).select(*columns)
    return untouched.unionByName(changed.select(*columns))


def _late_run(
    spark: SparkSession,
    path: str,
    base: versions.Version,
    source: DataFrame,
    key: str,
    check_cols: Sequence[str],
    run_ts: dt.datetime | str,
    name: str,
    runs: Sequence[str],
    notes: Mapping[str, str],
) -> None:
    """A run that comes after later ones; only parts closed after it are read again."""
    if name in runs:
        raise ValueError(f"{path}: of the runs there are, only the newest can be repeated")
    following = min(r for r in runs if r > name)
    next_ts = dt.datetime.strptime(following, "%Y%m%dT%H%M%S.%f")
    touched = [p for p in base.parts if p == _OPEN or p > f"closed-{name}"]
    later = versions.read_parts(spark, path, base, touched).drop(versions.PART)
    rows = scd2_late_merge(later, source, key, check_cols, run_ts, next_ts)
    schema = versions.next_schema(base, rows.schema)
    closed = F.concat(F.lit("closed-"), F.date_format(VALID_TO, _RUN_NAME))
    part = F.when(F.col(VALID_TO).isNull(), F.lit(_OPEN)).otherwise(closed)
    staged = versions.stage(rows.withColumn(versions.PART, part), path, schema, by_part=True)
    versions.commit(spark, path, base, schema, {**{p: [] for p in touched}, **staged}, notes)


def read_history(spark: SparkSession, path: str) -> DataFrame:
    return versions.read_parts(spark, path, present(spark, path)).drop(versions.PART)


def _never() -> Column:
    return F.lit(None).cast(T.TimestampNTZType())


def _opened(key: Column, run_ts: dt.datetime | str) -> dict[str, Column]:
    stamp = run_stamp(run_ts)
    text = F.date_format(stamp, "yyyy-MM-dd HH:mm:ss")
    fraction = F.date_format(stamp, "SSSSSS")
    text = F.when(fraction == "000000", text).otherwise(F.concat(text, F.lit("."), fraction))
    return {
        SCD_ID: F.md5(F.concat_ws("|", key.cast("string"), text)),
        UPDATED_AT: stamp,
        VALID_FROM: stamp,
        VALID_TO: _never(),
    }


def _merge_open(
    open_rows: DataFrame,
    source: DataFrame,
    key: str,
    check_cols: Sequence[str],
    run_ts: dt.datetime | str,
) -> DataFrame:
    """Open rows against the source: one join, up to two rows out per key."""
    columns = [*source.columns, *_HISTORY_COLUMNS]
    old = open_rows.select(F.col(key), F.struct(*columns).alias("_old"))
    new = one_row_per_key(source, key).withColumns(_opened(F.col(key), run_ts))
    new = new.select(F.col(key), F.struct(*columns).alias("_new"))

    had, has = F.col("_old").isNotNull(), F.col("_new").isNotNull()
    same = reduce(
        lambda a, b: a & b, (F.col(f"_old.{c}").eqNullSafe(F.col(f"_new.{c}")) for c in check_cols)
    )
    ended = F.col("_old").withField(VALID_TO, run_stamp(run_ts))
    versions = (
        F.when(~had, F.array("_new"))
        .when(~has, F.array(ended))
        .when(same, F.array("_old"))
        .otherwise(F.array(ended, F.col("_new")))
    )
    return (
        old.join(new, key, "full_outer")
        .select(F.explode(versions).alias("_version"))
        .select("_version.*")
        .select(*columns)
    )

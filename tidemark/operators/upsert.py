"""Keyed replacement: newest row per key, upsert, and its stored form."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.keys import required
from tidemark.operators.quality import unique_combination
from tidemark.session import materialize
from tidemark.sources import versions
from tidemark.sources.file_stats import files_of, files_with, write_stats
from tidemark.sources.tables import PERIOD, check_unit, period_of, shaped
from tidemark.sources.versions import FILE, Version


# When the provider was asked for a row. Stored beside the table's own columns and
# read by upserts only; NULL where a batch does not say.
PULLED_AT = "_pulled_at"


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of a table by name: missing ones NULL, required ones enforced."""
    present = set(df.columns)
    columns = []
    for field in schema.fields:
        if not field.nullable:
            columns.append(required(field.name, field.dataType))
        elif field.name in present:
            columns.append(F.col(field.name).cast(field.dataType).alias(field.name))
        else:
            columns.append(F.lit(None).cast(field.dataType).alias(field.name))
    return df.select(*columns)


def known_values(df: DataFrame, column: str) -> DataFrame:
    """Rows with a measured value; a NaN is as missing as a NULL."""
    return df.filter(F.col(column).isNotNull() & ~F.isnan(column))


def newest_per_key(df: DataFrame, keys: Sequence[str], version: str) -> DataFrame:
    """One row per key: the newest version, ties settled by the other columns.

    An aggregate, so copies of a hot key are reduced before the shuffle.
    """
    others = [c for c in df.columns if c not in keys and c != version]
    newest = df.groupBy(*keys).agg(F.max(F.struct(version, *others)).alias("_newest"))
    return newest.select(*keys, "_newest.*").select(*df.columns)


def upsert(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The target with the batch's rows in place of its own for equal keys.

    ``batch`` has one row per key (see ``newest_per_key``).
    """
    kept = target.join(batch.select(*keys), list(keys), "left_anti")
    return kept.select(*target.columns).unionByName(batch, allowMissingColumns=True)


def merged(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``upsert`` that keeps the target's row where it was pulled after the batch's.

    One join serves both questions. Both sides have the same columns.
    """
    columns = target.columns
    old = target.select(*keys, F.struct(*columns).alias("_old"))
    new = batch.select(*keys, F.struct(*columns).alias("_new"))
    stale = F.col(f"_old.{PULLED_AT}") > F.col(f"_new.{PULLED_AT}")
    stays = F.col("_new").isNull() | F.coalesce(stale, F.lit(False))
    winner = F.when(stays, F.col("_old")).otherwise(F.col("_new"))
    return old.join(new, list(keys), "full_outer").select(winner.alias("_row")).select("_row.*")


# Batches with more keys of a period than this will meet most of its files, which are
# then read without asking.
ASKED_KEYS = 20_000
# A period of more paths than this is written anew as a whole when it is next touched.
MOST_PATHS = 256


def upsert_table(
    spark: SparkSession,
    path: str,
    batch: DataFrame,
    schema: T.StructType,
    keys: Sequence[str],
    date_col: str = "date",
    version: str = "ingested_at",
    unit: str = "month",
) -> DataFrame:
    """Upsert into a stored table, created on first use; returns the batch as loaded.

    Only files that may hold a key of the batch are read and replaced: files lie in the
    periods of their dates, in the order of their keys, and ``file_stats`` tells which
    of them may hold a key. Loading a batch again leaves the table as it is. Of rows
    with the same key the one pulled last wins, in the batch and against the table,
    however the rows are dealt into batches; ``version`` decides between equal or
    unknown pulls, and the batch wins over the table. Only rows of repeated keys are
    shuffled whole to settle them.
    """
    stored_schema = T.StructType(
        [*schema.fields, T.StructField(PULLED_AT, T.TimestampNTZType(), True)]
    )
    base = versions.newest(spark, path)
    rows = materialize(conform(batch, stored_schema), "upsert-batch")
    repeated = unique_combination(*keys).failures(rows).select(*keys)
    if not repeated.isEmpty():
        repeated = materialize(repeated, "upsert-repeated")
        order = F.struct(F.coalesce(PULLED_AT, F.lit("0001-01-01").cast("timestamp_ntz")), version)
        several = rows.join(repeated, list(keys), "left_semi").withColumn("_order", order)
        settled = newest_per_key(several, keys, "_order").drop("_order")
        rows = materialize(
            rows.join(repeated, list(keys), "left_anti").unionByName(settled), "upsert-newest"
        )
    period = period_of(date_col, unit)
    kept: dict[str, list[str]] = {}
    new = rows
    if base is not None:
        check_unit(base, path, unit)
        counts = {r[0]: r[1] for r in rows.groupBy(period).count().collect()}
        if not counts:
            return rows
        dated = rows.withColumn(PERIOD, period)
        kept, replaced = _files_to_replace(spark, path, base, dated, keys, counts)
        stored = versions.read_paths(
            spark, path, base.schema, [versions.data_path(path, p) for p in replaced]
        )
        new = merged(shaped(stored, stored_schema), rows, keys)
    next_schema = versions.next_schema(base, stored_schema)
    laid = new.withColumn(PERIOD, period).repartitionByRange(PERIOD, *keys)
    staged = versions.stage(
        laid.sortWithinPartitions(PERIOD, *keys), path, next_schema, by_part=True
    )
    write_stats(spark, path, next_schema, staged, keys)
    parts = {p: [*kept.get(p, []), *staged.get(p, [])] for p in {*kept, *staged}}
    versions.commit(spark, path, base, next_schema, parts)
    return rows


def _files_to_replace(
    spark: SparkSession,
    path: str,
    base: Version,
    rows: DataFrame,
    keys: Sequence[str],
    counts: Mapping[str, int],
) -> tuple[dict[str, list[str]], list[str]]:
    """Paths that stay, by period, and paths whose rows are to be written anew."""
    present = {p: n for p, n in counts.items() if p in base.parts}
    asked = [
        p
        for p, n in present.items()
        if n <= ASKED_KEYS and len(base.parts[p]) <= MOST_PATHS
    ]
    files = materialize(files_of(spark, path, base, asked, keys), "files")
    listed = [tuple(r) for r in files.select(PERIOD, FILE).collect()]
    known = {name for _, file in listed for name in (file, file.rsplit("/", 1)[0])}
    asked = [p for p in asked if known.issuperset(base.parts[p])]
    whole = [p for p in present if p not in asked]
    replaced = [path for p in whole for path in base.parts[p]]
    kept: dict[str, list[str]] = {p: [] for p in whole}
    if asked:
        wanted = rows.filter(F.col(PERIOD).isin(asked)).select(PERIOD, *keys)
        hit = set(files_with(spark, path, base, wanted, keys, files))
        for part, file in listed:
            if part in asked:
                stays = kept.setdefault(part, [])
                (replaced if file in hit else stays).append(file)
    return {p: sorted(files) for p, files in kept.items()}, replaced


def load_report(table: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """One row: rows of the table, rows and distinct keys of the batch."""
    totals = table.agg(F.count(F.lit(1)).alias("table_rows"))
    loaded = batch.agg(
        F.count(F.lit(1)).alias("batch_rows"), F.count_distinct(key).alias("batch_keys")
    )
    lines = totals.unionByName(loaded, allowMissingColumns=True)
    return lines.agg(*(F.max(c).alias(c) for c in lines.columns))

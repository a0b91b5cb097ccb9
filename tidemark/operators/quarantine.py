"""A stored table of payloads that were held back, addressed by their content.

A reject is known by source, file and text, so that the same one is stored once however
often, in whatever batch and by however many streams it comes. A replay parses what is
held back again, after a correction or by a better parser, loads what can now be read
and retires it.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.keys import run_stamp
from tidemark.session import materialize
from tidemark.sources import versions

SCHEMA = (
    "source string, reason string, payload string, run_ts timestamp_ntz, "
    "file string, pulled_at timestamp_ntz, digest string, times long"
)


def addressed(
    rejects: DataFrame, source: str, reason: str, run_ts: dt.datetime | str
) -> DataFrame:
    """Rejects as rows of the quarantine: a row per content, with how often it came."""
    columns = [c for c in rejects.columns if not c.startswith("_")]

    def known(column: str, kind: str):
        return (F.col(column) if column in rejects.columns else F.lit(None)).cast(kind)

    rows = rejects.select(
        F.to_json(F.struct(*columns)).alias("payload"),
        known("_file", "string").alias("file"),
        known("_pulled_at", "timestamp_ntz").alias("pulled_at"),
    )
    digest = F.sha2(F.to_json(F.struct(F.lit(source).alias("s"), "file", "payload")), 256)
    counted = rows.groupBy("file", "payload").agg(
        F.max("pulled_at").alias("pulled_at"), F.count(F.lit(1)).alias("times")
    )
    return counted.select(
        F.lit(source).alias("source"),
        F.lit(reason).alias("reason"),
        "payload",
        run_stamp(run_ts).alias("run_ts"),
        "file",
        "pulled_at",
        digest.alias("digest"),
        "times",
    )


def store_rejects(
    rejects: DataFrame, path: str, source: str, reason: str, run_ts: dt.datetime | str
) -> None:
    """Add what was held back; what is known already stays as it is."""
    spark = rejects.sparkSession
    base = versions.newest(spark, path)
    rows = materialize(addressed(rejects, source, reason, run_ts), "rejects")
    touched = _touched(rows)
    if base is not None:
        if not touched:
            return
        held = versions.read_parts(spark, path, base, touched).drop(versions.PART)
        rows = held.unionByName(rows.join(held.select("digest"), "digest", "left_anti"))
    _commit(rows, path, base, touched)


def retire(path: str, digests: DataFrame) -> None:
    """Take rejects out of the quarantine, by the column ``digest``."""
    spark = digests.sparkSession
    base = versions.newest(spark, path)
    done = materialize(digests.select("digest").distinct(), "retired")
    touched = _touched(done)
    if base is None or not touched:
        return
    held = versions.read_parts(spark, path, base, touched).drop(versions.PART)
    _commit(held.join(done, "digest", "left_anti"), path, base, touched)


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    """Everything held back, a row as often as it was held back at once."""
    version = versions.newest(spark, path)
    if version is None:
        return spark.createDataFrame([], SCHEMA).drop("times")
    rows = versions.read_parts(spark, path, version).drop(versions.PART)
    each = F.explode(F.sequence(F.lit(1).cast("long"), F.col("times")))
    return rows.withColumn("times", each).drop("times")


def replay(
    spark: SparkSession,
    path: str,
    source: str,
    record: T.StructType | str,
    parse: Callable[[DataFrame], tuple[DataFrame, DataFrame]],
    load: Callable[[DataFrame], object],
    correct: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """Parse what is held back of a source again, load it and retire what was read.

    ``record`` is the schema of the stored payloads, ``correct`` may change their
    columns, ``parse`` gives rows and rejects, and ``load`` stores the rows. A reject
    stays held back while its text is, after correction, rejected again. Rows are loaded
    before their rejects are retired, and loading them again changes nothing.
    """
    kind = T.StructType.fromDDL(record) if isinstance(record, str) else record
    held = materialize(read_quarantine(spark, path).filter(F.col("source") == source), "replay")
    records = held.select(
        F.from_json("payload", kind).alias("_record"),
        F.col("file").alias("_file"),
        F.col("pulled_at").alias("_pulled_at"),
        F.col("digest").alias("_digest"),
    ).select("_record.*", "_file", "_pulled_at", "_digest")
    records = materialize(records if correct is None else correct(records), "corrected")
    rows, rejects = parse(records)
    load(rows)
    again = rejects.select(F.col("_digest").alias("digest")).distinct()
    retire(path, held.select("digest").distinct().join(again, "digest", "left_anti"))


def _bucket() -> Column:
    """The part of a reject: a batch rewrites only those that its digests fall into."""
    return F.substring("digest", 1, 1)


def _touched(rows: DataFrame) -> list[str]:
    return sorted(r[0] for r in rows.select(_bucket()).distinct().collect())


def _commit(rows: DataFrame, path: str, base, touched: list[str]) -> None:
    spark = rows.sparkSession
    schema = versions.next_schema(base, rows.schema)
    staged = versions.stage(
        rows.withColumn(versions.PART, _bucket()).repartition(versions.PART),
        path,
        schema,
        by_part=True,
    )
    versions.commit(spark, path, base, schema, {**{t: [] for t in touched}, **staged})

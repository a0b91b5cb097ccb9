"""Landed payloads loaded as they arrive, by the same upserts as in batch.

The file source remembers what it has read, and an upsert repeated after a
failure changes nothing, so each payload takes effect once. One file is one pull:
the newest pull of a key wins and a bad file is held back alone, so that the
table is the same however the files fall into batches.
"""

from __future__ import annotations

import datetime as dt
import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.quarantine import store_rejects
from tidemark.operators.upsert import known_values, load_report, upsert_table
from tidemark.schemas import PRICES_KEY, PRICES_SCHEMA, SERIES_KEY, SERIES_RECORD, SERIES_SCHEMA
from tidemark.sources import versions
from tidemark.sources.payloads import DEFAULT_START, parse_quotes, parse_series, with_pull
from tidemark.sources.tables import read_table

# A large backlog is loaded in several upserts of at most so many files.
FILES_PER_BATCH = 10_000

_BAD_QUOTES = "unreadable, empty or without a date"
_BAD_SERIES = "a date that is none"


def load_quote_files(
    spark: SparkSession,
    landing: str,
    table_path: str,
    checkpoint: str,
    run_ts: dt.datetime | str,
    start: dt.date | None = DEFAULT_START,
    files_per_batch: int = FILES_PER_BATCH,
    unit: str = "month",
    quarantine: str | None = None,
    multi_line: bool = False,
    reports: str | None = None,
) -> StreamingQuery:
    """Upsert every quote payload not loaded yet, then stop.

    Payloads held back are stored below ``quarantine``, and a load report for each batch
    below ``reports``.
    """
    stream = spark.readStream.schema("value string, ticker string")
    files = stream.option("maxFilesPerTrigger", files_per_batch).option("wholetext", multi_line)
    payloads = with_pull(files.text(landing))

    def load(batch: DataFrame, number: int) -> None:
        loaded = parse_quotes(batch, run_ts, start)
        if quarantine is not None:
            store_rejects(loaded.rejects, quarantine, "quotes", _BAD_QUOTES, run_ts)
        batch_rows = upsert_table(
            spark, table_path, loaded.rows, PRICES_SCHEMA, PRICES_KEY, unit=unit
        )
        if reports is not None:
            store_report(batch_rows, table_path, reports, checkpoint, number, PRICES_KEY[0])

    return _run_available(payloads, load, checkpoint)


def load_series_files(
    spark: SparkSession,
    landing: str,
    table_path: str,
    checkpoint: str,
    run_ts: dt.datetime | str,
    files_per_batch: int = FILES_PER_BATCH,
    unit: str = "month",
    quarantine: str | None = None,
    multi_line: bool = False,
    reports: str | None = None,
) -> StreamingQuery:
    """Upsert every series record not loaded yet, then stop.

    A bad date holds back its file, which is stored below ``quarantine``. A load report
    for each batch is stored below ``reports``.
    """
    stream = spark.readStream.schema(f"{SERIES_RECORD}, series_code int")
    files = stream.option("maxFilesPerTrigger", files_per_batch).option("multiLine", multi_line)
    records = with_pull(files.json(landing))

    def load(batch: DataFrame, number: int) -> None:
        loaded = parse_series(batch, run_ts)
        if quarantine is not None:
            store_rejects(loaded.rejects, quarantine, "series", _BAD_SERIES, run_ts)
        rows = known_values(loaded.rows, "value")
        batch_rows = upsert_table(spark, table_path, rows, SERIES_SCHEMA, SERIES_KEY, unit=unit)
        if reports is not None:
            store_report(batch_rows, table_path, reports, checkpoint, number, SERIES_KEY[0])

    return _run_available(records, load, checkpoint)


def store_report(
    batch: DataFrame, table_path: str, reports: str, checkpoint: str, number: int, key: str
) -> None:
    """The load report of one batch; a batch that is repeated reports in its own place."""
    spark = batch.sparkSession
    report = load_report(read_table(spark, table_path), batch, key).select(
        F.lit(checkpoint).alias("stream"), F.lit(number).cast("long").alias("batch"), "*"
    )
    base = versions.newest(spark, reports)
    schema = versions.next_schema(base, report.schema)
    part = f"{zlib.crc32(checkpoint.encode()):08x}-{number:010d}"
    staged = versions.stage(
        report.withColumn(versions.PART, F.lit(part)), reports, schema, by_part=True
    )
    versions.commit(spark, reports, base, schema, staged)


def read_reports(spark: SparkSession, reports: str) -> DataFrame:
    """stream, batch, table_rows, batch_rows, batch_keys of all batches so far."""
    return read_table(spark, reports)


def _run_available(
    stream: DataFrame, load: Callable[[DataFrame, int], None], checkpoint: str
) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )

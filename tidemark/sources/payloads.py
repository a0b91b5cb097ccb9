"""Landed payloads of the two providers, read as jobs over files.

Layout: ``series_code=<code>/*.json`` and ``ticker=<ticker>/*.json``. A file
holds payloads one per line, or with ``multi_line`` one payload as a whole.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.keys import run_stamp
from tidemark.operators.upsert import PULLED_AT
from tidemark.schemas import PRICES_SCHEMA, QUOTE_DOCUMENT, SERIES_RECORD, SERIES_SCHEMA

# Code, name, frequency and unit of the known series.
SERIES = [
    (11, "selic_rate", "daily", "pct_per_year"),
    (433, "ipca_inflation", "monthly", "pct_change"),
    (1, "usd_brl_rate", "daily", "brl_per_usd"),
    (189, "igpm_inflation", "monthly", "pct_change"),
    (4189, "cdi_rate", "daily", "pct_per_year"),
    (7811, "real_interest_rate", "monthly", "pct_per_year"),
]

# Ticker, company, sector and index of the known tickers.
TICKERS = [
    ("PETR4", "Petrobras", "Energy", "IBOVESPA"),
    ("VALE3", "Vale", "Materials", "IBOVESPA"),
    ("ITUB4", "Itau Unibanco", "Financials", "IBOVESPA"),
    ("BBDC4", "Bradesco", "Financials", "IBOVESPA"),
    ("WEGE3", "WEG", "Industrials", "IBOVESPA"),
    ("MGLU3", "Magazine Luiza", "Consumer", "IBOVESPA"),
]

DEFAULT_TICKERS = "PETR4,MGLU3,VALE3,ITUB4"
DEFAULT_START = dt.date(2020, 1, 1)
UNKNOWN = "Unknown"


class Loaded(NamedTuple):
    """Rows for the raw table, and what was held back."""

    rows: DataFrame
    rejects: DataFrame


def ticker_list(text: str = DEFAULT_TICKERS) -> list[str]:
    """Tickers of a comma separated parameter."""
    return [t.strip() for t in text.split(",")]


def day_first_date(text: Column) -> Column:
    """Date from dd/MM/yyyy text, NULL if it is none."""
    return F.try_to_date(text, "dd/MM/yyyy")


def comma_decimal(text: Column) -> Column:
    """Number from text with a decimal comma, NULL if it is none."""
    return F.replace(text, F.lit(","), F.lit(".")).try_cast("double")


def epoch_date(seconds: Column) -> Column:
    """UTC date of epoch seconds, whatever the session's zone."""
    return F.date_from_unix_date(F.floor(seconds / 86_400).cast("int"))


def with_pull(files: DataFrame) -> DataFrame:
    """Adds the time at which a file landed, and its path: one file is one pull."""
    pulled = F.to_timestamp_ntz(
        F.date_format("_metadata.file_modification_time", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    )
    return files.withColumns({PULLED_AT: pulled, "_file": F.col("_metadata.file_path")})


def series_dimension(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        SERIES, "series_code int, series_name string, frequency string, unit string"
    )


def ticker_dimension(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        TICKERS, "ticker string, company string, sector string, market_index string"
    )


def read_series_payloads(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Records of all series files: series_code, data, valor as text, and the pull."""
    records = spark.read.schema(f"{SERIES_RECORD}, series_code int")
    return with_pull(records.option("multiLine", multi_line).json(path))


def parse_series(
    records: DataFrame,
    run_ts: dt.datetime | str,
    start: dt.date | None = None,
    end: dt.date | None = None,
    held_back_by: Sequence[str] | None = None,
) -> Loaded:
    """Known series between two dates; a pull with a bad date is held back whole.

    A pull is a file of a series, in batch as in streams; of records without a file, all
    of the series. ``held_back_by`` may name other columns.
    A value that is no number becomes NULL and stays (the upsert drops it).
    The code list is closed, so the table of codes is broadcast as it is.
    """
    pull = [c for c in ("series_code", "_file") if c in records.columns]
    by = pull if held_back_by is None else list(held_back_by)
    codes = F.broadcast(series_dimension(records.sparkSession))
    parsed = records.join(codes, "series_code").select(
        *records.columns,
        "series_name",
        "frequency",
        "unit",
        day_first_date(F.col("data")).alias("date"),
        comma_decimal(F.col("valor")).alias("value"),
    )
    bad = parsed.filter(F.col("date").isNull()).select(*(F.col(c).alias(f"_bad_{c}") for c in by))
    bad = bad.distinct()
    same = reduce(
        lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"_bad_{c}")) for c in by)
    )
    rows = parsed.join(bad, same, "left_anti")
    if start is not None:
        rows = rows.filter(F.col("date") >= F.lit(start))
    if end is not None:
        rows = rows.filter(F.col("date") <= F.lit(end))
    rejects = parsed.join(bad, same, "left_semi").select(*records.columns)
    return Loaded(
        rows.withColumn("ingested_at", run_stamp(run_ts)).select(
            *SERIES_SCHEMA.fieldNames(), *_pull_of(records)
        ),
        rejects,
    )


def _pull_of(frame: DataFrame) -> list[str]:
    return [PULLED_AT] if PULLED_AT in frame.columns else []


def read_quote_payloads(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """One row per payload, ticker and text, so that a bad one harms no other."""
    files = spark.read.schema("value string, ticker string")
    return with_pull(files.text(path, wholetext=multi_line))


def parse_quotes(
    payloads: DataFrame,
    run_ts: dt.datetime | str,
    start: dt.date | None = DEFAULT_START,
    tickers: Sequence[str] | None = None,
) -> Loaded:
    """Daily quotes from payloads; unreadable or empty payloads are held back,
    and so are payloads with a quote that has no date.

    Only the first result of a payload counts. Tickers without metadata are
    named after themselves. Dividends and splits are not in the payload: 0.
    """
    if tickers is not None:
        payloads = payloads.filter(F.col("ticker").isin(list(tickers)))
    document = F.from_json("value", QUOTE_DOCUMENT, {"mode": "PERMISSIVE"})
    quotes = F.get(document["results"], F.lit(0))["historicalDataPrice"]
    parsed = payloads.withColumn("_quotes", quotes)
    bad = F.col("_quotes").isNull() | (F.size("_quotes") == 0)
    bad |= F.exists("_quotes", lambda q: q.isNull() | q["date"].isNull())
    pull = _pull_of(payloads)

    quoted = (
        parsed.filter(~F.coalesce(bad, F.lit(True)))
        .select("ticker", *pull, F.explode("_quotes").alias("_quote"))
        .select("ticker", *pull, "_quote.*")
        .withColumn("date", epoch_date(F.col("date")))
        .withColumn("volume", F.round("volume").cast("bigint"))
        .withColumnRenamed("adjustedClose", "adj_close")
    )
    if start is not None:
        quoted = quoted.filter(F.col("date") >= F.lit(start))
    rows = with_ticker_metadata(quoted).withColumns(
        {
            "dividends": F.lit(0.0),
            "stock_splits": F.lit(0.0),
            "ingested_at": run_stamp(run_ts),
        }
    )
    return Loaded(
        rows.select(*PRICES_SCHEMA.fieldNames(), *pull),
        parsed.filter(F.coalesce(bad, F.lit(True))).select(*payloads.columns),
    )


def with_ticker_metadata(quotes: DataFrame) -> DataFrame:
    """Company, sector and index by ticker, with defaults for unknown ones."""
    known = F.broadcast(ticker_dimension(quotes.sparkSession))
    return quotes.join(known, "ticker", "left").withColumns(
        {
            "company": F.coalesce("company", "ticker"),
            "sector": F.coalesce("sector", F.lit(UNKNOWN)),
            "market_index": F.coalesce("market_index", F.lit(UNKNOWN)),
        }
    )

"""Schemas of the stored tables and of the payloads they are loaded from."""

from __future__ import annotations

from pyspark.sql import types as T

SERIES_SCHEMA = T.StructType(
    [
        T.StructField("series_code", T.IntegerType(), False),
        T.StructField("series_name", T.StringType(), False),
        T.StructField("frequency", T.StringType(), False),
        T.StructField("unit", T.StringType(), False),
        T.StructField("date", T.DateType(), False),
        T.StructField("value", T.DoubleType(), True),
        T.StructField("ingested_at", T.TimestampNTZType(), False),
    ]
)
SERIES_KEY = ["series_code", "date"]

PRICES_SCHEMA = T.StructType(
    [
        T.StructField("ticker", T.StringType(), False),
        T.StructField("company", T.StringType(), True),
        T.StructField("sector", T.StringType(), True),
        T.StructField("market_index", T.StringType(), True),
        T.StructField("date", T.DateType(), False),
        T.StructField("open", T.DoubleType(), True),
        T.StructField("high", T.DoubleType(), True),
        T.StructField("low", T.DoubleType(), True),
        T.StructField("close", T.DoubleType(), True),
        T.StructField("adj_close", T.DoubleType(), True),
        T.StructField("volume", T.LongType(), True),
        T.StructField("dividends", T.DoubleType(), True),
        T.StructField("stock_splits", T.DoubleType(), True),
        T.StructField("ingested_at", T.TimestampNTZType(), False),
    ]
)
PRICES_KEY = ["ticker", "date"]

CALENDAR_SCHEMA = T.StructType(
    [
        T.StructField("date_id", T.IntegerType()),
        T.StructField("full_date", T.DateType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("quarter", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("month_name", T.StringType()),
        T.StructField("week", T.IntegerType()),
        T.StructField("day_of_week", T.IntegerType()),
        T.StructField("day_name", T.StringType()),
        T.StructField("is_weekend", T.BooleanType()),
        T.StructField("is_business_day", T.BooleanType()),
    ]
)

# Landed payloads. Numbers arrive as text in the series, as numbers in quotes.
SERIES_RECORD = "data string, valor string"
QUOTE_DOCUMENT = (
    "results array<struct<historicalDataPrice: array<struct<"
    "date: bigint, open: double, high: double, low: double, close: double, "
    "volume: double, adjustedClose: double>>>>"
)

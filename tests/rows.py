"""Hand-made raw rows."""

from __future__ import annotations

import datetime as dt

from tidemark.schemas import PRICES_SCHEMA, SERIES_SCHEMA

LOADED = dt.datetime(2024, 1, 31, 7)
DAY_ONE = dt.date(2024, 1, 1)


def day(n: int) -> dt.date:
    """The n-th day of the tests, counted from 0."""
    return DAY_ONE + dt.timedelta(days=n)


def quote(ticker: str, n: int, adj_close, close=10.0, **other) -> tuple:
    row = {
        "ticker": ticker,
        "company": f"{ticker} Inc",
        "sector": "S",
        "market_index": "I",
        "date": day(n),
        "open": 1.0,
        "high": 1.0,
        "low": 1.0,
        "close": close,
        "adj_close": adj_close,
        "volume": 100,
        "dividends": 0.0,
        "stock_splits": 0.0,
        "ingested_at": LOADED,
        **other,
    }
    return tuple(row[name] for name in PRICES_SCHEMA.fieldNames())


def prices(spark, rows):
    return spark.createDataFrame(rows, PRICES_SCHEMA)


UNITS = {
    "selic_rate": (11, "daily", "pct_per_year"),
    "usd_brl_rate": (1, "daily", "brl_per_usd"),
    "cdi_rate": (4189, "daily", "pct_per_year"),
    "ipca_inflation": (433, "monthly", "pct_change"),
    "igpm_inflation": (189, "monthly", "pct_change"),
}


def observation(name: str, date: dt.date, value, loaded: dt.datetime = LOADED) -> tuple:
    code, frequency, unit = UNITS[name]
    return (code, name, frequency, unit, date, value, loaded)


def series(spark, rows):
    return spark.createDataFrame(rows, SERIES_SCHEMA)

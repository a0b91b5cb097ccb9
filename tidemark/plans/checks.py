"""The checks configured for each table."""

from __future__ import annotations

from tidemark.operators.quality import (
    accepted_values,
    between,
    not_null,
    unique,
    unique_combination,
)

# Accepted names and frequencies, limits of values and closes.
SERIES_NAMES = [
    "selic_rate",
    "ipca_inflation",
    "usd_brl_rate",
    "igpm_inflation",
    "cdi_rate",
    "real_interest_rate",
]
FREQUENCIES = ["daily", "monthly"]
VALUE_RANGE = (-50, 10_000)
CLOSE_RANGE = (0.01, 100_000)
FRESHNESS_WARN_DAYS = 3
FRESHNESS_ERROR_DAYS = 7

RAW_SERIES = [
    not_null("series_code"),
    not_null("series_name"),
    accepted_values("series_name", SERIES_NAMES),
    not_null("date"),
    not_null("value"),
    not_null("ingested_at"),
]
RAW_PRICES = [
    not_null("ticker"),
    not_null("date"),
    not_null("close"),
    between("close", *CLOSE_RANGE),
]
STG_SERIES = [
    not_null("series_code"),
    not_null("series_name"),
    not_null("frequency"),
    accepted_values("frequency", FREQUENCIES),
    not_null("unit"),
    not_null("reference_date"),
    not_null("series_value"),
    between("series_value", *VALUE_RANGE),
    not_null("ingested_at"),
]
STG_PRICES = [
    unique_combination("ticker", "trade_date"),
    not_null("ticker"),
    not_null("trade_date"),
    not_null("price_close"),
    between("price_close", *CLOSE_RANGE),
    not_null("price_adj_close"),
    not_null("ingested_at"),
]
MACRO_PIVOTED = [
    not_null("macro_date"),
    unique("macro_date"),
    not_null("is_bacen_business_day"),
]
MARKET_RETURNS = [
    not_null("ticker"),
    not_null("trade_date"),
    not_null("log_return_daily"),
]
MACRO_INDICATORS = [
    not_null("macro_date"),
    unique("macro_date"),
    not_null("dbt_updated_at"),
]
STOCK_PERFORMANCE = [
    unique_combination("ticker", "trade_date"),
    not_null("ticker"),
    not_null("trade_date"),
    not_null("dbt_updated_at"),
]

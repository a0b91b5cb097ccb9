"""The stock mart: market metrics with the macro values of the day."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.finance import risk_premium
from tidemark.functions.keys import run_stamp

STOCK_KEY = ["ticker", "trade_date"]

STOCK_COLUMNS = [
    "ticker",
    "trade_date",
    "company_name",
    "sector",
    "market_index",
    "price_open",
    "price_high",
    "price_low",
    "price_close",
    "price_adj_close",
    "volume",
    "avg_volume_21d",
    "has_corporate_event",
    "dividends",
    "log_return_daily",
    "cumulative_return_index",
    "volatility_21d_annualized",
    "volatility_63d_annualized",
    "drawdown_from_peak",
    "running_peak",
    "selic_rate",
    "usd_brl_rate",
    "cdi_rate",
    "ipca_monthly_pct",
    "risk_premium_vs_cdi",
    "dbt_updated_at",
]

_MACRO_COLUMNS = ["selic_rate", "usd_brl_rate", "cdi_rate", "ipca_monthly_pct"]


def mart_stock_performance(
    returns: DataFrame, macro: DataFrame, run_ts: dt.datetime | str
) -> DataFrame:
    """Market metrics left joined with the macro table on the date.

    ``macro`` should be a stored table (see ``materialize``): it has one row
    per date, and its file size lets the planner broadcast it by itself.
    """
    by_day = macro.select(F.col("macro_date").alias("trade_date"), *_MACRO_COLUMNS)
    return (
        returns.join(by_day, "trade_date", "left")
        .withColumn(
            "risk_premium_vs_cdi",
            risk_premium(F.col("volatility_21d_annualized"), F.col("cdi_rate")),
        )
        .withColumn("dbt_updated_at", run_stamp(run_ts))
        .select(*STOCK_COLUMNS)
    )

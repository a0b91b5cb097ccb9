"""Staging models: typed, renamed and validated rows of the raw tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.finance import corporate_event, log_return
from tidemark.operators.row_groups import MAX_ROWS, RowGroups, group_rows

# Series that cannot be zero or negative.
POSITIVE_SERIES = ["usd_brl_rate", "selic_rate", "cdi_rate"]


def typed_series(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("series_code").cast("int"),
        F.col("series_name").cast("string"),
        F.col("frequency").cast("string"),
        F.col("unit").cast("string"),
        F.col("date").cast("date").alias("reference_date"),
        F.col("value").cast("double").alias("series_value"),
        F.col("ingested_at").cast(T.TimestampNTZType()),
    )


def stg_bacen_series(raw: DataFrame) -> DataFrame:
    """Macro series without missing values or impossible rates."""
    value = F.col("series_value")
    impossible = F.col("series_name").isin(POSITIVE_SERIES) & (value <= 0)
    return typed_series(raw).filter(
        F.col("reference_date").isNotNull() & value.isNotNull() & ~impossible
    )


def typed_prices(raw: DataFrame) -> DataFrame:
    """Quotes with a positive close, typed and renamed."""
    return raw.filter(F.col("close") > 0).select(
        F.col("ticker").cast("string"),
        F.col("company").cast("string").alias("company_name"),
        F.col("sector").cast("string"),
        F.col("market_index").cast("string"),
        F.col("date").cast("date").alias("trade_date"),
        F.col("open").cast("double").alias("price_open"),
        F.col("high").cast("double").alias("price_high"),
        F.col("low").cast("double").alias("price_low"),
        F.col("close").cast("double").alias("price_close"),
        F.col("adj_close").cast("double").alias("price_adj_close"),
        F.col("volume").cast("bigint"),
        F.col("ingested_at").cast(T.TimestampNTZType()),
        F.coalesce(F.col("dividends").cast("double"), F.lit(0.0)).alias("dividends"),
        F.coalesce(F.col("stock_splits").cast("double"), F.lit(0.0)).alias("stock_splits"),
    )


def price_groups(raw: DataFrame, max_rows: int | None = MAX_ROWS) -> RowGroups:
    """Typed quotes grouped for a look at the day before."""
    return group_rows(typed_prices(raw), ["ticker"], "trade_date", lookback=1, max_rows=max_rows)


def with_returns(groups: RowGroups) -> DataFrame:
    """Daily log return and event flag, one row per quote."""
    price = F.col("price_adj_close")
    return groups.finish(
        groups.rows.withColumn(
            "log_return_daily", log_return(price, F.lag(price).over(groups.window))
        )
    ).withColumn("has_corporate_event", corporate_event(F.col("dividends"), F.col("stock_splits")))


def stg_market_prices(raw: DataFrame, max_rows: int | None = MAX_ROWS) -> DataFrame:
    """Daily quotes with the log return against the previous quote."""
    return with_returns(price_groups(raw, max_rows))

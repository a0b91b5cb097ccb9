"""Return and risk metrics per ticker."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.finance import annualized, drawdown
from tidemark.operators.row_groups import MAX_ROWS, RowGroups, group_rows, running_max, running_sum
from tidemark.plans.staging import price_groups, with_returns

MONTH_ROWS = 21
QUARTER_ROWS = 63

RETURN_COLUMNS = [
    "ticker",
    "company_name",
    "sector",
    "market_index",
    "trade_date",
    "price_open",
    "price_high",
    "price_low",
    "price_close",
    "price_adj_close",
    "volume",
    "dividends",
    "has_corporate_event",
    "log_return_daily",
    "cumulative_return_index",
    "volatility_21d_annualized",
    "volatility_63d_annualized",
    "running_peak",
    "drawdown_from_peak",
    "avg_volume_21d",
]


def valid_returns(quotes: RowGroups) -> DataFrame:
    """Quotes with a return."""
    log_return = F.col("log_return_daily")
    # Filling in changes no value here: it tells the planner that none is NULL
    # any more, which makes the sliding frames a third cheaper.
    return (
        with_returns(quotes)
        .filter(log_return.isNotNull())
        .withColumn("log_return_daily", F.coalesce(log_return, F.lit(0.0)))
    )


def with_metrics(groups: RowGroups) -> DataFrame:
    """Returns with the metrics over sliding frames and the running values of the groups."""
    month, quarter = groups.trailing(MONTH_ROWS), groups.trailing(QUARTER_ROWS)
    deviation = F.stddev_samp("log_return_daily")
    metrics = groups.with_windows(
        {
            "volatility_21d_annualized": annualized(deviation.over(month)),
            "volatility_63d_annualized": annualized(deviation.over(quarter)),
            "avg_volume_21d": F.avg("volume").over(month),
        }
    )
    return groups.finish(metrics)


def return_columns(metrics: DataFrame) -> DataFrame:
    """The model's columns, from the running sum of returns and the running peak."""
    peak = F.col("running_peak")
    return (
        metrics.withColumn("cumulative_return_index", F.exp("total_return"))
        .withColumn("drawdown_from_peak", drawdown(F.col("price_adj_close"), peak))
        .select(*RETURN_COLUMNS)
    )


def int_market_returns(raw: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """Quotes with a return, and the metrics over the rows that have one.

    Rows without a return leave before the frames are laid, so the first quote
    of a ticker takes no part in its running peak.
    """
    quotes = price_groups(raw, max_rows)
    groups = group_rows(
        valid_returns(quotes),
        ["ticker"],
        "trade_date",
        lookback=QUARTER_ROWS - 1,
        runs={
            "total_return": running_sum(F.col("log_return_daily")),
            "running_peak": running_max(F.col("price_adj_close")),
        },
        # Returns are fewer than quotes: small tickers have stayed small.
        max_rows=max_rows if quotes.is_split else None,
        counted=valid_returns(quotes.of_large_keys()) if quotes.is_split else None,
    )
    return return_columns(with_metrics(groups))

"""Staging, returns and the stock mart."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.fill import forward_fill
from tidemark.operators.rolling import with_rolling_metrics
from tidemark.plans.macro import int_macro_pivoted
from tidemark.plans.market import int_market_returns
from tidemark.plans.marts import mart_stock_performance
from tidemark.plans.snapshot import ticker_metadata as distinct_metadata
from tidemark.plans.staging import stg_bacen_series, typed_prices
from tidemark.plans.staging import stg_market_prices as staged_prices
from tidemark.session import materialize
from workload import fixtures as fx
from workload.oracle_parts import FX_PRICES, MACRO, RETURNS, STG_PRICES
from workload.registry import query, rounded, with_rounded

RUN_TS = "2024-01-01 07:00:00"
# Small enough to cut every ticker of the test tables into several chunks.
SPLIT_ROWS = 300

RETURN_METRICS = [
    "log_return_daily",
    "cumulative_return_index",
    "volatility_21d_annualized",
    "volatility_63d_annualized",
    "avg_volume_21d",
]


def _staged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staged_prices(fx.market_prices(spark, sf_dir))


def _returns(spark: SparkSession, sf_dir: str, **options: int) -> DataFrame:
    return with_rounded(
        int_market_returns(fx.market_prices(spark, sf_dir), **options), *RETURN_METRICS
    )


def _stock_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    macro = int_macro_pivoted(stg_bacen_series(fx.bacen_series(spark, sf_dir)))
    returns = int_market_returns(fx.market_prices(spark, sf_dir))
    return mart_stock_performance(returns, materialize(macro, "macro"), RUN_TS)


@query(f"""with {STG_PRICES}
select * replace (round(log_return_daily, 6) + cast(0 as double) as log_return_daily) from prices""")
def stg_market_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_rounded(_staged(spark, sf_dir), "log_return_daily").drop("ingested_at")


@query(f"""with {STG_PRICES}
select ticker, trade_date, round(log_return_daily, 6) + cast(0 as double) as log_return_daily
from prices""")
def log_return(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_rounded(_staged(spark, sf_dir), "log_return_daily").select(
        "ticker", "trade_date", "log_return_daily"
    )


@query(f"""with {STG_PRICES}
select ticker, trade_date, dividends, stock_splits from prices where has_corporate_event""")
def corporate_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _staged(spark, sf_dir).filter("has_corporate_event")
    return events.select("ticker", "trade_date", "dividends", "stock_splits")


@query(f"with {RETURNS} select ticker, trade_date, cumulative_return_index from returns")
def cumulative_return(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _returns(spark, sf_dir).select("ticker", "trade_date", "cumulative_return_index")


@query(f"""with {RETURNS}
select ticker, trade_date, volatility_21d_annualized, volatility_63d_annualized from returns""")
def rolling_volatility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _returns(spark, sf_dir).select(
        "ticker", "trade_date", "volatility_21d_annualized", "volatility_63d_annualized"
    )


@query(f"with {RETURNS} select ticker, trade_date, running_peak, drawdown_from_peak from returns")
def drawdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _returns(spark, sf_dir).select(
        "ticker", "trade_date", "running_peak", "drawdown_from_peak"
    )


@query(f"with {RETURNS} select ticker, trade_date, avg_volume_21d from returns")
def avg_volume_21d(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _returns(spark, sf_dir).select("ticker", "trade_date", "avg_volume_21d")


@query(f"with {RETURNS} select * exclude (vol_21) from returns")
def market_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _returns(spark, sf_dir)


@query(f"with {RETURNS} select * exclude (vol_21) from returns")
def market_returns_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with every ticker cut into chunks, as for hot tickers."""
    return _returns(spark, sf_dir, max_rows=SPLIT_ROWS)


@query(f"""with {RETURNS}, {MACRO}
select ticker, trade_date, cdi_rate,
       round(vol_21 - coalesce(cdi_rate, 0) / 100, 6) + cast(0 as double) as risk_premium_vs_cdi
from returns left join macro on trade_date = macro_date""")
def risk_premium(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stock_mart(spark, sf_dir).select(
        "ticker", "trade_date", "cdi_rate", rounded("risk_premium_vs_cdi").alias("risk_premium_vs_cdi")
    )


MART_STOCK = f"""with {RETURNS}, {MACRO}
select ticker, trade_date, company_name, sector, market_index, price_open, price_high, price_low,
       price_close, price_adj_close, volume, avg_volume_21d, has_corporate_event, dividends,
       log_return_daily, cumulative_return_index, volatility_21d_annualized,
       volatility_63d_annualized, drawdown_from_peak, running_peak, selic_rate, usd_brl_rate,
       cdi_rate, ipca_monthly_pct,
       round(vol_21 - coalesce(cdi_rate, 0) / 100, 6) + cast(0 as double) as risk_premium_vs_cdi
from returns left join macro on trade_date = macro_date"""


@query(MART_STOCK)
def mart_stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    mart = with_rounded(_stock_mart(spark, sf_dir), *RETURN_METRICS, "risk_premium_vs_cdi")
    return mart.drop("dbt_updated_at")


_ROLLING = ", ".join(
    f"round({fn}(log_return_daily) over (partition by ticker order by trade_date "
    f"rows {n - 1} preceding), 6) + cast(0 as double) as {fn}_log_return_daily_{n}d"
    for n in (21, 63, 252)
    for fn in ("avg", "stddev")
)


@query(f"with {STG_PRICES} select ticker, trade_date, {_ROLLING} from prices")
def rolling_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    prices = _staged(spark, sf_dir).select("ticker", "trade_date", "log_return_daily")
    metrics = with_rolling_metrics(
        prices, "log_return_daily", "ticker", "trade_date", [21, 63, 252], ["avg", "stddev"]
    ).drop("log_return_daily")
    return with_rounded(metrics, *metrics.columns[2:])


_LINEAR_SIZES, _LINEAR = (5, 63, 252, 500), ("sum", "min", "max", "count", "avg", "stddev")
_ROLLING_LINEAR = ", ".join(
    f"round({fn}(level) over (partition by ticker order by date "
    f"rows {n - 1} preceding), 6) + cast(0 as double) as {fn}_level_{n}d"
    for n in _LINEAR_SIZES
    for fn in _LINEAR
)


@query(f"""with {FX_PRICES},
levels as (
  select ticker, date, case when dividends > 0 and close > 0 then ln(close) end as level
  from fx_market_prices
)
select ticker, date, {_ROLLING_LINEAR} from levels""")
def rolling_metrics_linear(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long frames over a column with gaps, in two passes; tickers cut into chunks."""
    paying = (F.col("dividends") > 0) & (F.col("close") > 0)
    rows = fx.market_prices(spark, sf_dir).select(
        "ticker", "date", F.when(paying, F.ln("close")).alias("level")
    )
    metrics = with_rolling_metrics(
        rows, "level", "ticker", "date", _LINEAR_SIZES, _LINEAR, max_rows=SPLIT_ROWS, linear=True
    ).drop("level")
    return with_rounded(metrics, *metrics.columns[2:])


@query("""
select o_custkey, o_orderkey,
       round(avg(o_totalprice) over three, 6) as avg_o_totalprice_3d,
       round(avg(o_totalprice) over ten, 6) as avg_o_totalprice_10d
from orders
window three as (partition by o_custkey order by o_orderkey rows 2 preceding),
       ten as (partition by o_custkey order by o_orderkey rows 9 preceding)""")
def rolling_metrics_by_key_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole number as order column, and keys cut into chunks of a few rows."""
    orders = fx.table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    metrics = with_rolling_metrics(
        orders, "o_totalprice", "o_custkey", "o_orderkey", [3, 10], ["avg"], max_rows=5
    ).drop("o_totalprice")
    return with_rounded(metrics, *metrics.columns[2:])


_FILL = f"""with {FX_PRICES}
select ticker, date,
       last_value(dividends ignore nulls) over (
         partition by ticker order by date rows unbounded preceding) as dividends
from fx_market_prices"""


@query(_FILL)
def forward_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.market_prices(spark, sf_dir).select("ticker", "date", "dividends")
    return forward_fill(rows, ["ticker"], "date", ["dividends"])


@query(_FILL)
def forward_filled_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.market_prices(spark, sf_dir).select("ticker", "date", "dividends")
    return forward_fill(rows, ["ticker"], "date", ["dividends"], max_rows=SPLIT_ROWS)


@query(f"""with {STG_PRICES}
select distinct ticker, company_name, sector, market_index from prices""")
def ticker_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    prices = typed_prices(fx.market_prices(spark, sf_dir))
    return distinct_metadata(prices, RUN_TS).drop("updated_at")

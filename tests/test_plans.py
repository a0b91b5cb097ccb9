"""Physical plans: what is read, shuffled and broadcast."""

import re

import pytest
from rows import day, observation, prices, quote, series

from tidemark.plans.macro import int_macro_pivoted
from tidemark.plans.market import int_market_returns
from tidemark.plans.marts import mart_stock_performance
from tidemark.plans.staging import stg_bacen_series, stg_market_prices
from tidemark.session import materialize


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def count(pattern: str, text: str) -> int:
    return len(re.findall(pattern, text))


@pytest.fixture(scope="module")
def raw(spark):
    return materialize(prices(spark, [quote("A", n, 10.0 + n) for n in range(5)]), "plan-prices")


@pytest.fixture(scope="module")
def raw_series(spark):
    rows = [observation("selic_rate", day(n), 10.0) for n in range(5)]
    return materialize(series(spark, rows), "plan-series")


def test_returns_take_one_exchange_and_one_sort(raw):
    text = plan(int_market_returns(raw))
    assert count("Exchange hashpartitioning", text) == 1
    assert count(r"\bSort \[", text) == 1
    assert count(r"Window \[", text) == 2


def test_filter_on_close_reaches_the_scan(raw):
    assert "PushedFilters: [IsNotNull(close), GreaterThan(close,0.0)]" in plan(stg_market_prices(raw))


def test_filter_on_ticker_passes_the_windows(raw):
    text = plan(int_market_returns(raw).filter("ticker = 'A'"))
    assert "EqualTo(ticker,A)" in text


def test_filter_on_date_stays_above_the_windows(raw):
    text = plan(int_market_returns(raw).filter("trade_date > date'2024-01-03'"))
    assert "GreaterThan(date" not in text


def test_only_used_columns_are_read(raw):
    text = plan(int_market_returns(raw).select("ticker", "drawdown_from_peak"))
    assert "ReadSchema: struct<ticker:string,date:date,close:double,adj_close:double>" in text


def test_unused_return_needs_no_window(raw):
    text = plan(stg_market_prices(raw).select("ticker", "price_close"))
    assert "Window" not in text and "Exchange" not in text


def test_stock_mart_broadcasts_the_stored_macro_table(raw, raw_series):
    macro = materialize(int_macro_pivoted(stg_bacen_series(raw_series)), "plan-macro")
    text = plan(mart_stock_performance(int_market_returns(raw), macro, "2024-01-01 00:00:00"))
    assert "BroadcastHashJoin" in text
    assert count("Exchange hashpartitioning", text) == 1


def test_macro_table_beyond_the_threshold_is_not_broadcast(spark, raw, raw_series):
    macro = materialize(int_macro_pivoted(stg_bacen_series(raw_series)), "plan-macro")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        mart = mart_stock_performance(int_market_returns(raw), macro, "2024-01-01 00:00:00")
        assert "SortMergeJoin" in plan(mart)
        assert mart.count() == 4
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_macro_pivot_is_one_scan_without_a_join(raw_series):
    text = plan(int_macro_pivoted(stg_bacen_series(raw_series)))
    assert count("FileScan", text) == 1
    assert "Join" not in text
    assert text.index("partial_max") > 0

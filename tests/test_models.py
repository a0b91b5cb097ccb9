"""Hand-made rows for the first days, gaps, zeros and missing values."""

import datetime as dt
import math

import pytest
from rows import day, observation, prices, quote, series

from tidemark.plans.macro import int_macro_pivoted, mart_macro_indicators
from tidemark.plans.market import int_market_returns
from tidemark.plans.marts import STOCK_COLUMNS, mart_stock_performance
from tidemark.plans.staging import stg_bacen_series, stg_market_prices

RUN_TS = "2024-02-01 07:00:00"


def returns_of(spark, rows):
    return int_market_returns(prices(spark, rows)).orderBy("ticker", "trade_date").collect()


def staged(spark, rows):
    return stg_market_prices(prices(spark, rows)).orderBy("ticker", "trade_date").collect()


def test_first_day_has_no_return(spark):
    rows = [quote("A", 0, 10.0)]
    assert staged(spark, rows)[0].log_return_daily is None
    assert returns_of(spark, rows) == []


def test_second_day(spark):
    (row,) = returns_of(spark, [quote("A", 0, 10.0), quote("A", 1, 12.0)])
    assert row.log_return_daily == pytest.approx(math.log(1.2))
    assert row.cumulative_return_index == pytest.approx(1.2)
    assert row.volatility_21d_annualized is None
    assert row.running_peak == 12.0
    assert row.drawdown_from_peak == 0.0
    assert row.avg_volume_21d == 100.0


def test_index_is_price_over_first_price(spark):
    values = [10.0, 12.0, 9.0, 15.0, 11.0]
    rows = returns_of(spark, [quote("A", n, v) for n, v in enumerate(values)])
    assert [r.cumulative_return_index for r in rows] == pytest.approx([v / 10 for v in values[1:]])


def test_first_price_is_no_peak(spark):
    """The first quote leaves before the frames are laid."""
    rows = returns_of(spark, [quote("A", 0, 50.0), quote("A", 1, 20.0), quote("A", 2, 10.0)])
    assert [r.running_peak for r in rows] == [20.0, 20.0]
    assert [r.drawdown_from_peak for r in rows] == [0.0, -0.5]


@pytest.mark.parametrize("close", [None, 0.0, -1.0])
def test_day_without_close_is_bridged(spark, close):
    rows = [quote("A", 0, 10.0), quote("A", 1, 99.0, close=close), quote("A", 2, 20.0)]
    (row,) = returns_of(spark, rows)
    assert row.trade_date == day(2)
    assert row.log_return_daily == pytest.approx(math.log(2))


def test_missing_adjusted_close_costs_two_days(spark):
    rows = [quote("A", 0, 10.0), quote("A", 1, None), quote("A", 2, 20.0), quote("A", 3, 40.0)]
    (row,) = returns_of(spark, rows)
    assert row.trade_date == day(3)


def test_zero_adjusted_close_is_no_error(spark):
    rows = [quote("A", 0, 0.0), quote("A", 1, 10.0)]
    assert [r.log_return_daily for r in staged(spark, rows)] == [None, None]


def test_tickers_do_not_mix(spark):
    rows = [quote("A", 0, 10.0), quote("B", 1, 20.0), quote("A", 2, 30.0)]
    assert [(r.ticker, r.running_peak) for r in returns_of(spark, rows)] == [("A", 30.0)]


def test_event_flag_is_never_null(spark):
    rows = [
        quote("A", 0, 1.0, dividends=None, stock_splits=0.0),
        quote("A", 1, 1.0, dividends=0.5, stock_splits=None),
        quote("A", 2, 1.0, dividends=None, stock_splits=2.0),
    ]
    assert [r.has_corporate_event for r in staged(spark, rows)] == [False, True, True]


def test_impossible_rates_are_dropped(spark):
    rows = [
        observation("selic_rate", day(0), -1.0),
        observation("cdi_rate", day(0), 0.0),
        observation("ipca_inflation", day(0), -1.0),
        observation("usd_brl_rate", day(0), 5.0),
        observation("usd_brl_rate", day(1), None),
    ]
    kept = stg_bacen_series(series(spark, rows)).collect()
    assert {(r.series_name, r.series_value) for r in kept} == {
        ("ipca_inflation", -1.0),
        ("usd_brl_rate", 5.0),
    }


def macro_of(spark, rows):
    return int_macro_pivoted(stg_bacen_series(series(spark, rows)))


def test_monthly_value_is_on_every_day_of_its_month(spark):
    rows = [observation("selic_rate", dt.date(2024, 1, d), 10.0) for d in (2, 15, 31)]
    rows += [observation("selic_rate", dt.date(2024, 2, 1), 10.0)]
    rows += [observation("ipca_inflation", dt.date(2024, 1, 1), 0.5)]
    found = macro_of(spark, rows).orderBy("macro_date").collect()
    assert [r.ipca_monthly_pct for r in found] == [0.5, 0.5, 0.5, None]


def test_largest_of_several_monthly_values(spark):
    rows = [
        observation("selic_rate", dt.date(2024, 1, 2), 10.0),
        observation("ipca_inflation", dt.date(2024, 1, 1), 0.5),
        observation("ipca_inflation", dt.date(2024, 1, 20), 0.7),
    ]
    (row,) = macro_of(spark, rows).collect()
    assert row.ipca_monthly_pct == 0.7


def test_day_without_policy_rate(spark):
    rows = [
        observation("usd_brl_rate", day(0), 5.0),
        observation("selic_rate", day(1), 10.0),
    ]
    macro = macro_of(spark, rows)
    flags = {r.macro_date: r.is_bacen_business_day for r in macro.collect()}
    assert flags == {day(0): False, day(1): True}
    assert [r.macro_date for r in mart_macro_indicators(macro, RUN_TS).collect()] == [day(1)]


def test_missing_inflation_counts_as_none(spark):
    rows = [observation("selic_rate", dt.date(2024, m, 1), 10.0) for m in (1, 2)]
    rows += [observation("ipca_inflation", dt.date(2024, 1, 1), 1.0)]
    mart = mart_macro_indicators(macro_of(spark, rows), RUN_TS).orderBy("macro_date").collect()
    assert [r.ipca_accumulated_12m_pct for r in mart] == pytest.approx([1.0, 1.0])


def test_currency_change_counts_business_days(spark):
    rows = [observation("selic_rate", day(n), 10.0) for n in range(23)]
    rows += [observation("usd_brl_rate", day(n), 5.0 + n) for n in range(23)]
    mart = mart_macro_indicators(macro_of(spark, rows), RUN_TS).orderBy("macro_date").collect()
    assert [r.usd_brl_monthly_change_pct for r in mart[:21]] == [None] * 21
    assert mart[21].usd_brl_monthly_change_pct == pytest.approx((26 / 5 - 1) * 100)
    assert mart[22].usd_brl_monthly_change_pct == pytest.approx((27 / 6 - 1) * 100)


def test_stock_mart_keeps_days_without_macro(spark):
    returns = int_market_returns(
        prices(spark, [quote("A", n, 10.0 + n) for n in range(4)])
    )
    macro = macro_of(
        spark, [observation("selic_rate", day(2), 9.0), observation("cdi_rate", day(2), 50.0)]
    )
    mart = mart_stock_performance(returns, macro, RUN_TS)
    assert mart.columns == STOCK_COLUMNS
    rows = mart.orderBy("trade_date").collect()
    assert [r.selic_rate for r in rows] == [None, 9.0, None]
    assert rows[0].risk_premium_vs_cdi is None
    assert rows[1].risk_premium_vs_cdi == pytest.approx(rows[1].volatility_21d_annualized - 0.5)
    assert rows[2].risk_premium_vs_cdi == rows[2].volatility_21d_annualized
    assert rows[0].dbt_updated_at == dt.datetime(2024, 2, 1, 7)

"""Return, risk and compounding expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TRADING_DAYS_PER_YEAR = 252


def zero_safe_ratio(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator``, NULL where the denominator is zero."""
    return numerator / F.nullif(denominator, F.lit(0.0))


def log_return(price: Column, previous: Column) -> Column:
    """Natural log of the price ratio; NULL without a usable previous price."""
    return F.ln(zero_safe_ratio(price, previous))


def annualized(daily_deviation: Column) -> Column:
    """Yearly volatility from a daily standard deviation."""
    return daily_deviation * F.sqrt(F.lit(TRADING_DAYS_PER_YEAR))


def drawdown(price: Column, peak: Column) -> Column:
    """Relative distance below the peak, 0 at a new high."""
    return zero_safe_ratio(price, peak) - 1


def growth_log(rate_pct: Column) -> Column:
    """Log growth of one period, a missing rate counting as no growth."""
    return F.ln(1 + F.coalesce(rate_pct, F.lit(0.0)) / 100)


def compounded_pct(log_growth: Column) -> Column:
    """Percentage growth from summed log growth."""
    return (F.exp(log_growth) - 1) * 100


def change_pct(value: Column, previous: Column) -> Column:
    """Percentage change, NULL where the base is zero or missing."""
    return (zero_safe_ratio(value, previous) - 1) * 100


def corporate_event(dividends: Column, stock_splits: Column) -> Column:
    """True on days with a dividend or a split, never NULL."""
    return F.coalesce((dividends > 0) | (stock_splits != 0), F.lit(False))


def risk_premium(volatility: Column, policy_rate_pct: Column) -> Column:
    """Volatility above a percentage rate, a missing rate counting as zero."""
    return volatility - F.coalesce(policy_rate_pct, F.lit(0.0)) / 100

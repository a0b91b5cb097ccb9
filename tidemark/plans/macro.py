"""Macro series from long to wide, and the macro mart."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.finance import change_pct, compounded_pct, growth_log
from tidemark.functions.keys import run_stamp
from tidemark.operators.row_groups import MAX_ROWS, group_rows

# Output column by series name.
DAILY_COLUMNS = {
    "selic_rate": "selic_rate",
    "usd_brl_rate": "usd_brl_rate",
    "cdi_rate": "cdi_rate",
}
MONTHLY_COLUMNS = {
    "ipca_inflation": "ipca_monthly_pct",
    "igpm_inflation": "igpm_monthly_pct",
    "real_interest_rate": "real_interest_rate",
}

YEAR_ROWS = 365
MONTH_ROWS = 21


def _wide(frequency: str, columns: dict[str, str]) -> list[Column]:
    of_frequency = F.col("frequency") == frequency
    return [
        F.max(F.when(of_frequency & (F.col("series_name") == name), F.col("series_value"))).alias(out)
        for name, out in columns.items()
    ]


def daily_pivot(series: DataFrame) -> DataFrame:
    """One row per date of the daily series, one column per series."""
    return (
        series.filter(F.col("frequency") == "daily")
        .groupBy(F.col("reference_date").alias("macro_date"))
        .agg(*_wide("daily", DAILY_COLUMNS))
    )


def monthly_pivot(series: DataFrame) -> DataFrame:
    """One row per month of the monthly series, the largest value per month."""
    return (
        series.filter(F.col("frequency") == "monthly")
        .groupBy(F.trunc("reference_date", "month").alias("month_date"))
        .agg(*_wide("monthly", MONTHLY_COLUMNS))
    )


def int_macro_pivoted(series: DataFrame) -> DataFrame:
    """Daily series by date, with the values of the month on each of its days.

    One scan and one aggregate by date serve both frequencies. What remains is
    one row per date, so spreading a month over its days is a window over at
    most 31 rows instead of a join.
    """
    month = Window.partitionBy(F.trunc("macro_date", "month"))
    by_date = series.groupBy(F.col("reference_date").alias("macro_date")).agg(
        *_wide("daily", DAILY_COLUMNS),
        *_wide("monthly", MONTHLY_COLUMNS),
        F.max(F.col("frequency") == "daily").alias("_has_daily"),
    )
    spread = {out: F.max(out).over(month) for out in MONTHLY_COLUMNS.values()}
    return (
        by_date.withColumns(spread)
        .filter("_has_daily")
        .select(
            "macro_date",
            *DAILY_COLUMNS.values(),
            *MONTHLY_COLUMNS.values(),
            F.col("selic_rate").isNotNull().alias("is_bacen_business_day"),
        )
    )


def mart_macro_indicators(
    macro: DataFrame, run_ts: dt.datetime | str, max_rows: int = MAX_ROWS
) -> DataFrame:
    """Business days with accumulated inflation and currency change.

    Frames count rows: 365 business days of daily repeated monthly inflation,
    and the currency rate 21 business days back.
    """
    groups = group_rows(
        macro.filter("is_bacen_business_day"),
        [],
        "macro_date",
        lookback=YEAR_ROWS - 1,
        max_rows=max_rows,
    )
    year_growth = F.sum(growth_log(F.col("ipca_monthly_pct"))).over(groups.trailing(YEAR_ROWS))
    month_ago = F.lag("usd_brl_rate", MONTH_ROWS).over(groups.window)
    return groups.finish(
        groups.rows.withColumns(
            {
                "ipca_accumulated_12m_pct": compounded_pct(year_growth),
                "usd_brl_monthly_change_pct": change_pct(F.col("usd_brl_rate"), month_ago),
                "dbt_updated_at": run_stamp(run_ts),
            }
        )
    )


def inflation_by_month(macro: DataFrame) -> DataFrame:
    """Optional reading of the 12 month figure: twelve monthly rates, compounded.

    Months without any rate count as no growth. The window has no key, but one
    row per month.
    """
    months = macro.groupBy(F.trunc("macro_date", "month").alias("month_date")).agg(
        F.max("ipca_monthly_pct").alias("ipca_monthly_pct")
    )
    number = F.year("month_date") * 12 + F.month("month_date")
    twelve = Window.orderBy(number).rangeBetween(-11, Window.currentRow)
    return months.select(
        "month_date",
        compounded_pct(F.sum(growth_log(F.col("ipca_monthly_pct"))).over(twelve)).alias(
            "ipca_12_months_pct"
        ),
    )

"""Macro staging, pivots and the macro mart."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.plans import macro as models
from tidemark.plans.staging import stg_bacen_series
from tidemark.session import materialize
from workload import fixtures as fx
from workload.market_queries import RUN_TS, SPLIT_ROWS
from workload.oracle_parts import MACRO, MACRO_MART, STG_SERIES
from workload.registry import query, with_rounded


def _series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stg_bacen_series(fx.bacen_series(spark, sf_dir))


def _mart(spark: SparkSession, sf_dir: str, **options: int) -> DataFrame:
    macro = materialize(models.int_macro_pivoted(_series(spark, sf_dir)), "macro")
    mart = models.mart_macro_indicators(macro, RUN_TS, **options).drop("dbt_updated_at")
    return with_rounded(mart, "ipca_accumulated_12m_pct", "usd_brl_monthly_change_pct")


@query(f"with {STG_SERIES} select * from series")
def stg_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _series(spark, sf_dir).drop("ingested_at")


@query(f"with {MACRO} select * from days")
def macro_daily_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.daily_pivot(_series(spark, sf_dir))


@query(f"with {MACRO} select * from months")
def macro_monthly_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.monthly_pivot(_series(spark, sf_dir))


@query(f"with {MACRO} select * from macro")
def macro_pivoted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.int_macro_pivoted(_series(spark, sf_dir))


@query(f"with {MACRO_MART} select macro_date, ipca_accumulated_12m_pct from macro_mart")
def inflation_12m(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mart(spark, sf_dir).select("macro_date", "ipca_accumulated_12m_pct")


@query(f"with {MACRO_MART} select macro_date, usd_brl_monthly_change_pct from macro_mart")
def fx_change_21(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mart(spark, sf_dir).select("macro_date", "usd_brl_monthly_change_pct")


@query(f"with {MACRO_MART} select * from macro_mart")
def mart_macro(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mart(spark, sf_dir)


@query(f"with {MACRO_MART} select * from macro_mart")
def mart_macro_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with the one series cut into chunks shorter than its frames."""
    return _mart(spark, sf_dir, max_rows=SPLIT_ROWS)


@query(f"""with {MACRO},
rates as (
  select cast(date_trunc('month', macro_date) as date) as month_date,
         max(ipca_monthly_pct) as rate
  from macro group by 1
)
select a.month_date,
       round((exp(sum(ln(1 + coalesce(b.rate, 0) / 100))) - 1) * 100, 6) + cast(0 as double)
         as ipca_12_months_pct
from rates a join rates b
  on b.month_date between a.month_date - interval '11 months' and a.month_date
group by a.month_date""")
def inflation_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    macro = materialize(models.int_macro_pivoted(_series(spark, sf_dir)), "macro")
    return with_rounded(models.inflation_by_month(macro), "ipca_12_months_pct")

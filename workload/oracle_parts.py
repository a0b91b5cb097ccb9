"""Common table expressions shared by the SQL counterparts."""

FX_PRICES = """
fx_bars as (
  select p_brand as ticker, cast(l_shipdate as date) as d, l_extendedprice / l_quantity as px,
         l_quantity, l_discount, l_tax, l_returnflag,
         row_number() over (partition by p_brand, cast(l_shipdate as date)
           order by l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
                    l_quantity, l_discount, l_tax, l_returnflag, l_linestatus) as k
  from lineitem join part on l_partkey = p_partkey
),
fx_market_prices as (
  select ticker, concat('Company ', ticker) as company,
         concat('Sector ', right(ticker, 1)) as sector,
         case when right(ticker, 1) in ('1', '3') then 'IDX_A' else 'IDX_B' end as market_index,
         d as date, min_by(px, k) as open, max(px) as high, min(px) as low, max_by(px, k) as close,
         max_by(px * (1 - l_discount), k) as adj_close,
         cast(sum(l_quantity) as bigint) as volume,
         max(case when l_tax >= 0.08 then l_tax when l_tax > 0 then 0.0 end) as dividends,
         cast(max(case when l_returnflag = 'R' and k >= 2 then 2 else 0 end) as double) as stock_splits
  from fx_bars group by ticker, d
)"""

_SERIES = [
    (11, "selic_rate", "daily", "pct_per_year", "o_orderpriority = '1-URGENT'", 10000),
    (1, "usd_brl_rate", "daily", "brl_per_usd", "o_orderpriority = '2-HIGH'", 100000),
    (4189, "cdi_rate", "daily", "pct_per_year", "o_orderpriority = '3-MEDIUM'", 10000),
    (433, "ipca_inflation", "monthly", "pct_change", "o_orderpriority = '4-NOT SPECIFIED'", 1000000),
    (189, "igpm_inflation", "monthly", "pct_change", "o_orderpriority = '5-LOW'", 1000000),
    (7811, "real_interest_rate", "monthly", "pct_per_year", "o_orderstatus = 'P'", 1000000),
]


def _series(code: int, name: str, frequency: str, unit: str, condition: str, scale: int) -> str:
    day = "cast(o_orderdate as date)"
    if frequency == "monthly":
        day = "cast(date_trunc('month', o_orderdate) as date)"
    return f"""
  select cast({code} as integer) as series_code, '{name}' as series_name,
         '{frequency}' as frequency, '{unit}' as unit, {day} as date,
         min(o_totalprice) / {scale} as value
  from orders where {condition} group by {day}"""


FX_SERIES = "\nfx_bacen_series as (" + "\n  union all".join(_series(*s) for s in _SERIES) + "\n)"

STG_PRICES = f"""{FX_PRICES},
price_steps as (
  select *, adj_close / nullif(lag(adj_close) over (partition by ticker order by date), 0) as step
  from fx_market_prices where close > 0
),
prices as (
  select ticker, company as company_name, sector, market_index, date as trade_date,
         open as price_open, high as price_high, low as price_low, close as price_close,
         adj_close as price_adj_close, volume,
         coalesce(dividends, 0.0) as dividends, coalesce(stock_splits, 0.0) as stock_splits,
         case when step > 0 then ln(step) end as log_return_daily,
         coalesce(dividends, 0.0) > 0 or coalesce(stock_splits, 0.0) <> 0 as has_corporate_event
  from price_steps
)"""

RETURNS = f"""{STG_PRICES},
measured as (
  select *,
         exp(sum(log_return_daily) over life) as growth,
         stddev_samp(log_return_daily) over month * sqrt(252) as vol_21,
         stddev_samp(log_return_daily) over quarter * sqrt(252) as vol_63,
         max(price_adj_close) over life as peak,
         avg(volume) over month as mean_volume
  from prices where log_return_daily is not null
  window life as (partition by ticker order by trade_date rows unbounded preceding),
         month as (partition by ticker order by trade_date rows 20 preceding),
         quarter as (partition by ticker order by trade_date rows 62 preceding)
),
returns as (
  select ticker, company_name, sector, market_index, trade_date,
         price_open, price_high, price_low, price_close, price_adj_close, volume, dividends,
         has_corporate_event,
         round(log_return_daily, 6) + cast(0 as double) as log_return_daily,
         round(growth, 6) + cast(0 as double) as cumulative_return_index,
         round(vol_21, 6) + cast(0 as double) as volatility_21d_annualized,
         round(vol_63, 6) + cast(0 as double) as volatility_63d_annualized,
         peak as running_peak,
         price_adj_close / nullif(peak, 0) - 1 as drawdown_from_peak,
         round(mean_volume, 6) + cast(0 as double) as avg_volume_21d,
         vol_21
  from measured
)"""

STG_SERIES = f"""{FX_SERIES},
series as (
  select series_code, series_name, frequency, unit, date as reference_date, value as series_value
  from fx_bacen_series
  where date is not null and value is not null
    and (value > 0 or series_name not in ('usd_brl_rate', 'selic_rate', 'cdi_rate'))
)"""

MACRO = f"""{STG_SERIES},
days as (
  select reference_date as macro_date,
         max(series_value) filter (where series_name = 'selic_rate') as selic_rate,
         max(series_value) filter (where series_name = 'usd_brl_rate') as usd_brl_rate,
         max(series_value) filter (where series_name = 'cdi_rate') as cdi_rate
  from series where frequency = 'daily' group by reference_date
),
months as (
  select cast(date_trunc('month', reference_date) as date) as month_date,
         max(series_value) filter (where series_name = 'ipca_inflation') as ipca_monthly_pct,
         max(series_value) filter (where series_name = 'igpm_inflation') as igpm_monthly_pct,
         max(series_value) filter (where series_name = 'real_interest_rate') as real_interest_rate
  from series where frequency = 'monthly' group by 1
),
macro as (
  select macro_date, selic_rate, usd_brl_rate, cdi_rate,
         ipca_monthly_pct, igpm_monthly_pct, real_interest_rate,
         selic_rate is not null as is_bacen_business_day
  from days left join months on cast(date_trunc('month', macro_date) as date) = month_date
)"""

MACRO_MART = f"""{MACRO},
macro_measured as (
  select *,
         (exp(sum(ln(1 + coalesce(ipca_monthly_pct, 0) / 100)) over (
            order by macro_date rows 364 preceding)) - 1) * 100 as inflation,
         (usd_brl_rate / nullif(lag(usd_brl_rate, 21) over (order by macro_date), 0) - 1) * 100
           as fx_change
  from macro where is_bacen_business_day
),
macro_mart as (
  select macro_date, selic_rate, usd_brl_rate, cdi_rate,
         ipca_monthly_pct, igpm_monthly_pct, real_interest_rate, is_bacen_business_day,
         round(inflation, 6) + cast(0 as double) as ipca_accumulated_12m_pct,
         round(fx_change, 6) + cast(0 as double) as usd_brl_monthly_change_pct
  from macro_measured
)"""

META = """
meta_v1 as (
  select c_custkey as ticker, c_name as company_name, c_mktsegment as sector,
         concat('N', cast(c_nationkey as varchar)) as market_index
  from customer where c_nationkey <> 0
),
meta_v2 as (
  select c_custkey as ticker, c_name as company_name,
         case when c_nationkey < 6 then 'CHANGED' else c_mktsegment end as sector,
         case when c_nationkey <> 11 then concat('N', cast(c_nationkey as varchar)) end
           as market_index
  from customer where c_nationkey <> 7
)"""

"""Payloads, metadata lookups and the calendar."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.calendar import BRAZIL_HOLIDAYS, is_holiday, is_weekend
from tidemark.functions.keys import surrogate_key as hash_key
from tidemark.operators.upsert import PULLED_AT, known_values
from tidemark.plans.daily_run import Warehouse, hold_back
from tidemark.schemas import PRICES_SCHEMA
from tidemark.session import scratch_path
from tidemark.sources import calendar as cal
from tidemark.sources import payloads as pay
from tidemark.sources.tables import read_table
from tidemark.streaming.ingest import load_quote_files
from workload import fixtures as fx
from workload.oracle_parts import FX_PRICES
from workload.registry import query

RUN_TS = "2024-01-01 07:00:00"

# Tickers with metadata, so that both branches of the lookup are used.
_RENAMED = {"Brand#11": "PETR4", "Brand#22": "VALE3", "Brand#33": "MGLU3"}


# Series payloads: every order is a record, filed under its priority


CODES = {
    "1-URGENT": 11,
    "2-HIGH": 433,
    "3-MEDIUM": 1,
    "4-NOT SPECIFIED": 189,
    # Not a known series.
    "5-LOW": 99,
}


def series_landing(spark: SparkSession, sf_dir: str, bad_dates: Column) -> str:
    """Landed one-record payloads: day-first dates, decimal commas, some junk."""
    code = F.coalesce(*(F.when(F.col("o_orderpriority") == p, c) for p, c in CODES.items()))
    date = F.date_format("o_orderdate", "dd/MM/yyyy")
    number = F.replace(F.col("o_totalprice").cast("decimal(18,2)").cast("string"), F.lit("."), F.lit(","))
    record = F.struct(
        F.when(bad_dates, F.lit("n/d")).otherwise(date).alias("data"),
        F.when(F.col("o_totalprice") < 20_000, F.lit("n/d")).otherwise(number).alias("valor"),
    )
    path = scratch_path(spark, "series-landing")
    fx.table(spark, sf_dir, "orders").select(
        F.to_json(F.array(record)).alias("value"), code.alias("series_code")
    ).write.partitionBy("series_code").text(path)
    return path


def _case(column: str, values: dict[str, object]) -> str:
    whens = " ".join(f"when '{k}' then {v!r}" for k, v in values.items())
    return f"case {column} {whens} end"


SERIES_ROWS = f"""
records as (
  select {_case("o_orderpriority", CODES)} as series_code, cast(o_orderdate as date) as date,
         case when o_totalprice >= 20000 then cast(cast(o_totalprice as decimal(18,2)) as double) end
           as value,
         month(o_orderdate) = 12 and day(o_orderdate) = 31 as unreadable
  from orders
),
codes(series_code, series_name, frequency, unit) as (
  values {", ".join(repr(s) for s in pay.SERIES)}
)"""


@query(f"""with {SERIES_ROWS}
select cast(series_code as integer) as series_code, series_name, frequency, unit, date, value
from records join codes using (series_code)
where value is not null and date between date '1996-01-01' and date '2000-12-31'""")
def series_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing = series_landing(spark, sf_dir, F.lit(False))
    loaded = pay.parse_series(
        pay.read_series_payloads(spark, landing),
        RUN_TS,
        start=dt.date(1996, 1, 1),
        end=dt.date(2000, 12, 31),
    )
    return known_values(loaded.rows, "value").drop("ingested_at", PULLED_AT)


@query(f"""with {SERIES_ROWS}
select cast(series_code as integer) as series_code, count(*) as held_back,
       count(*) filter (where unreadable) as bad_dates
from records join codes using (series_code)
where series_code in (select series_code from records where unreadable and series_code <> 11)
group by series_code""")
def payload_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unreadable dates (New Year's Eve) hold back their whole series, and no other."""
    new_years_eve = (F.month("o_orderdate") == 12) & (F.dayofmonth("o_orderdate") == 31)
    bad = new_years_eve & (F.col("o_orderpriority") != "1-URGENT")
    landing = series_landing(spark, sf_dir, bad)
    records = pay.read_series_payloads(spark, landing)
    loaded = pay.parse_series(records, RUN_TS, held_back_by=["series_code"])
    return loaded.rejects.groupBy("series_code").agg(
        F.count(F.lit(1)).alias("held_back"), F.count_if(F.col("data") == "n/d").alias("bad_dates")
    )


# Quote payloads: a document per ticker and month


def _renamed(ticker: Column) -> Column:
    return F.coalesce(*(F.when(ticker == old, new) for old, new in _RENAMED.items()), ticker)


def land_quotes(prices: DataFrame) -> str:
    """Landed documents; a ticker has one quote a day, so 31 quotes at most in each."""
    quote = F.struct(
        (F.unix_date("date").cast("bigint") * 86_400 + 13 * 3_600).alias("date"),
        "open",
        "high",
        "low",
        "close",
        "volume",
        F.col("adj_close").alias("adjustedClose"),
    )
    documents = (
        prices.groupBy(_renamed(F.col("ticker")).alias("ticker"), F.trunc("date", "month").alias("month"))
        .agg(F.collect_list(quote).alias("historicalDataPrice"))
        .select(
            F.to_json(F.struct(F.array(F.struct("historicalDataPrice")).alias("results"))).alias("value"),
            "ticker",
        )
    )
    path = scratch_path(prices.sparkSession, "quote-landing")
    documents.write.partitionBy("ticker").text(path)
    return path


_TICKER = f"coalesce({_case('ticker', _RENAMED)}, ticker)"

_QUOTE_ROWS = f"""{FX_PRICES},
known(ticker, company, sector, market_index) as (
  values {", ".join(repr(t) for t in pay.TICKERS)}
),
quotes as (
  select {_TICKER} as ticker, date, open, high, low, close, adj_close, volume
  from fx_market_prices
),
loaded as (
  select q.ticker, coalesce(k.company, q.ticker) as company,
         coalesce(k.sector, 'Unknown') as sector,
         coalesce(k.market_index, 'Unknown') as market_index,
         date, open, high, low, close, adj_close, volume,
         cast(0 as double) as dividends, cast(0 as double) as stock_splits
  from quotes q left join known k on q.ticker = k.ticker
)"""


@query(f"with {_QUOTE_ROWS} select * from loaded where date >= date '1997-01-01'")
def quote_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    payloads = pay.read_quote_payloads(spark, land_quotes(fx.market_prices(spark, sf_dir)))
    return pay.parse_quotes(payloads, RUN_TS, start=dt.date(1997, 1, 1)).rows.drop(
        "ingested_at", PULLED_AT
    )


@query(f"""with {_QUOTE_ROWS}
select ticker, date, close from loaded where ticker in ('PETR4', 'Brand#12', 'Brand#55')""")
def quote_payload_tickers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the tickers of the parameter, whose folders alone are read."""
    payloads = pay.read_quote_payloads(spark, land_quotes(fx.market_prices(spark, sf_dir)))
    wanted = pay.ticker_list("PETR4, Brand#12 ,Brand#55")
    return pay.parse_quotes(payloads, RUN_TS, None, wanted).rows.select("ticker", "date", "close")


@query(f"with {_QUOTE_ROWS} select * from loaded")
def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed documents loaded as a stream into a stored table, then once more."""
    landing, table = land_quotes(fx.market_prices(spark, sf_dir)), scratch_path(spark, "stream-table")
    checkpoint = scratch_path(spark, "stream-checkpoint")
    for _ in range(2):
        load_quote_files(spark, landing, table, checkpoint, RUN_TS, None).awaitTermination()
    return read_table(spark, table, PRICES_SCHEMA).drop("ingested_at")


@query(f"""with {_QUOTE_ROWS},
revised as (
  select * exclude (adj_close),
         case when date >= date '2000-01-01' then adj_close / 2 else adj_close end as adj_close
  from loaded
)
select *, 'in parts' as read from revised union all by name select *, 'at once' as read from revised""")
def stream_batches_agree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two pulls of the quotes, the later with lower prices, read in parts and at once."""
    prices = fx.market_prices(spark, sf_dir)
    landing = land_quotes(prices)
    later = prices.filter("date >= date '2000-01-01'").withColumn(
        "adj_close", F.col("adj_close") / 2
    )
    second = land_quotes(later)
    spark.read.schema("value string, ticker string").text(second).write.mode("append").partitionBy(
        "ticker"
    ).text(landing)
    files = len(spark.read.schema("value string, ticker string").text(landing).inputFiles())
    tables = []
    for read, batch in (("in parts", -(-files // 3)), ("at once", 10_000)):
        table, checkpoint = scratch_path(spark, "stream-table"), scratch_path(spark, "checkpoint")
        load_quote_files(
            spark, landing, table, checkpoint, RUN_TS, None, batch, unit="year"
        ).awaitTermination()
        rows = read_table(spark, table, PRICES_SCHEMA).drop("ingested_at")
        tables.append(rows.withColumn("read", F.lit(read)))
    return tables[0].unionByName(tables[1])


@query(f"""with {SERIES_ROWS}
select 'series' as source, cast(series_code as integer) as series_code, count(*) as held_back,
       '{RUN_TS}' as run_ts
from records join codes using (series_code)
where series_code in (select series_code from records where unreadable and series_code <> 11)
group by series_code""")
def quarantine_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a load held back, stored twice under one run and read again."""
    new_years_eve = (F.month("o_orderdate") == 12) & (F.dayofmonth("o_orderdate") == 31)
    bad = new_years_eve & (F.col("o_orderpriority") != "1-URGENT")
    landing = series_landing(spark, sf_dir, bad)
    records = pay.read_series_payloads(spark, landing)
    loaded = pay.parse_series(records, RUN_TS, held_back_by=["series_code"])
    warehouse = Warehouse(spark, scratch_path(spark, "warehouse"))
    for _ in range(2):
        hold_back(warehouse, "series", loaded.rejects, "a date that is none", RUN_TS)
    return warehouse.quarantine.groupBy(
        "source",
        F.get_json_object("payload", "$.series_code").cast("int").alias("series_code"),
        F.date_format("run_ts", "yyyy-MM-dd HH:mm:ss").alias("run_ts"),
    ).agg(F.count(F.lit(1)).alias("held_back"))


@query(f"""with {_QUOTE_ROWS}
select ticker, company, sector, market_index, count(*) as quotes from loaded group by all""")
def ticker_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    quotes = fx.market_prices(spark, sf_dir).select(_renamed(F.col("ticker")).alias("ticker"))
    named = pay.with_ticker_metadata(quotes)
    return named.groupBy("ticker", "company", "sector", "market_index").agg(
        F.count(F.lit(1)).alias("quotes")
    )


# Calendar over the days on which orders were placed


def _order_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    return fx.table(spark, sf_dir, "orders").agg(F.min(day).alias("first"), F.max(day).alias("last"))


_YEARLY = ", ".join(repr(h) for h in BRAZIL_HOLIDAYS if len(h) == 5)
_DATED = ", ".join(repr(h) for h in BRAZIL_HOLIDAYS if len(h) == 10)

_CALENDAR = f"""
bounds as (
  select cast(min(o_orderdate) as date) as first, cast(max(o_orderdate) as date) as last from orders
),
all_days as (
  select cast(unnest(generate_series(first, last, interval '1 day')) as date) as d from bounds
),
calendar as (
  select cast(strftime(d, '%Y%m%d') as integer) as date_id, d as full_date,
         cast(year(d) as integer) as year, cast(quarter(d) as integer) as quarter,
         cast(month(d) as integer) as month, monthname(d) as month_name,
         cast(weekofyear(d) as integer) as week, cast(isodow(d) as integer) as day_of_week,
         dayname(d) as day_name, isodow(d) >= 6 as is_weekend,
         isodow(d) < 6 and strftime(d, '%m-%d') not in ({_YEARLY})
           and strftime(d, '%Y-%m-%d') not in ({_DATED}) as is_business_day
  from all_days
)"""


@query(f"""with {_CALENDAR},
per_day as (
  select cast(o_orderdate as date) as full_date, count(*) as orders from orders group by 1
)
select calendar.*, coalesce(orders, 0) as orders from calendar left join per_day using (full_date)""")
def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calendar of the order dates, with the number of orders on each day."""
    days = cal.calendar_of(cal.days_between(_order_days(spark, sf_dir), "first", "last"))
    orders = fx.table(spark, sf_dir, "orders")
    per_day = orders.groupBy(F.col("o_orderdate").cast("date").alias("full_date")).agg(
        F.count(F.lit(1)).alias("orders")
    )
    return days.join(per_day, "full_date", "left").withColumn(
        "orders", F.coalesce("orders", F.lit(0))
    )


@query(f"with {_CALENDAR} select * from calendar")
def calendar_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written as CSV and loaded with its declared types."""
    path = scratch_path(spark, "calendar")
    days = cal.days_between(_order_days(spark, sf_dir), "first", "last")
    cal.write_calendar_csv(cal.calendar_of(days), path)
    return cal.read_calendar_csv(spark, path)


# The holidays of the years that the shifted order dates fall into, once more.
_HOLIDAYS = """
  ('01-01'), ('04-21'), ('05-01'), ('09-07'), ('10-12'), ('11-02'), ('11-15'), ('12-25'),
  ('2020-02-24'), ('2020-02-25'), ('2020-04-10'), ('2020-06-11'),
  ('2021-02-15'), ('2021-02-16'), ('2021-04-02'), ('2021-06-03'),
  ('2022-02-28'), ('2022-03-01'), ('2022-04-15'), ('2022-06-16'),
  ('2023-02-20'), ('2023-02-21'), ('2023-04-07'), ('2023-06-08'),
  ('2024-02-12'), ('2024-02-13'), ('2024-03-29'), ('2024-05-30'),
  ('2025-03-03'), ('2025-03-04'), ('2025-04-18'), ('2025-06-19'),
  ('2026-02-16'), ('2026-02-17'), ('2026-04-03'), ('2026-06-04')"""


@query(f"""
with holidays(h) as (values {_HOLIDAYS}),
days as (
  select cast(o_orderdate + interval '300 months' as date) as full_date, count(*) as orders
  from orders group by 1
)
select full_date, orders,
       isodow(full_date) < 6
         and strftime(full_date, '%m-%d') not in (select h from holidays)
         and strftime(full_date, '%Y-%m-%d') not in (select h from holidays) as is_business_day
from days""")
def calendar_holidays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order days 25 years on, so that holidays of single years lie among them."""
    shifted = F.add_months(F.col("o_orderdate").cast("date"), 300).alias("full_date")
    days = fx.table(spark, sf_dir, "orders").groupBy(shifted).agg(F.count(F.lit(1)).alias("orders"))
    business = (~is_weekend(F.col("full_date")) & ~is_holiday(F.col("full_date"))).alias("is_business_day")
    return days.select("full_date", "orders", business)


@query("""
with bounds as (
  select cast(date_trunc('month', min(o_orderdate)) as date) as first,
         cast(date_trunc('month', max(o_orderdate)) as date) as last
  from orders
),
spine as (
  select cast(unnest(generate_series(first, last, interval '1 month')) as date) as date_month, last
  from bounds
)
select date_month from spine where date_month < last""")
def date_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounds = _order_days(spark, sf_dir).select(
        F.trunc("first", "month").alias("first"), F.trunc("last", "month").alias("last")
    )
    return cal.date_spine(bounds, "first", "last", "month")


@query("""
select o_orderkey,
       md5(concat(cast(o_custkey as varchar), '-', o_orderpriority, '-',
                  coalesce(case when o_orderstatus <> 'P' then o_orderstatus end,
                           '_dbt_utils_surrogate_key_null_'))) as order_hash
from orders""")
def surrogate_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus"))
    return fx.table(spark, sf_dir, "orders").select(
        "o_orderkey", hash_key(["o_custkey", "o_orderpriority", status]).alias("order_hash")
    )

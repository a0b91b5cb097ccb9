"""Upsert, incremental tables and type 2 history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.keys import run_stamp
from tidemark.operators import incremental, scd2
from tidemark.operators import upsert as keyed
from tidemark.plans.daily_run import Warehouse, build_models, load_raw
from tidemark.plans.snapshot import CHECK_COLUMNS, SNAPSHOT_KEY
from tidemark.schemas import PRICES_KEY, PRICES_SCHEMA
from tidemark.session import scratch_path
from tidemark.sources.tables import read_table
from workload import fixtures as fx
from workload.market_queries import MART_STOCK, RETURN_METRICS
from workload.oracle_parts import FX_PRICES, META
from workload.registry import query, with_rounded

RUNS = ["2024-01-01 07:00:00", "2024-01-02 07:00:00", "2024-01-03 07:00:00"]


# Keyed upsert


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = fx.table(spark, sf_dir, "orders")
    return orders.withColumn("o_orderdate", F.col("o_orderdate").cast("date"))


@query("""
select o_orderkey, o_custkey, o_orderstatus, cast(o_orderdate as date) as o_orderdate,
       o_orderpriority,
       case when o_orderdate >= date '2000-12-01' then o_totalprice * 2 else o_totalprice end
         as o_totalprice
from orders""")
def upsert_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second load overlaps the first by a month and corrects it."""
    orders = _orders(spark, sf_dir)
    first = orders.filter("o_orderdate < date '2001-01-01'")
    second = orders.filter("o_orderdate >= date '2000-12-01'").withColumn(
        "o_totalprice", F.col("o_totalprice") * 2
    )
    return keyed.upsert(first, second, ["o_orderkey"])


@query("""
select user_id, event_type, event_id, cast(ts as date) as day, value
from (
  select *, row_number() over (
    partition by user_id, event_type
    order by ts desc nulls last, event_id desc nulls last, value desc nulls last,
             props desc nulls last) as n
  from events
) where n = 1""")
def upsert_newest_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Duplicate keys inside one batch: the newest load time wins."""
    newest = keyed.newest_per_key(
        fx.table(spark, sf_dir, "events"), ["user_id", "event_type"], "ts"
    )
    return newest.select(
        "user_id", "event_type", "event_id", F.col("ts").cast("date").alias("day"), "value"
    )


_CORRECTED = f"""with {FX_PRICES}
select ticker, company, sector, market_index, date, open, high, low,
       case when date >= date '2001-06-01' then close * 2 else close end as close,
       adj_close, volume, dividends, stock_splits,
       case when date >= date '2001-06-01' then date '2024-01-02' else date '2024-01-01' end
         as loaded_on
from fx_market_prices"""


@query(_CORRECTED)
def upsert_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two overlapping loads into a stored table, the second one twice."""
    path = scratch_path(spark, "upsert")
    prices = fx.market_prices(spark, sf_dir)
    first = prices.filter("date < date '2001-07-01'").withColumn("ingested_at", run_stamp(RUNS[0]))
    second = (
        prices.filter("date >= date '2001-06-01'")
        .withColumn("close", F.col("close") * 2)
        .withColumn("ingested_at", run_stamp(RUNS[1]))
    )
    for batch in (first, second, second):
        keyed.upsert_table(spark, path, batch, PRICES_SCHEMA, PRICES_KEY)
    stored = read_table(spark, path, PRICES_SCHEMA)
    return stored.withColumn("loaded_on", F.col("ingested_at").cast("date")).drop("ingested_at")


_PULLED = T.StructType(
    [
        T.StructField("o_orderkey", T.LongType(), False),
        T.StructField("o_orderdate", T.DateType(), False),
        T.StructField("o_totalprice", T.DoubleType(), True),
        T.StructField("ingested_at", T.TimestampNTZType(), False),
    ]
)


@query("""
select o_orderkey, cast(o_orderdate as date) as o_orderdate,
       case when o_orderkey % 2 = 0 then o_totalprice / 4 else o_totalprice end as o_totalprice
from orders""")
def upsert_revised_pulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Later pulls lower half of the prices; one load has two pulls, another comes late."""
    orders = _orders(spark, sf_dir).select("o_orderkey", "o_orderdate", "o_totalprice")

    def pull(rows: DataFrame, hour: int, divided_by: int) -> DataFrame:
        return rows.withColumns(
            {
                "o_totalprice": F.col("o_totalprice") / divided_by,
                "ingested_at": run_stamp(RUNS[0]),
                keyed.PULLED_AT: run_stamp(f"2024-01-01 0{hour}:00:00"),
            }
        )

    path = scratch_path(spark, "pulls")
    even = orders.filter("o_orderkey % 2 = 0")
    newest, old = pull(even, 3, 4), pull(orders, 1, 1)
    for batch in (newest.unionByName(old), pull(even, 2, 2)):
        keyed.upsert_table(spark, path, batch, _PULLED, ["o_orderkey"], "o_orderdate", unit="year")
    return read_table(spark, path, _PULLED).drop("ingested_at")


@query("""
select (select count(*) from orders) as table_rows, count(*) as batch_rows,
       count(distinct o_custkey) as batch_keys
from orders where o_orderdate >= date '2000-12-01'""")
def load_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _orders(spark, sf_dir)
    return keyed.load_report(orders, orders.filter("o_orderdate >= date '2000-12-01'"), "o_custkey")


# Incremental refresh


@query(f"""with {FX_PRICES}
select ticker, date, close, volume from fx_market_prices
where date >= (select max(date) - interval '7 days' from fx_market_prices where date < date '2001-07-01')""")
def incremental_cutoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    prices = fx.market_prices(spark, sf_dir).select("ticker", "date", "close", "volume")
    start = incremental.lookback_start(prices.filter("date < date '2001-07-01'"), "date")
    return incremental.since(prices, "date", start)


@query("""
with marks as (
  select o_custkey, max(o_orderdate) as mark from orders
  where o_orderdate < date '2001-07-01' and o_orderpriority = '1-URGENT' group by o_custkey
)
select o_orderkey, o_custkey, cast(o_orderdate as date) as o_orderdate
from orders left join marks using (o_custkey)
where mark is null or o_orderdate >= mark - interval '7 days'""")
def incremental_cutoff_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The target holds urgent orders; customers without any load in full."""
    orders = _orders(spark, sf_dir)
    target = orders.filter("o_orderdate < date '2001-07-01' and o_orderpriority = '1-URGENT'")
    rows = incremental.since_by_key(orders, target, "o_custkey", "o_orderdate")
    return rows.select("o_orderkey", "o_custkey", "o_orderdate")


def _target(prices: DataFrame) -> DataFrame:
    return prices.filter("date < date '2001-07-01'")


def _batch(prices: DataFrame) -> DataFrame:
    start = incremental.lookback_start(_target(prices), "date")
    return incremental.since(prices.withColumn("close", F.col("close") * 2), "date", start)


_REFRESHED = f"""with {FX_PRICES},
cut as (
  select cast(max(date) - interval '7 days' as date) as start
  from fx_market_prices where date < date '2001-07-01'
)
select ticker, date, volume, case when date >= start then close * 2 else close end as close
from fx_market_prices, cut"""


def refreshed(prices: DataFrame) -> DataFrame:
    prices = prices.select("ticker", "date", "close", "volume")
    return incremental.delete_insert(_target(prices), _batch(prices), PRICES_KEY)


@query(_REFRESHED)
def incremental_delete_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return refreshed(fx.market_prices(spark, sf_dir))


@query(_REFRESHED)
def incremental_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same on a stored table, refreshed twice."""
    path = scratch_path(spark, "incremental")
    prices = fx.market_prices(spark, sf_dir).select("ticker", "date", "close", "volume")
    incremental.refresh_table(spark, path, _target(prices), PRICES_KEY, "date")
    batch = _batch(prices)
    for _ in range(2):
        incremental.refresh_table(spark, path, batch, PRICES_KEY, "date")
    return read_table(spark, path)


@query(f"""with {FX_PRICES},
cut as (
  select cast(max(date) - interval '7 days' as date) as start
  from fx_market_prices where date < date '2001-07-01'
)
select ticker, date,
       case when date < start then close end as close,
       volume,
       case when date >= start then high - low end as spread
from fx_market_prices, cut""")
def schema_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch has a new column and lacks an old one; both stay."""
    path = scratch_path(spark, "evolution")
    prices = fx.market_prices(spark, sf_dir)
    target = _target(prices).select("ticker", "date", "close", "volume")
    incremental.refresh_table(spark, path, target, PRICES_KEY, "date")
    batch = _batch(prices).select(
        "ticker", "date", "volume", (F.col("high") - F.col("low")).alias("spread")
    )
    incremental.refresh_table(spark, path, batch, PRICES_KEY, "date")
    return read_table(spark, path)


@query(f"with {FX_PRICES} select ticker, date, close * 2 as close, volume from fx_market_prices")
def full_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "full-refresh")
    prices = fx.market_prices(spark, sf_dir).select("ticker", "date", "close", "volume")
    incremental.refresh_table(spark, path, _target(prices), PRICES_KEY, "date")
    doubled = prices.withColumn("close", F.col("close") * 2)
    incremental.refresh_table(spark, path, doubled, PRICES_KEY, "date", full_refresh=True)
    return read_table(spark, path)


# Type 2 history


def _text(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss").alias(column)


def shown(history: DataFrame) -> DataFrame:
    stamps = ["dbt_updated_at", "dbt_valid_from", "dbt_valid_to"]
    return history.select("ticker", *CHECK_COLUMNS, "dbt_scd_id", *(_text(c) for c in stamps))


def _started(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd2.scd2_start(fx.metadata_v1(spark, sf_dir), SNAPSHOT_KEY, RUNS[0])


def _merged(history: DataFrame, source: DataFrame, run_ts: str) -> DataFrame:
    return scd2.scd2_merge(history, source, SNAPSHOT_KEY, CHECK_COLUMNS, run_ts)


def versions_sql(*selects: str) -> str:
    union = "\nunion all\n".join(selects)
    return f"""with {META},
pairs as (
  select coalesce(a.ticker, b.ticker) as ticker,
         a.ticker is not null as had, b.ticker is not null as has,
         a.company_name is distinct from b.company_name or a.sector is distinct from b.sector
           or a.market_index is distinct from b.market_index as changed,
         a.company_name as old_name, a.sector as old_sector, a.market_index as old_index,
         b.company_name as new_name, b.sector as new_sector, b.market_index as new_index
  from meta_v1 a full outer join meta_v2 b on a.ticker = b.ticker
),
versions as (
{union}
)
select ticker, company_name, sector, market_index,
       md5(concat(cast(ticker as varchar), '|', opened)) as dbt_scd_id,
       opened as dbt_updated_at, opened as dbt_valid_from, closed as dbt_valid_to
from versions"""


def _version(state: str, condition: str, opened: int, closed: int | None) -> str:
    ended = "cast(null as varchar)" if closed is None else f"'{RUNS[closed]}'"
    return f"""  select ticker, {state}_name as company_name, {state}_sector as sector,
         {state}_index as market_index, '{RUNS[opened]}' as opened, {ended} as closed
  from pairs where {condition}"""


AFTER_SECOND = [
    _version("old", "had and (not has or changed)", 0, 1),
    _version("old", "had and has and not changed", 0, None),
    _version("new", "has and (not had or changed)", 1, None),
]
AFTER_THIRD = [
    _version("old", "had and (not has or changed)", 0, 1),
    _version("old", "had and has and not changed", 0, None),
    _version("new", "has and (not had or changed)", 1, 2),
    _version("old", "had and (not has or changed)", 2, None),
]


@query(versions_sql(_version("old", "had", 0, None)))
def scd2_initial(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(_started(spark, sf_dir))


@query(versions_sql(*AFTER_SECOND))
def scd2_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New, changed, removed and unchanged keys after a second run."""
    source = fx.metadata_v2(spark, sf_dir)
    return shown(_merged(_started(spark, sf_dir), source, RUNS[1]))


@query(versions_sql(_version("old", "had and not has", 0, 1)))
def scd2_hard_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys without an open row after the second run."""
    source = fx.metadata_v2(spark, sf_dir)
    history = _merged(_started(spark, sf_dir), source, RUNS[1])
    is_open = history.filter("dbt_valid_to is null").select("ticker")
    return shown(history.join(is_open, "ticker", "left_anti"))


@query(versions_sql(*AFTER_THIRD))
def scd2_return(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third run on the first state: removed keys return with a gap."""
    v1, v2 = fx.metadata_v1(spark, sf_dir), fx.metadata_v2(spark, sf_dir)
    return shown(_merged(_merged(_started(spark, sf_dir), v2, RUNS[1]), v1, RUNS[2]))


@query(versions_sql(*AFTER_THIRD))
def scd2_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same three runs on a stored history, each run twice."""
    path = scratch_path(spark, "scd2")
    v1, v2 = fx.metadata_v1(spark, sf_dir), fx.metadata_v2(spark, sf_dir)
    for source, run_ts in zip((v1, v2, v1), RUNS, strict=True):
        for _ in range(2):
            scd2.scd2_table(spark, path, source, SNAPSHOT_KEY, CHECK_COLUMNS, run_ts)
    return shown(scd2.read_history(spark, path))


@query(versions_sql(_version("old", "had", 0, 1)))
def scd2_table_emptied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run without any key closes every row of the stored history."""
    path = scratch_path(spark, "scd2")
    v1 = fx.metadata_v1(spark, sf_dir)
    for source, run_ts in zip((v1, v1.limit(0)), RUNS, strict=False):
        scd2.scd2_table(spark, path, source, SNAPSHOT_KEY, CHECK_COLUMNS, run_ts)
    return shown(scd2.read_history(spark, path))


@query(versions_sql(*AFTER_SECOND))
def scd2_table_retried(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second run is repeated with a corrected source: only that one counts."""
    path = scratch_path(spark, "scd2")
    v1, v2 = fx.metadata_v1(spark, sf_dir), fx.metadata_v2(spark, sf_dir)
    wrong = v2.withColumn("sector", F.lit("wrong")).limit(7)
    for source, run_ts in ((v1, RUNS[0]), (wrong, RUNS[1]), (v1.limit(0), RUNS[1]), (v2, RUNS[1])):
        scd2.scd2_table(spark, path, source, SNAPSHOT_KEY, CHECK_COLUMNS, run_ts)
    return shown(scd2.read_history(spark, path))


# All layers


@query(MART_STOCK.replace("max_by(px, k) as close", "max_by(px, k) / 10 as close"))
def stored_stock_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw load, every layer with its checks, then a second, incremental run.

    Closes are divided by ten to lie in the range that the checks demand.
    """
    warehouse = Warehouse(spark, scratch_path(spark, "warehouse"), unit="year")
    load_raw(
        warehouse,
        fx.derive_bacen_series(spark, sf_dir),
        fx.derive_market_prices(spark, sf_dir).withColumn("close", F.col("close") / 10),
    )
    for run_ts in RUNS[:2]:
        build_models(warehouse, run_ts)
    mart = with_rounded(warehouse.stock_performance, *RETURN_METRICS, "risk_premium_vs_cdi")
    return mart.drop("dbt_updated_at")

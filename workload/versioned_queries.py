"""Stored tables over several runs: failures, late pulls, replays, resumed models."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import scd2
from tidemark.functions.keys import run_stamp
from tidemark.operators.check_state import incremental_checks as checked_by_part
from tidemark.operators.incremental import refresh_table
from tidemark.operators.quality import accepted_values, between, not_null, unique_combination
from tidemark.operators.quarantine import read_quarantine, replay
from tidemark.operators.upsert import known_values, upsert_table
from tidemark.plans.resumed_returns import refresh_returns
from tidemark.plans.snapshot import CHECK_COLUMNS, SNAPSHOT_KEY
from tidemark.plans.staging import typed_prices
from tidemark.schemas import PRICES_KEY, PRICES_SCHEMA, SERIES_KEY, SERIES_RECORD, SERIES_SCHEMA
from tidemark.session import scratch_path
from tidemark.sources import payloads as pay
from tidemark.sources import versions
from tidemark.sources.tables import read_table, replace_periods, write_table
from tidemark.streaming.ingest import load_series_files
from workload import fixtures as fx
from workload.market_queries import RETURN_METRICS
from workload.oracle_parts import FX_PRICES, RETURNS
from workload.registry import query, with_rounded
from workload.source_queries import CODES, RUN_TS, SERIES_ROWS
from workload.table_queries import AFTER_SECOND, AFTER_THIRD, RUNS, shown, versions_sql

# A write that fails


class _Failed(Exception):
    pass


def _failing(rows: DataFrame, column: str) -> DataFrame:
    """The rows, with an error where the last of them by the column is written."""
    last = rows.agg(F.max(column)).head()[0]
    failure = F.raise_error(F.lit("a lost disk")).cast(rows.schema[column].dataType)
    return rows.withColumn(column, F.when(F.col(column) == last, failure).otherwise(F.col(column)))


def _must_fail(write) -> None:
    try:
        write()
    except Exception as failure:
        if "a lost disk" not in str(failure):
            raise
    else:
        raise _Failed("the write was to fail")


@query(versions_sql(*AFTER_SECOND))
def scd2_table_failed_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second run fails while it writes its rows, and is then repeated."""
    path = scratch_path(spark, "scd2")
    v1, v2 = fx.metadata_v1(spark, sf_dir), fx.metadata_v2(spark, sf_dir)
    scd2.scd2_table(spark, path, v1, SNAPSHOT_KEY, CHECK_COLUMNS, RUNS[0])
    broken = _failing(v2, "company_name")
    _must_fail(
        lambda: scd2.scd2_table(spark, path, broken, SNAPSHOT_KEY, CHECK_COLUMNS, RUNS[1])
    )
    scd2.scd2_table(spark, path, v2, SNAPSHOT_KEY, CHECK_COLUMNS, RUNS[1])
    return shown(scd2.read_history(spark, path))


@query(versions_sql(*AFTER_THIRD))
def scd2_late_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second of three runs comes last and is put between the others."""
    path = scratch_path(spark, "scd2")
    v1, v2 = fx.metadata_v1(spark, sf_dir), fx.metadata_v2(spark, sf_dir)
    for source, run_ts in ((v1, RUNS[0]), (v1, RUNS[2]), (v2, RUNS[1])):
        scd2.scd2_table(spark, path, source, SNAPSHOT_KEY, CHECK_COLUMNS, run_ts)
    return shown(scd2.read_history(spark, path))


@query(f"""with {FX_PRICES}
select ticker, date, close, 'before' as state from fx_market_prices where date < date '2001-07-01'
union all
select ticker, date, case when date >= date '2001-06-01' then close * 2 else close end, 'after'
from fx_market_prices""")
def upsert_failed_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is stored after a load that failed, and after it was repeated."""
    path = scratch_path(spark, "failed-upsert")
    prices = fx.market_prices(spark, sf_dir)

    def load(rows: DataFrame) -> None:
        upsert_table(spark, path, rows, PRICES_SCHEMA, PRICES_KEY)

    load(prices.filter("date < date '2001-07-01'"))
    second = prices.filter("date >= date '2001-06-01'").withColumn("close", F.col("close") * 2)
    _must_fail(lambda: load(_failing(second, "volume")))
    before = read_table(spark, path, PRICES_SCHEMA).withColumn("state", F.lit("before"))
    load(second)
    after = read_table(spark, path, PRICES_SCHEMA).withColumn("state", F.lit("after"))
    return before.unionByName(after).select("ticker", "date", "close", "state")


# Versions and columns


@query(f"""with {FX_PRICES}
select ticker, date, volume,
       case when date < date '2001-07-01' then close else high - low end as amount,
       1 as version
from fx_market_prices where date < date '2001-07-01'
union all
select ticker, date, case when date >= date '2001-07-01' then volume + 5000000000 else volume end,
       case when date < date '2001-07-01' then close else high - low end, 2
from fx_market_prices""")
def schema_renamed_widened(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column of a stored table is renamed, another gets a wider type with new rows."""
    path = scratch_path(spark, "schema-log")
    prices = fx.market_prices(spark, sf_dir)
    first = prices.filter("date < date '2001-07-01'").select(
        "ticker", "date", "close", F.col("volume").cast("int").alias("volume")
    )
    write_table(first, path, "date", "year")
    renamed = versions.rename_column(spark, path, "close", "amount")
    second = prices.filter("date >= date '2001-07-01'").select(
        "ticker",
        "date",
        (F.col("high") - F.col("low")).alias("amount"),
        (F.col("volume") + 5_000_000_000).alias("volume"),
    )
    in_its_year = read_table(spark, path, version=renamed).filter("date >= date '2001-01-01'")
    replace_periods(second.unionByName(in_its_year), path, "date", "year", renamed)
    old = read_table(spark, path, version=renamed).withColumn("version", F.lit(1))
    new = read_table(spark, path).withColumn("version", F.lit(2))
    rows = old.withColumn("volume", F.col("volume").cast("long")).unionByName(new)
    return rows.select("ticker", "date", "volume", "amount", "version")


# Models that go on from the last run


@query(f"with {RETURNS} select * exclude (vol_21) from returns")
def incremental_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Returns of three loads, each extended from the state that the last one left.

    The second load also corrects quotes of the month before it to what they are.
    """
    prices = fx.market_prices(spark, sf_dir)
    raw, returns, state = (scratch_path(spark, n) for n in ("raw", "returns", "state"))
    wrong = F.when(F.col("date") >= "2000-06-01", F.col("adj_close") * 3)
    loads = [
        prices.filter("date < date '2000-07-01'").withColumn(
            "adj_close", F.coalesce(wrong, "adj_close")
        ),
        prices.filter("date >= date '2000-06-01' and date < date '2001-07-01'"),
        prices.filter("date >= date '2001-07-01'"),
    ]
    for batch in loads:
        upsert_table(spark, raw, batch, PRICES_SCHEMA, PRICES_KEY, unit="year")
        refresh_returns(spark, raw, returns, state, "year")
    return with_rounded(read_table(spark, returns), *RETURN_METRICS)


_EVENT_CHECKS = [
    not_null("user_id"),
    between("value", 0.01, 100),
    unique_combination("user_id", "event_type", "day"),
    accepted_values("event_type", ["view", "click", "purchase"]),
]


@query("""
with e as (select *, cast(ts as date) as day from events),
repeated as (select user_id, event_type, day from e group by all having count(*) > 1)
select 'events' as table_name, 'not_null' as check_name, 'user_id' as column_name,
       (select count(*) from e where user_id is null) as failures
union all select 'events', 'between', 'value',
       (select count(*) from e where not value between 0.01 and 100)
union all select 'events', 'unique_combination', 'user_id, event_type, day',
       (select count(*) from repeated)
union all select 'events', 'accepted_values', 'event_type',
       (select count(distinct event_type) from e
        where event_type not in ('view', 'click', 'purchase'))""")
def incremental_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checks of a table in days, after half of the days were loaded and checked before."""
    path, state = scratch_path(spark, "events"), scratch_path(spark, "events-checks")
    events = fx.table(spark, sf_dir, "events").withColumn("day", F.col("ts").cast("date"))
    half = events.select(F.percentile_approx("ts", 0.5).alias("at")).head()["at"].date()
    write_table(events.filter(F.col("day") <= F.lit(half)), path, "day", "day")

    def check() -> DataFrame:
        return checked_by_part(spark, path, state, "events", _EVENT_CHECKS, part_key="day")

    check()
    replace_periods(events.filter(F.col("day") > F.lit(half)), path, "day", "day")
    return check()


# Rejects

def _land(spark: SparkSession, sf_dir: str, priorities: list[str], bad: str) -> str:
    """A file per series and year; the dates of New Year's Eve are written as ``bad``."""
    code = F.coalesce(*(F.when(F.col("o_orderpriority") == p, c) for p, c in CODES.items()))
    amount = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    new_years_eve = (F.month("o_orderdate") == 12) & (F.dayofmonth("o_orderdate") == 31)
    date = F.when(new_years_eve, F.date_format("o_orderdate", bad)).otherwise(
        F.date_format("o_orderdate", "dd/MM/yyyy")
    )
    record = F.struct(
        date.alias("data"),
        F.when(F.col("o_totalprice") < 20_000, "n/d").otherwise(amount).alias("valor"),
    )
    orders = fx.table(spark, sf_dir, "orders").filter(F.col("o_orderpriority").isin(priorities))
    path = scratch_path(spark, "landing")
    years = [r[0] for r in orders.select(F.year("o_orderdate")).distinct().collect()]
    for year in sorted(years):
        orders.filter(F.year("o_orderdate") == year).select(
            F.to_json(record).alias("value"), code.alias("series_code")
        ).repartition(1).write.mode("append").partitionBy("series_code").text(path)
    return path


_PULLS = f"""{SERIES_ROWS},
pulls as (
  select cast(series_code as integer) as series_code, date, value, year(date) as pull,
         bool_or(unreadable) over (partition by series_code, year(date)) as bad
  from records join codes using (series_code)
)"""


@query(f"""with {_PULLS}
select series_code, date, max(value) as value, count(value) as n from pulls
where value is not null and not (bad and series_code = 189) group by series_code, date
union all
select series_code, null, null, count(*) from pulls where bad and series_code = 189
group by series_code""")
def quarantine_replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two streams hold back files with dates in another order into one quarantine; a
    replay reads most of them after a correction, one series stays held back."""
    quarantine, target = scratch_path(spark, "quarantine"), scratch_path(spark, "series")
    urgent = [p for p, code in CODES.items() if code != 189]
    for priorities, bad in ((urgent, "yyyy-MM-dd"), (["4-NOT SPECIFIED"], "'n/d'")):
        landing, checkpoint = _land(spark, sf_dir, priorities, bad), scratch_path(spark, "stream")
        for _ in range(2):
            load_series_files(
                spark, landing, target, checkpoint, RUN_TS, 14, "year", quarantine
            ).awaitTermination()

    def day_first(records: DataFrame) -> DataFrame:
        turned = F.date_format(F.try_to_date("data", "yyyy-MM-dd"), "dd/MM/yyyy")
        return records.withColumn("data", F.coalesce(turned, "data"))

    def load(rows: DataFrame) -> None:
        known = known_values(rows, "value")
        upsert_table(spark, target, known, SERIES_SCHEMA, SERIES_KEY, unit="year")

    replay(
        spark,
        quarantine,
        "series",
        f"{SERIES_RECORD}, series_code int",
        lambda records: pay.parse_series(records, RUN_TS),
        load,
        day_first,
    )
    rows = read_table(spark, target, SERIES_SCHEMA).select("series_code", "date", "value")
    counted = _land_counts(spark, sf_dir)
    loaded = rows.join(counted, ["series_code", "date"])
    held = (
        read_quarantine(spark, quarantine)
        .groupBy(F.get_json_object("payload", "$.series_code").cast("int").alias("series_code"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return loaded.unionByName(held, allowMissingColumns=True)


def _land_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with an amount per series and day, of which one is loaded."""
    code = F.coalesce(*(F.when(F.col("o_orderpriority") == p, c) for p, c in CODES.items()))
    orders = fx.table(spark, sf_dir, "orders").filter("o_totalprice >= 20000")
    return orders.groupBy(
        code.alias("series_code"), F.col("o_orderdate").cast("date").alias("date")
    ).agg(F.count(F.lit(1)).alias("n"))


@query(f"""with {_PULLS}
select series_code, date, max(value) as value, read
from pulls, (values ('batch'), ('stream')) as way(read)
where value is not null and not bad group by series_code, date, read""")
def series_batch_equals_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same files, some of them bad, loaded at once and as a stream."""
    landing = _land(spark, sf_dir, list(CODES), "'n/d'")
    batch, stream = scratch_path(spark, "batch"), scratch_path(spark, "stream")
    records = pay.parse_series(pay.read_series_payloads(spark, landing), RUN_TS).rows
    known = known_values(records, "value")
    upsert_table(spark, batch, known, SERIES_SCHEMA, SERIES_KEY, unit="year")
    checkpoint = scratch_path(spark, "checkpoint")
    load_series_files(
        spark, landing, stream, checkpoint, RUN_TS, 12, unit="year"
    ).awaitTermination()
    tables = [
        read_table(spark, path, SERIES_SCHEMA).withColumn("read", F.lit(way))
        for path, way in ((batch, "batch"), (stream, "stream"))
    ]
    return tables[0].unionByName(tables[1]).select("series_code", "date", "value", "read")


# Stamps


@query(f"""with {FX_PRICES}
select ticker, date,
       case when date >= date '2001-06-01' then '{RUNS[1]}' else '{RUNS[0]}' end as ingested_at,
       case when date >= date '2001-06-01' then '{RUNS[1]}' else '{RUNS[0]}' end as updated_at
from fx_market_prices where close > 0""")
def run_stamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load stamps of two loads, and the run stamps of a mart refreshed after each."""
    raw, mart = scratch_path(spark, "raw"), scratch_path(spark, "mart")
    prices = fx.market_prices(spark, sf_dir)
    parts = ["date < date '2001-07-01'", "date >= date '2001-06-01'"]
    for condition, run_ts in zip(parts, RUNS):
        batch = prices.filter(condition).withColumn("ingested_at", run_stamp(run_ts))
        upsert_table(spark, raw, batch, PRICES_SCHEMA, PRICES_KEY, unit="year")
        fresh = typed_prices(read_table(spark, raw, PRICES_SCHEMA)).filter(
            condition.replace("date <", "trade_date <").replace("date >", "trade_date >")
        )
        stamped = fresh.select("ticker", "trade_date", run_stamp(run_ts).alias("updated_at"))
        refresh_table(spark, mart, stamped, ["ticker", "trade_date"], "trade_date", "year")
    loaded = read_table(spark, raw, PRICES_SCHEMA).select(
        "ticker", "date", F.date_format("ingested_at", "yyyy-MM-dd HH:mm:ss").alias("ingested_at")
    )
    refreshed = read_table(spark, mart).select(
        "ticker",
        F.col("trade_date").alias("date"),
        F.date_format("updated_at", "yyyy-MM-dd HH:mm:ss").alias("updated_at"),
    )
    return loaded.join(refreshed, ["ticker", "date"])

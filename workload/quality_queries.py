"""Data checks, freshness and comparisons."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import quality as q
from tidemark.operators.compare import compare_by_digest as by_digest
from tidemark.operators.compare import compare_relations as compare
from tidemark.operators.compare import row_count_matches as matches
from tidemark.plans import checks as configured
from tidemark.plans.macro import int_macro_pivoted
from tidemark.plans.market import int_market_returns
from tidemark.plans.staging import stg_bacen_series, stg_market_prices
from workload import fixtures as fx
from workload.oracle_parts import FX_PRICES, FX_SERIES, MACRO, META, RETURNS
from workload.registry import query

_TABLE = "market_prices"


def _sql_entry(table: str, check: str, column: str, failures: str) -> str:
    return (
        f"select '{table}' as table_name, '{check}' as check_name, '{column}' as column_name, "
        f"cast(({failures}) as bigint) as failures"
    )


def _sql_nulls(table: str, relation: str, *columns: str) -> list[str]:
    return [
        _sql_entry(table, "not_null", c, f"select count(*) from {relation} where {c} is null")
        for c in columns
    ]


def _sql_repeated(relation: str, columns: str) -> str:
    return (
        f"select count(*) from (select {columns} from {relation} "
        f"group by {columns} having count(*) > 1)"
    )


_PRICE_COLUMNS = ["ticker", "date", "close", "volume", "dividends", "stock_splits"]


@query(f"with {FX_PRICES}\n" + "\nunion all ".join(_sql_nulls(_TABLE, "fx_market_prices", *_PRICE_COLUMNS)))
def dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    prices = fx.market_prices(spark, sf_dir)
    return q.run_checks(prices, _TABLE, [q.not_null(c) for c in _PRICE_COLUMNS])


@query("select l_orderkey, count(*) as n_records from lineitem group by 1 having count(*) > 1")
def dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.unique("l_orderkey").failures(fx.table(spark, sf_dir, "lineitem"))


@query("""
select l_orderkey, l_linenumber, count(*) as n_records from lineitem
group by 1, 2 having count(*) > 1""")
def dq_unique_combo(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.unique_combination("l_orderkey", "l_linenumber").failures(
        fx.table(spark, sf_dir, "lineitem")
    )


@query("""
select event_type, count(*) as n_records from events
where event_type not in ('signup', 'view', 'click') group by 1""")
def dq_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return q.accepted_values("event_type", ["signup", "view", "click"]).failures(
        fx.table(spark, sf_dir, "events")
    )


@query("select event_id, user_id, value from events where value < 0.01 or value > 100")
def dq_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    failures = q.between("value", 0.01, 100).failures(fx.table(spark, sf_dir, "events"))
    return failures.select("event_id", "user_id", "value")


def _sql_configured() -> str:
    raw_series = "(select *, cast(date as timestamp) as ingested_at from fx_bacen_series)"
    stg_series = (
        "(select *, cast(reference_date as timestamp) as ingested_at from series)"
    )
    stg_prices = "(select *, cast(trade_date as timestamp) as ingested_at from prices)"
    names = ", ".join(f"''{n}''" for n in configured.SERIES_NAMES).replace("''", "'")
    lines = [
        *_sql_nulls("bacen_series", raw_series, "series_code", "series_name", "date", "value", "ingested_at"),
        _sql_entry(
            "bacen_series", "accepted_values", "series_name",
            f"select count(distinct series_name) from fx_bacen_series where series_name not in ({names})",
        ),
        *_sql_nulls("market_prices", "fx_market_prices", "ticker", "date", "close"),
        _sql_entry(
            "market_prices", "between", "close",
            "select count(*) from fx_market_prices where close < 0.01 or close > 100000",
        ),
        *_sql_nulls(
            "stg_bacen_series", stg_series, "series_code", "series_name", "frequency", "unit",
            "reference_date", "series_value", "ingested_at",
        ),
        _sql_entry(
            "stg_bacen_series", "accepted_values", "frequency",
            "select count(distinct frequency) from series where frequency not in ('daily', 'monthly')",
        ),
        _sql_entry(
            "stg_bacen_series", "between", "series_value",
            "select count(*) from series where series_value < -50 or series_value > 10000",
        ),
        *_sql_nulls(
            "stg_market_prices", stg_prices, "ticker", "trade_date", "price_close",
            "price_adj_close", "ingested_at",
        ),
        _sql_entry(
            "stg_market_prices", "between", "price_close",
            "select count(*) from prices where price_close < 0.01 or price_close > 100000",
        ),
        _sql_entry(
            "stg_market_prices", "unique_combination", "ticker, trade_date",
            _sql_repeated("prices", "ticker, trade_date"),
        ),
        *_sql_nulls("int_macro_pivoted", "macro", "macro_date", "is_bacen_business_day"),
        _sql_entry("int_macro_pivoted", "unique", "macro_date", _sql_repeated("macro", "macro_date")),
        *_sql_nulls("int_market_returns", "returns", "ticker", "trade_date", "log_return_daily"),
    ]
    return f"with {RETURNS}, {MACRO}\n" + "\nunion all ".join(lines)


@query(_sql_configured())
def configured_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every check configured for the sources, the staging and the intermediate models."""
    raw_series, raw_prices = fx.bacen_series(spark, sf_dir), fx.market_prices(spark, sf_dir)
    series = stg_bacen_series(raw_series)
    reports = [
        q.run_checks(raw_series, "bacen_series", configured.RAW_SERIES),
        q.run_checks(raw_prices, "market_prices", configured.RAW_PRICES),
        q.run_checks(series, "stg_bacen_series", configured.STG_SERIES),
        q.run_checks(stg_market_prices(raw_prices), "stg_market_prices", configured.STG_PRICES),
        q.run_checks(int_macro_pivoted(series), "int_macro_pivoted", configured.MACRO_PIVOTED),
        q.run_checks(int_market_returns(raw_prices), "int_market_returns", configured.MARKET_RETURNS),
    ]
    return reduce(DataFrame.unionByName, reports)


_AS_OF = ["2024-02-01 00:00:00", "2024-02-05 00:00:00", "2024-02-10 00:00:00"]


@query(
    "\nunion all ".join(
        f"""
select '{t}' as as_of, cast(max(ts) as varchar) as max_loaded_at,
       case when max(ts) < timestamp '{t}' - interval '7 days' then 'error'
            when max(ts) < timestamp '{t}' - interval '3 days' then 'warn' else 'pass' end as status
from events"""
        for t in _AS_OF
    )
)
def freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = fx.table(spark, sf_dir, "events")
    limits = configured.FRESHNESS_WARN_DAYS, configured.FRESHNESS_ERROR_DAYS
    rows = [q.freshness(events, "ts", t, *limits).withColumn("as_of", F.lit(t)) for t in _AS_OF]
    return reduce(DataFrame.unionByName, rows).withColumn(
        "max_loaded_at", F.col("max_loaded_at").cast("string")
    )


@query("""
select count(*) as rows, 10 * (select count(*) from customer) as expected_rows,
       count(*) = 10 * (select count(*) from customer) as matches
from orders""")
def row_count_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    expected = 10 * fx.table(spark, sf_dir, "customer").count()
    return matches(fx.table(spark, sf_dir, "orders"), expected)


@query(f"""with {META},
a_rows as (select distinct * from meta_v1),
b_rows as (select distinct * from meta_v2)
select true as in_a, true as in_b, count(*) as rows from (table a_rows intersect table b_rows)
union all
select true, false, count(*) from (table a_rows except table b_rows)
union all
select false, true, count(*) from (table b_rows except table a_rows)""")
def compare_relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare(fx.metadata_v1(spark, sf_dir), fx.metadata_v2(spark, sf_dir))


_LINES = """l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice,
       cast(l_shipdate as date) as shipped"""


@query(f"""
with a_rows as (select {_LINES} from lineitem),
b_rows as (
  select * replace (case when l_orderkey % 97 = 0 then l_quantity + 1 else l_quantity end
                      as l_quantity)
  from a_rows where l_orderkey % 101 <> 0
  union all
  select * from a_rows where l_orderkey % 103 = 0
)
select true as in_a, true as in_b, cast(count(*) as bigint) as rows
from (table a_rows intersect all table b_rows)
union all
select true, false, count(*) from (table a_rows except all table b_rows)
union all
select false, true, count(*) from (table b_rows except all table a_rows)""")
def compare_by_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items against a copy with changed, missing and repeated ones, by month."""
    a = fx.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice",
        F.col("l_shipdate").cast("date").alias("shipped"),
    )
    raised = F.when(F.col("l_orderkey") % 97 == 0, F.col("l_quantity") + 1)
    b = (
        a.filter("l_orderkey % 101 <> 0")
        .withColumn("l_quantity", F.coalesce(raised, "l_quantity"))
        .unionByName(a.filter("l_orderkey % 103 = 0"))
    )
    return by_digest(a, b, ["l_orderkey"], F.date_format("shipped", "yyyy-MM"))


@query(f"""with {FX_SERIES}
select series_code, count(*) as n_records from fx_bacen_series
group by series_code, date having count(*) > 1
union all
select -1, count(*) from fx_bacen_series""")
def dq_series_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The key of the raw series: no repeated pair; -1 stands for all rows."""
    series = fx.bacen_series(spark, sf_dir)
    repeated = q.unique_combination("series_code", "date").failures(series)
    total = series.agg(F.lit(-1).alias("series_code"), F.count(F.lit(1)).alias("n_records"))
    return repeated.select("series_code", "n_records").unionByName(total)

"""The raw tables of the models, derived from the whole test tables.

``market_prices`` and ``bacen_series`` store what they derive, as raw tables
are stored: queries that read them more than once scan the test tables once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import materialize


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def market_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialize(derive_market_prices(spark, sf_dir), "market-prices")


def bacen_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialize(derive_bacen_series(spark, sf_dir), "bacen-series")


# Bars whose first and last orders are broadcast, a few dozen MB at most.
_SENT_BARS = 250_000


def derive_market_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars: brands as tickers, line items as trades in a total order.

    The least and greatest of whole trades would sort all of them. So a first pass keeps
    numbers only, among them the first and the last order of each bar, and a second one
    compares the trades of just these orders.
    """
    parts = table(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("ticker"))
    lines = table(spark, sf_dir, "lineitem").withColumn("date", F.col("l_shipdate").cast("date"))

    def trades(of_lines: DataFrame) -> DataFrame:
        return of_lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))

    px = F.col("l_extendedprice") / F.col("l_quantity")
    order, tax = F.col("l_orderkey"), F.col("l_tax")
    totals = trades(lines).groupBy("ticker", "date").agg(
        # A missing order comes before all others.
        F.when(~F.bool_or(order.isNull()), F.min(order)).alias("first_order"),
        F.max(order).alias("last_order"),
        F.max(px).alias("high"),
        F.min(px).alias("low"),
        F.sum("l_quantity").cast("bigint").alias("volume"),
        F.max(F.when(tax >= 0.08, tax).when(tax > 0, 0.0)).alias("dividends"),
        F.count_if(F.col("l_returnflag") == "R").alias("returned"),
    )
    totals = materialize(totals, "bar-totals")
    ends = totals.select(
        F.col("date").alias("_date"), F.explode(F.array("first_order", "last_order")).alias("_order")
    )
    if totals.count() <= _SENT_BARS:
        ends = F.broadcast(ends)
    at_ends = order.eqNullSafe(F.col("_order")) & F.col("date").eqNullSafe(F.col("_date"))
    trade = F.struct(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        "l_extendedprice",
        "l_quantity",
        "l_discount",
        "l_tax",
        "l_returnflag",
        "l_linestatus",
    )
    outer = (
        trades(lines.join(ends, at_ends, "left_semi"))
        .groupBy(F.col("ticker").alias("_ticker"), F.col("date").alias("_date"))
        .agg(F.min(trade).alias("first"), F.max(trade).alias("last"))
    )
    same_bar = F.col("ticker").eqNullSafe(F.col("_ticker")) & F.col("date").eqNullSafe(F.col("_date"))
    bars = totals.join(outer, same_bar)
    first_returned = (F.col("first.l_returnflag") == "R").cast("int")
    brand_digit = F.substring("ticker", -1, 1)
    return bars.select(
        "ticker",
        F.concat(F.lit("Company "), "ticker").alias("company"),
        F.concat(F.lit("Sector "), brand_digit).alias("sector"),
        F.when(brand_digit.isin("1", "3"), "IDX_A").otherwise("IDX_B").alias("market_index"),
        "date",
        (F.col("first.l_extendedprice") / F.col("first.l_quantity")).alias("open"),
        "high",
        "low",
        (F.col("last.l_extendedprice") / F.col("last.l_quantity")).alias("close"),
        (
            F.col("last.l_extendedprice") / F.col("last.l_quantity") * (1 - F.col("last.l_discount"))
        ).alias("adj_close"),
        "volume",
        "dividends",
        # A split is any returned line but the first of the day.
        F.when(F.col("returned") > first_returned, 2.0).otherwise(0.0).alias("stock_splits"),
        F.col("date").cast(T.TimestampNTZType()).alias("ingested_at"),
    )


# code, name, frequency, unit, which orders, scale of the price
_SERIES = [
    (11, "selic_rate", "daily", "pct_per_year", ("o_orderpriority", "1-URGENT"), 10_000),
    (1, "usd_brl_rate", "daily", "brl_per_usd", ("o_orderpriority", "2-HIGH"), 100_000),
    (4189, "cdi_rate", "daily", "pct_per_year", ("o_orderpriority", "3-MEDIUM"), 10_000),
    (433, "ipca_inflation", "monthly", "pct_change", ("o_orderpriority", "4-NOT SPECIFIED"), 1_000_000),
    (189, "igpm_inflation", "monthly", "pct_change", ("o_orderpriority", "5-LOW"), 1_000_000),
    (7811, "real_interest_rate", "monthly", "pct_per_year", ("o_orderstatus", "P"), 1_000_000),
]


def derive_bacen_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six macro series: the lowest order price of each day or month.

    One pass: the lowest price per day and series first, which is small, then
    the months from the days.
    """
    day = F.col("o_orderdate").cast("date")
    by_day = (
        table(spark, sf_dir, "orders")
        .groupBy(day.alias("day"))
        .agg(
            *(
                F.min(F.when(F.col(column) == value, F.col("o_totalprice"))).alias(f"low_{code}")
                for code, _, _, _, (column, value), _ in _SERIES
            )
        )
    )

    def observation(code: int, name: str, frequency: str, unit: str, scale: int) -> Column:
        date = F.col("day") if frequency == "daily" else F.trunc("day", "month")
        return F.struct(
            F.lit(code).alias("series_code"),
            F.lit(name).alias("series_name"),
            F.lit(frequency).alias("frequency"),
            F.lit(unit).alias("unit"),
            date.alias("date"),
            (F.col(f"low_{code}") / scale).alias("value"),
        )

    values = [observation(c, n, f, u, scale) for c, n, f, u, _, scale in _SERIES]
    return (
        by_day.select(F.explode(F.array(*values)).alias("o"))
        .select("o.*")
        .filter("value is not null")
        .groupBy("series_code", "series_name", "frequency", "unit", "date")
        .agg(F.min("value").alias("value"))
        .withColumn("ingested_at", F.col("date").cast(T.TimestampNTZType()))
    )


def metadata_v1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as tickers; those of nation 0 are not listed yet."""
    customers = table(spark, sf_dir, "customer").filter("c_nationkey <> 0")
    return _metadata(customers, F.col("c_mktsegment"), F.concat(F.lit("N"), "c_nationkey"))


def metadata_v2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The later state: nation 7 has left, sectors changed, an index turned NULL."""
    customers = table(spark, sf_dir, "customer").filter("c_nationkey <> 7")
    nation = F.col("c_nationkey")
    sector = F.when(nation < 6, "CHANGED").otherwise(F.col("c_mktsegment"))
    index = F.when(nation != 11, F.concat(F.lit("N"), nation))
    return _metadata(customers, sector, index)


def _metadata(customers: DataFrame, sector: Column, index: Column) -> DataFrame:
    return customers.select(
        F.col("c_custkey").alias("ticker"),
        F.col("c_name").alias("company_name"),
        sector.alias("sector"),
        index.alias("market_index"),
    )

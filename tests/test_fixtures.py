"""The raw tables derived from the test tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from workload import fixtures as fx

LINE = (
    "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
    "l_linestatus string, l_shipdate timestamp_ntz"
)
TRADE = [
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus",
]
DAY = dt.datetime(2000, 1, 3)


def line(order, part, number, price, day=DAY, discount=0.0, tax=0.0, flag="N"):
    return (order, part, 1, number, 2.0, price, discount, tax, flag, "O", day)


LINES = [
    # Two trades of the first order and three of the last, of which two differ late.
    line(1, 10, 2, 20.0),
    line(1, 10, 1, 30.0, flag="R"),
    line(5, 11, 1, 90.0, tax=0.08),
    line(9, 10, 3, 50.0, discount=0.1),
    line(9, 11, 3, 40.0, discount=0.5),
    line(9, 11, 2, 60.0),
    line(9, 11, 2, 60.0),
    # The first order of one ticker lies in the middle of another's.
    line(5, 20, 1, 70.0),
    line(6, 20, 1, 72.0, flag="R"),
    # Orders, days and tickers that are missing.
    line(None, 20, 4, 74.0, flag="R"),
    line(None, 20, 3, 76.0, day=DAY + dt.timedelta(days=1)),
    line(2, 20, 1, 78.0, day=None),
    line(3, 20, 1, 80.0, day=None),
    line(4, 30, 1, 82.0),
    line(7, 30, 1, 84.0, flag="R"),
    line(7, 99, 1, 86.0),
    line(7, None, 1, 88.0),
]
PARTS = [(10, "Brand#11"), (11, "Brand#11"), (20, "Brand#22"), (20, "Brand#22"), (30, None)]


@pytest.fixture
def folder(spark, tmp_path):
    for name, rows, schema in (
        ("lineitem", LINES, LINE),
        ("part", PARTS, "p_partkey long, p_brand string"),
    ):
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    return str(tmp_path)


def ends_of_whole_trades(spark, folder):
    """Open, close, adjusted close and split by the least and the greatest of all trades."""
    lines = spark.read.parquet(f"{folder}/lineitem.parquet")
    parts = spark.read.parquet(f"{folder}/part.parquet")
    trade = F.struct(*TRADE)
    bars = (
        lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy(F.col("p_brand").alias("ticker"), F.col("l_shipdate").cast("date").alias("date"))
        .agg(
            F.min(trade).alias("a"),
            F.max(trade).alias("z"),
            F.count_if(F.col("l_returnflag") == "R").alias("returned"),
        )
    )
    close = F.col("z.l_extendedprice") / F.col("z.l_quantity")
    later = F.col("returned") > (F.col("a.l_returnflag") == "R").cast("int")
    return bars.select(
        "ticker",
        "date",
        F.col("a.l_extendedprice") / F.col("a.l_quantity"),
        close,
        close * (1 - F.col("z.l_discount")),
        F.when(later, 2.0).otherwise(0.0),
    )


@pytest.mark.parametrize("sent", [fx._SENT_BARS, 0], ids=["broadcast", "shuffled"])
def test_bars_open_and_close_with_their_first_and_last_trade(spark, folder, monkeypatch, sent):
    monkeypatch.setattr(fx, "_SENT_BARS", sent)
    bars = fx.derive_market_prices(spark, folder)
    found = bars.select("ticker", "date", "open", "close", "adj_close", "stock_splits").collect()
    expected = ends_of_whole_trades(spark, folder).collect()
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, map(tuple, expected)))
    by_bar = {(r.ticker, r.date): r for r in bars.collect()}
    assert len(by_bar) == len(expected) == 5
    bar = by_bar["Brand#11", DAY.date()]
    assert (bar.open, bar.close, bar.adj_close, bar.low, bar.high) == (15.0, 20.0, 10.0, 10.0, 45.0)
    assert (bar.volume, bar.dividends, bar.stock_splits) == (14, 0.08, 0.0)


def test_only_trades_of_first_and_last_orders_are_compared_whole(spark, folder):
    plan = fx.derive_market_prices(spark, folder)._jdf.queryExecution().optimizedPlan().toString()
    compared, kept = plan.index("min(struct("), plan.index("Join LeftSemi")
    assert compared < kept  # the semi join lies below the aggregate

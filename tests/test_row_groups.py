"""Split windows give what the plain window gives."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators.rolling import with_rolling_metrics
from tidemark.operators.row_groups import group_rows, last_known, running_max, running_sum

FRAMES = [1, 2, 5, 40]


def _rows(spark, seed: int):
    """Uneven keys with gaps, a NULL key, missing values and one hot key."""
    rng = random.Random(seed)
    rows = []
    for key, size, gap in (("hot", 900, 3), ("sparse", 60, 90), (None, 200, 2), ("one", 1, 1)):
        day = dt.date(2000, 1, 1)
        for _ in range(size):
            day += dt.timedelta(days=rng.randint(1, gap))
            value = None if rng.random() < 0.2 else float(rng.randint(-50, 50))
            rows.append((key, day, value))
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "k string, d date, v double")


def _plain(df, keys):
    order = Window.partitionBy(*keys).orderBy("d")
    life = order.rowsBetween(Window.unboundedPreceding, 0)
    return df.select(
        "*",
        F.lag("v").over(order).alias("previous"),
        *(F.sum("v").over(order.rowsBetween(1 - n, 0)).alias(f"sum_{n}") for n in FRAMES),
        F.sum("v").over(life).alias("total"),
        F.max("v").over(life).alias("peak"),
        F.last("v", ignorenulls=True).over(life).alias("latest"),
    )


def _split(df, keys, max_rows):
    v = F.col("v")
    runs = {"total": running_sum(v), "peak": running_max(v), "latest": last_known(v)}
    groups = group_rows(df, keys, "d", max(FRAMES) - 1, runs, max_rows)
    assert groups.is_split
    windows = {"previous": F.lag("v").over(groups.window)}
    windows |= {f"sum_{n}": F.sum("v").over(groups.trailing(n)) for n in FRAMES}
    return groups.finish(groups.with_windows(windows)).select(*df.columns, *windows, *runs)


@pytest.mark.parametrize("max_rows", [7, 50, 300])
@pytest.mark.parametrize("seed", [1, 2])
def test_split_by_key_equals_plain(spark, seed, max_rows):
    df = _rows(spark, seed)
    expected, actual = _plain(df, ["k"]), _split(df, ["k"], max_rows)
    assert actual.columns == expected.columns
    assert sorted(map(str, actual.collect())) == sorted(map(str, expected.collect()))


@pytest.mark.parametrize("max_rows", [13, 200])
def test_split_without_key_equals_plain(spark, max_rows):
    # One row per date, so that the order is total.
    df = _rows(spark, 3).groupBy("d").agg(F.max("v").alias("v"))
    expected, actual = _plain(df, []), _split(df, [], max_rows)
    assert sorted(map(str, actual.collect())) == sorted(map(str, expected.collect()))


def test_large_blocks_pass_several_multiples(spark):
    """Years as blocks hold many times ``max_rows``; chunks stay whole and dense."""
    df = _rows(spark, 4)
    groups = group_rows(df, ["k"], "d", 4, max_rows=3, block=lambda d: F.trunc(d, "year"))
    w = Window.partitionBy("k").orderBy("d").rowsBetween(-4, 0)
    actual = groups.finish(groups.rows.select("*", F.sum("v").over(groups.trailing(5)).alias("s")))
    expected = df.select("*", F.sum("v").over(w).alias("s"))
    assert sorted(map(str, actual.collect())) == sorted(map(str, expected.collect()))


def test_small_keys_keep_the_plain_window(spark):
    df = _rows(spark, 5)
    groups = group_rows(df, ["k"], "d", 10, max_rows=1_000)
    assert not groups.is_split
    assert groups.rows is df


def test_copies_are_bounded(spark):
    """Each chunk receives its look-back and at most one block more."""
    df = _rows(spark, 6).filter("k = 'hot'")
    lookback, max_rows = 20, 100
    groups = group_rows(df, ["k"], "d", lookback, max_rows=max_rows)
    chunks = groups.rows.select("_chunk").distinct().count()
    copies = groups.rows.count() - df.count()
    assert chunks >= 8
    assert copies <= (chunks - 1) * (lookback + 31)


def test_hot_key_is_spread(spark):
    df = _rows(spark, 7)
    groups = group_rows(df, ["k"], "d", 5, max_rows=100)
    largest = groups.rows.groupBy("k", "_chunk").count().agg(F.max("count")).head()[0]
    assert largest <= 100 + 5 + 2 * 31


def test_order_columns_without_a_default_block_are_refused_at_any_size(spark):
    rows = [("a", "x", 1.0), ("a", "y", 3.0)]
    df = spark.createDataFrame(rows, "k string, d string, v double")
    with pytest.raises(TypeError, match="name a block"):
        with_rolling_metrics(df, "v", "k", "d", [2], ["avg"])
    named = with_rolling_metrics(
        df, "v", "k", "d", [2], ["avg"], max_rows=1, block=lambda d: F.substring(d, 1, 1)
    )
    assert sorted(r.avg_v_2d for r in named.collect()) == [1.0, 2.0]


def test_a_hot_month_of_minutes_is_split(spark):
    start = dt.datetime(2024, 1, 1)
    rows = [("a", start + dt.timedelta(minutes=n), float(n)) for n in range(2000)]
    df = spark.createDataFrame(rows, "k string, at timestamp_ntz, v double")
    groups = group_rows(df, ["k"], "at", 4, max_rows=100)
    sizes = [r["count"] for r in groups.rows.groupBy("_chunk").count().collect()]
    assert len(sizes) > 10 and max(sizes) < 300
    split = with_rolling_metrics(df, "v", "k", "at", [5], ["avg"], max_rows=100)
    whole = with_rolling_metrics(df, "v", "k", "at", [5], ["avg"])
    assert sorted(map(tuple, split.collect())) == sorted(map(tuple, whole.collect()))

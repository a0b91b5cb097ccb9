"""Block frames against plain frames."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators.block_frames import MERGEABLE, _chains, with_block_frames
from tidemark.operators.rolling import with_rolling_metrics

ALL = sorted(MERGEABLE)


def data(spark, seed, gaps):
    rng = random.Random(seed)
    rows = []
    for key, n in (("a", 90), ("b", 1), ("c", 23), (None, 40)):
        for i in range(n):
            value = None if rng.random() < gaps else 1e6 + rng.gauss(0, 1)
            rows.append((key, i * 3, value))
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "k string, t long, x double").repartition(3)


def results(df):
    return {(r.k, r.t): r.asDict() for r in df.collect()}


def agree(found, expected):
    assert found.keys() == expected.keys()
    for key, row in expected.items():
        for name, value in row.items():
            other = found[key][name]
            if isinstance(value, float):
                # Deviations lose digits to the mean of a million, in both ways.
                close = dict(rel_tol=1e-6, abs_tol=1e-9 if "var" not in name else 1e-8)
                assert math.isclose(other, value, **close), (key, name, other, value)
            else:
                assert other == value, (key, name, other, value)


@pytest.mark.parametrize("gaps", [0.0, 0.4, 1.0])
@pytest.mark.parametrize("sizes", [[1], [7], [3, 6, 12], [4, 6, 10, 200]])
def test_block_frames_are_plain_frames(spark, sizes, gaps):
    df = data(spark, 1, gaps)
    plain = with_rolling_metrics(df, "x", "k", "t", sizes, ALL, linear=False)
    blocks = with_block_frames(df, ["k"], "t", "x", sizes, ALL)
    assert blocks.columns == plain.columns
    agree(results(blocks), results(plain))


def test_block_frames_of_split_keys(spark):
    df = data(spark, 2, 0.2).filter("k is not null")
    options = dict(max_rows=10, block=lambda t: F.floor(t / 9))
    plain = with_rolling_metrics(df, "x", "k", "t", [5, 20], ["avg", "min"], linear=False, **options)
    blocks = with_rolling_metrics(df, "x", "k", "t", [5, 20], ["avg", "min"], linear=True, **options)
    agree(results(blocks), results(plain))


def test_equal_values_keep_their_deviation_at_zero(spark):
    df = spark.range(100).selectExpr("'a' as k", "id as t", "0.1D as x")
    rows = with_block_frames(df, ["k"], "t", "x", [9], ["stddev", "avg"]).collect()
    assert all(r.stddev_x_9d in (None, 0.0) or r.stddev_x_9d < 1e-15 for r in rows)
    assert all(math.isclose(r.avg_x_9d, 0.1, rel_tol=1e-15) for r in rows)


def test_nested_sizes_share_their_sorts(spark):
    assert _chains([21, 63, 252]) == [[252, 63, 21]]
    assert _chains([10, 4, 20]) == [[20, 10], [4]]
    df = data(spark, 3, 0.0)
    plan = with_block_frames(df, ["k"], "t", "x", [21, 63, 252], ["avg"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Sort [") == 4
    assert text.count("Exchange hashpartitioning") == 1


def test_long_frames_are_linear_by_default(spark):
    df = data(spark, 4, 0.0)

    def plan(sizes, names):
        out = with_rolling_metrics(df, "x", "k", "t", sizes, names)
        return out._jdf.queryExecution().executedPlan().toString()

    assert "lag(" in plan([252], ["avg"])
    assert "lag(" not in plan([21], ["avg"])
    assert "lag(" not in plan([252], ["avg", "skewness"])

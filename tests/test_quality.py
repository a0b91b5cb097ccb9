"""Checks, freshness and comparisons."""

import pytest

from tidemark.operators import quality as q
from pyspark.sql import functions as F

from tidemark.operators.compare import compare_by_digest, compare_relations, row_count_matches
from tidemark.plans import checks as configured


def failures(df, *checks):
    report = q.run_checks(df, "t", checks).collect()
    return {(r.check_name, r.column_name): r.failures for r in report}


def test_checks(spark):
    df = spark.createDataFrame(
        [(1, "a", 1.0), (1, "a", 5.0), (2, "b", None), (None, None, 9.0), (None, "c", 0.0)],
        "k int, s string, v double",
    )
    assert failures(
        df,
        q.not_null("k"),
        q.not_null("v"),
        q.between("v", 0.0, 5.0),
        q.unique("k"),
        q.unique_combination("k", "s"),
        q.unique_combination("k", "v"),
        q.accepted_values("s", ["a"]),
    ) == {
        ("not_null", "k"): 2,
        ("not_null", "v"): 1,
        ("between", "v"): 1,
        ("unique", "k"): 1,
        ("unique_combination", "k, s"): 1,
        ("unique_combination", "k, v"): 0,
        ("accepted_values", "s"): 2,
    }


def test_empty_table_passes(spark):
    df = spark.createDataFrame([], "k int, v double")
    assert set(failures(df, q.not_null("k"), q.between("v", 0, 1), q.unique("k")).values()) == {0}


def test_failing_rows(spark):
    df = spark.createDataFrame([(1,), (1,), (7,)], "k int")
    assert [r.k for r in q.between("k", 0, 5).failures(df).collect()] == [7]
    assert [tuple(r) for r in q.unique("k").failures(df).collect()] == [(1, 2)]


def test_require(spark):
    df = spark.createDataFrame([(1,), (None,)], "k int")
    q.require(q.run_checks(df, "t", [q.unique("k")]))
    with pytest.raises(q.ChecksFailed) as caught:
        q.require(q.run_checks(df, "t", [q.unique("k"), q.not_null("k")]))
    assert caught.value.args[0] == [("t", "not_null", "k", 1)]


def test_configured_checks():
    tables = [
        configured.RAW_SERIES,
        configured.RAW_PRICES,
        configured.STG_SERIES,
        configured.STG_PRICES,
        configured.MACRO_PIVOTED,
        configured.MARKET_RETURNS,
        configured.MACRO_INDICATORS,
        configured.STOCK_PERFORMANCE,
    ]
    names = [c.name for table in tables for c in table]
    assert {n: names.count(n) for n in names} == {
        "not_null": 30,
        "unique": 2,
        "accepted_values": 2,
        "unique_combination": 2,
        "between": 3,
    }


@pytest.mark.parametrize(
    ("as_of", "status"),
    [
        ("2024-01-04 00:00:00", "pass"),
        ("2024-01-04 00:00:01", "warn"),
        ("2024-01-08 00:00:00", "warn"),
        ("2024-01-08 00:00:01", "error"),
    ],
)
def test_freshness(spark, as_of, status):
    df = spark.sql("select timestamp_ntz '2024-01-01 00:00:00' as at")
    assert q.freshness(df, "at", as_of, 3, 7).head().status == status


def test_no_rows_are_stale(spark):
    df = spark.sql("select timestamp_ntz '2024-01-01 00:00:00' as at").limit(0)
    assert q.freshness(df, "at", "2024-01-01 00:00:00", 3, 7).head().status == "error"


def test_compare(spark):
    a = spark.createDataFrame([(1, None), (1, None), (2, "x")], "k int, v string")
    b = spark.createDataFrame([(1, None), (3, "x"), (4, "x")], "k int, v string")
    found = {(r.in_a, r.in_b): r.rows for r in compare_relations(a, b).collect()}
    assert found == {(True, True): 1, (True, False): 1, (False, True): 2}


def test_row_count(spark):
    assert [tuple(r) for r in row_count_matches(spark.range(3), 3).collect()] == [(3, 3, True)]
    assert not row_count_matches(spark.range(3), 4).head().matches


def counts(a, b, **options):
    found = compare_by_digest(a, b, ["k"], **options).collect()
    return {(r.in_a, r.in_b): r.rows for r in found}


def test_compare_by_digest_counts_repeated_rows(spark):
    schema = "k int, v string, d date"
    rows = [(i % 50, None if i % 7 == 0 else f"v{i % 5}", None) for i in range(400)]
    a = spark.createDataFrame(rows, schema)
    assert counts(a, a.repartition(5)) == {(True, True): 400}
    more = spark.createDataFrame([*rows[:-3], (1, "new", None), rows[0]], schema)
    assert counts(a, more) == {(True, True): 397, (True, False): 3, (False, True): 2}
    assert counts(a, a.limit(0)) == {(True, False): 400}
    assert counts(a.limit(0), a.limit(0)) == {}


def test_compare_by_digest_reads_differing_buckets_only(spark):
    """Equal buckets are not read again: a value that fails to be read there does no harm."""
    a = spark.range(1000).selectExpr("cast(id as int) as k", "id * 2 as v")
    b = a.withColumn("v", F.when(F.col("k") == 17, F.lit(-1)).otherwise(F.col("v")))
    assert counts(a, b) == {(True, True): 999, (True, False): 1, (False, True): 1}
    period = F.floor(F.col("k") / 100)
    assert counts(a, b, period=period, buckets=4) == counts(a, b)

"""Comparison of two relations."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import materialize

# Buckets of keys in a period, whose digests are compared before any rows are.
BUCKETS = 256


def compare_relations(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows by whether they occur in ``a``, in ``b`` or in both."""
    columns = a.columns
    tagged = a.select("*", F.lit(True).alias("in_a"), F.lit(False).alias("in_b")).unionByName(
        b.select(*columns, F.lit(False).alias("in_a"), F.lit(True).alias("in_b"))
    )
    rows = tagged.groupBy(*columns).agg(F.max("in_a").alias("in_a"), F.max("in_b").alias("in_b"))
    return rows.groupBy("in_a", "in_b").agg(F.count(F.lit(1)).alias("rows"))


def digests(
    df: DataFrame, keys: Sequence[str], period: Column | None = None, buckets: int = BUCKETS
) -> DataFrame:
    """Per period and bucket of keys: the number of rows and two sums of their hashes.

    The sums do not depend on the order of the rows and count repeated ones, so equal
    digests mean equal rows, but for a chance of about 2**-128 a bucket.
    """
    columns = [F.col(c) for c in df.columns]

    def total(seed: int) -> Column:
        return F.sum(F.xxhash64(*columns, F.lit(seed)).cast("decimal(38,0)"))

    return df.groupBy(*_leaf(keys, period, buckets)).agg(
        F.count(F.lit(1)).alias("n"), total(1).alias("first"), total(2).alias("second")
    )


def compare_by_digest(
    a: DataFrame,
    b: DataFrame,
    keys: Sequence[str],
    period: Column | None = None,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Rows, counted as often as they occur, by whether they are in ``a``, ``b`` or both.

    Digests are compared first, in one pass over each side; rows are read again and
    compared only where they differ, in parts of a stored table that the period prunes.
    """
    b = b.select(*a.columns)
    left, right = digests(a, keys, period, buckets), digests(b, keys, period, buckets)
    same_leaf = F.col("a._period").eqNullSafe(F.col("b._period"))
    same_leaf &= F.col("a._bucket") == F.col("b._bucket")
    equal = reduce(
        lambda x, y: x & y, (F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in ("n", "first", "second"))
    )
    leaves = materialize(
        left.alias("a")
        .join(right.alias("b"), same_leaf, "full_outer")
        .select(
            F.coalesce("a._period", "b._period").alias("_of_period"),
            F.coalesce("a._bucket", "b._bucket").alias("_of_bucket"),
            F.coalesce("a.n", F.lit(0)).alias("n"),
            equal.alias("equal"),
        ),
        "digests",
    )
    apart = leaves.filter(~F.col("equal"))
    both = leaves.filter("equal").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"))
    found = both.select(F.lit(True).alias("in_a"), F.lit(True).alias("in_b"), "rows")
    if not apart.isEmpty():
        found = found.unionByName(_compared(a, b, apart, keys, period, buckets))
    return found.groupBy("in_a", "in_b").agg(F.sum("rows").alias("rows")).filter("rows > 0")


def _leaf(keys: Sequence[str], period: Column | None, buckets: int) -> list[Column]:
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).alias("_bucket")
    return [(F.lit("") if period is None else period).cast("string").alias("_period"), bucket]


def _compared(
    a: DataFrame,
    b: DataFrame,
    apart: DataFrame,
    keys: Sequence[str],
    period: Column | None,
    buckets: int,
) -> DataFrame:
    """Rows of the buckets whose digests differ, one by one."""
    in_leaf = F.col("_period").eqNullSafe(F.col("_of_period"))
    in_leaf &= F.col("_bucket") == F.col("_of_bucket")

    def rows(side: DataFrame, of_a: int) -> DataFrame:
        kept = side.select("*", *_leaf(keys, period, buckets)).join(apart, in_leaf, "left_semi")
        return kept.select(
            *side.columns, F.lit(of_a).alias("_in_a"), F.lit(1 - of_a).alias("_in_b")
        )

    counted = (
        rows(a, 1)
        .unionByName(rows(b, 0))
        .groupBy(*a.columns)
        .agg(F.sum("_in_a").alias("_a"), F.sum("_in_b").alias("_b"))
    )
    shared = F.least("_a", "_b")
    states = F.array(
        F.struct(F.lit(True).alias("in_a"), F.lit(True).alias("in_b"), shared.alias("rows")),
        F.struct(F.lit(True).alias("in_a"), F.lit(False).alias("in_b"), (F.col("_a") - shared).alias("rows")),
        F.struct(F.lit(False).alias("in_a"), F.lit(True).alias("in_b"), (F.col("_b") - shared).alias("rows")),
    )
    return counted.select(F.explode(states).alias("_state")).select("_state.*")


def row_count_matches(df: DataFrame, expected: int) -> DataFrame:
    """One row: the row count, what it should be, and whether they agree."""
    count = F.count(F.lit(1))
    return df.agg(
        count.alias("rows"),
        F.lit(expected).cast("bigint").alias("expected_rows"),
        (count == expected).alias("matches"),
    )

"""Sums over all earlier rows of an order, without one task that holds the order."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import free_names
from tidemark.session import materialize


def sums_before(
    rows: DataFrame, within: Sequence[str], order: Sequence[str], values: dict[str, Column]
) -> DataFrame:
    """The rows with, for each name of `values`, the sum of its column over the rows before.

    Before a row is what comes earlier by `order` among the rows with equal `within`
    (null equals null). Rows equal in both should be interchangeable, for their order is
    any. Ranges of (within, order) are stored; the totals of whole ranges are summed
    first, one row a range and group, and only the rest of the sum runs inside a range.
    So a group with any share of the rows is spread over as many tasks as it has ranges.
    """
    part, *totals = free_names(rows, "_part", *(f"_{name}_total" for name in values))
    keys = [part, *within]
    laid = materialize(
        rows.repartitionByRange(*within, *order).withColumn(part, F.spark_partition_id()),
        "ranges",
    )
    sums = [F.sum(value).alias(total) for value, total in zip(values.values(), totals)]
    ranges = laid.groupBy(*keys).agg(*sums)
    earlier = Window.partitionBy(*within).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    ranges = materialize(
        ranges.select(*keys, *(F.sum(total).over(earlier).alias(total) for total in totals)),
        "range-sums",
    )
    ranges = ranges.select(*(F.col(key).alias(f"{key}_of_range") for key in keys), *totals)
    same = reduce(
        lambda a, b: a & b, (F.col(key).eqNullSafe(F.col(f"{key}_of_range")) for key in keys)
    )
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0)
    before = [
        (F.coalesce(F.col(total), zero) + F.coalesce(F.sum(value).over(inside), zero)).alias(name)
        for (name, value), total in zip(values.items(), totals)
    ]
    return laid.join(ranges, same).select(*rows.columns, *before)

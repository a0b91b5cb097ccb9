"""Rolling metrics over any metric, key and order column."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame

from tidemark.functions.rolling import rolling_columns
from tidemark.operators.block_frames import MERGEABLE, with_block_frames
from tidemark.operators.row_groups import MAX_ROWS, group_rows

# Rows of all frames together from which two passes are cheaper than the frames.
LINEAR_FROM = 128


def with_rolling_metrics(
    df: DataFrame,
    metric: str,
    key: str,
    order_by: str,
    sizes: Sequence[int],
    aggregations: Sequence[str],
    max_rows: int = MAX_ROWS,
    block: Callable[[Column], Column] | None = None,
    linear: bool | None = None,
) -> DataFrame:
    """``df`` with ``{aggregation}_{metric}_{size}d`` for every combination.

    ``max_rows`` and ``block`` as for ``group_rows``. ``linear`` asks for block frames,
    whose cost does not grow with the sizes, or for plain frames; without it, block
    frames are used where the aggregations can be merged and the frames are long. The
    two may differ in the last digits.
    """
    groups = group_rows(
        df, [key], order_by, lookback=max(sizes) - 1, max_rows=max_rows, block=block
    )
    if linear is None:
        linear = MERGEABLE.issuperset(aggregations) and sum(sizes) >= LINEAR_FROM
    if linear:
        keys = groups.partition_keys
        rows = with_block_frames(groups.rows, keys, order_by, metric, sizes, aggregations)
        return groups.finish(rows)
    metrics = rolling_columns(metric, groups.window, sizes, aggregations)
    return groups.finish(groups.rows.select("*", *metrics))

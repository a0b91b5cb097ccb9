"""Generator of rolling-window columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F


def rolling_columns(
    metric: str,
    window: WindowSpec,
    sizes: Sequence[int],
    aggregations: Sequence[str],
) -> list[Column]:
    """One column ``{aggregation}_{metric}_{size}d`` per size and aggregation.

    Any aggregate function known to Spark may be named. Frames count rows and
    end at the current one; the first rows use what there is.
    """
    return [
        F.call_function(aggregation, F.col(metric))
        .over(window.rowsBetween(1 - size, Window.currentRow))
        .alias(f"{aggregation}_{metric}_{size}d")
        for size in sizes
        for aggregation in aggregations
    ]

"""Forward fill within a key."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.row_groups import MAX_ROWS, group_rows, last_known


def forward_fill(
    df: DataFrame,
    keys: Sequence[str],
    order_by: str,
    columns: Sequence[str],
    max_rows: int = MAX_ROWS,
    block: Callable[[Column], Column] | None = None,
) -> DataFrame:
    """Replace missing values by the latest known one of the same key.

    ``max_rows`` and ``block`` as for ``group_rows``.
    """
    runs = {c: last_known(F.col(c)) for c in columns}
    groups = group_rows(df, keys, order_by, runs=runs, max_rows=max_rows, block=block)
    return groups.finish(groups.with_windows({})).select(*df.columns)

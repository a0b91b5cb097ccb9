"""Row-based windows that do not need a whole key in one task.

``Window.partitionBy(key)`` sends every row of a key to one task, and a window
without keys sends the whole table. ``group_rows`` first counts rows per key, a
scan of the key column with map-side combine. While every key has at most
``max_rows`` rows, the ordinary window over one exchange is the best plan and is
used unchanged. Keys above that are cut into chunks of consecutive calendar
blocks, counted per key and block:

* chunks begin at exact row counts, so each holds about ``max_rows`` rows;
* the blocks that hold the last ``lookback`` rows before a chunk are copied
  into it, so that bounded frames see the rows they would see in one piece;
* totals over all earlier blocks travel with the chunk, so that frames from the
  beginning of the key need only the chunk's own rows.

Blocks depend on the order column alone, so a task that is run again produces
the same chunks.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import materialize

MAX_ROWS = 1_000_000

_BLOCK, _OWN, _CHUNK, _REACH = "_block", "_own_chunk", "_chunk", "_reached_chunks"
_COPY = "_is_copy"


@dataclass(frozen=True)
class Running:
    """A value accumulated from the first row of a key to the current row."""

    partial: Callable[[Column | None], Column]
    over_blocks: Callable[[Column], Column]
    over_rows: Callable[[Callable[[Column], Column]], Column]
    merge: Callable[[Column, Column], Column]


def running_sum(value: Column) -> Running:
    return Running(
        partial=lambda _: F.sum(value),
        over_blocks=F.sum,
        over_rows=lambda own: F.sum(own(value)),
        merge=lambda carried, local: F.coalesce(carried + local, local, carried),
    )


def running_max(value: Column) -> Running:
    return Running(
        partial=lambda _: F.max(value),
        over_blocks=F.max,
        over_rows=lambda own: F.max(own(value)),
        merge=F.greatest,
    )


def last_known(value: Column) -> Running:
    """The latest value that is not NULL."""
    return Running(
        partial=lambda order: F.max_by(value, F.when(value.isNotNull(), order)),
        over_blocks=lambda partial: F.last(partial, ignorenulls=True),
        over_rows=lambda own: F.last(own(value), ignorenulls=True),
        merge=lambda carried, local: F.coalesce(local, carried),
    )


@dataclass(frozen=True)
class RowGroups:
    """Rows ready for windows: ``rows`` may hold copies until ``finish``."""

    rows: DataFrame
    keys: tuple[str, ...]
    order_by: str
    runs: Mapping[str, Running]
    is_split: bool

    @property
    def partition_keys(self) -> list[str]:
        return [*self.keys, _CHUNK] if self.is_split else list(self.keys)

    @property
    def window(self) -> WindowSpec:
        return Window.partitionBy(*self.partition_keys).orderBy(self.order_by)

    def trailing(self, size: int) -> WindowSpec:
        """Frame of the current row and the ``size - 1`` rows before it."""
        return self.window.rowsBetween(1 - size, Window.currentRow)

    def of_large_keys(self) -> RowGroups:
        """Only the keys that were split."""
        return replace(self, rows=self.rows.filter(F.col(_CHUNK) > 0))

    def with_windows(self, columns: Mapping[str, Column]) -> DataFrame:
        """``rows`` with window columns and with the running values by name.

        All of them come from one pass over the sorted rows.
        """
        frame = self.window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        if not self.is_split:
            runs = {n: r.over_rows(lambda value: value).over(frame) for n, r in self.runs.items()}
            return self.rows.withColumns({**columns, **runs})

        def own(value: Column) -> Column:
            return F.when(~F.col(_COPY), value)

        local = {_local(n): r.over_rows(own).over(frame) for n, r in self.runs.items()}
        merged = {
            n: r.merge(F.col(_carried(n)), F.col(_local(n))) for n, r in self.runs.items()
        }
        return self.rows.withColumns({**columns, **local}).withColumns(merged).drop(*local)

    def finish(self, df: DataFrame) -> DataFrame:
        """Drop copied rows and helper columns from a frame built on ``rows``."""
        if not self.is_split:
            return df
        helpers = [_CHUNK, _COPY, *(_carried(name) for name in self.runs)]
        return df.filter(~F.col(_COPY)).drop(*helpers)


def group_rows(
    df: DataFrame,
    keys: Sequence[str],
    order_by: str,
    lookback: int = 0,
    runs: Mapping[str, Running] | None = None,
    max_rows: int | None = MAX_ROWS,
    block: Callable[[Column], Column] | None = None,
    counted: DataFrame | None = None,
) -> RowGroups:
    """Prepare ``df`` for windows by ``keys`` in the order of ``order_by``.

    ``lookback`` is the longest bounded frame less one, ``runs`` the running
    values wanted. ``block`` maps the order column to a coarser one that never
    decreases; one block is the least that a chunk can hold, and without one
    the order column's type chooses (``default_block``). Running sums of split
    keys add in another order than those of whole keys and may differ from them
    in the last digits, by about 1e-14 of the value. ``max_rows=None``
    states that the keys are already known to be small and skips the count.
    ``counted`` holds the rows of ``df`` whose keys may be large, where others
    are known to be small.
    """
    runs = dict(runs or {})
    block = block or default_block(df.schema[order_by].dataType)
    if max_rows is None or (counted is None and not _has_large_key(df, keys, max_rows)):
        return RowGroups(df, tuple(keys), order_by, runs, is_split=False)
    layout = materialize(
        _chunk_layout(
            df if counted is None else counted, keys, order_by, lookback, runs, max_rows, block
        ),
        "row-groups",
    )
    rows = _with_chunks(df, layout, keys, order_by, runs, block)
    return RowGroups(rows, tuple(keys), order_by, runs, is_split=True)


def default_block(order_type: T.DataType) -> Callable[[Column], Column]:
    """Months of dates, hours of timestamps, runs of 256 whole numbers."""
    if isinstance(order_type, T.DateType):
        return lambda day: F.trunc(day, "month")
    if isinstance(order_type, (T.TimestampType, T.TimestampNTZType)):
        return lambda moment: F.date_trunc("hour", moment)
    if isinstance(order_type, T.IntegralType):
        return lambda number: F.floor(number / 256).cast("long")
    raise TypeError(f"name a block for an order column of type {order_type.simpleString()}")


def _has_large_key(df: DataFrame, keys: Sequence[str], max_rows: int) -> bool:
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    return not counts.filter(F.col("_rows") > max_rows).isEmpty()


def _carried(name: str) -> str:
    return f"_carried_{name}"


def _local(name: str) -> str:
    return f"_local_{name}"


def _key(name: str) -> str:
    return f"_key_{name}"


def _chunk_layout(
    df: DataFrame,
    keys: Sequence[str],
    order_by: str,
    lookback: int,
    runs: Mapping[str, Running],
    max_rows: int,
    block: Callable[[Column], Column],
) -> DataFrame:
    """Blocks of the keys above ``max_rows``: own chunk, reached chunks, carry."""
    order = F.col(order_by)
    partials = [run.partial(order).alias(_carried(name)) for name, run in runs.items()]
    blocks = df.groupBy(*keys, block(order).alias(_BLOCK)).agg(
        F.count(F.lit(1)).alias("_rows"), *partials
    )
    of_key = Window.partitionBy(*keys)
    by_block = of_key.orderBy(_BLOCK)
    earlier = by_block.rowsBetween(Window.unboundedPreceding, -1)
    large = (
        blocks.withColumn("_total", F.sum("_rows").over(of_key))
        .filter(F.col("_total") > max_rows)
        .withColumns(
            {
                "_before": F.coalesce(F.sum("_rows").over(earlier), F.lit(0)),
                **{_carried(n): r.over_blocks(F.col(_carried(n))).over(earlier) for n, r in runs.items()},
            }
        )
        # Numbered without gaps, since a large block may pass several multiples.
        .withColumn("_cut", F.expr(f"_before div {max_rows}"))
        .withColumn(_OWN, F.dense_rank().over(of_key.orderBy("_cut")))
    )
    in_chunk = Window.partitionBy(*keys, _OWN).orderBy(_BLOCK)
    large = large.withColumns(
        {_carried(n): F.first(F.col(_carried(n))).over(in_chunk) for n in runs}
    )
    last = F.col(_OWN)
    if lookback:
        # A block reaches every chunk that begins less than ``lookback`` rows
        # after its end, and its end is where the next block begins.
        ahead = of_key.orderBy("_before").rangeBetween(Window.currentRow, lookback - 1)
        large = large.withColumn("_ahead", F.max(_OWN).over(ahead))
        last = F.coalesce(F.lead("_ahead").over(by_block), last)
    return large.select(
        *(F.col(k).alias(_key(k)) for k in keys),
        F.col(_BLOCK).alias(_key(_BLOCK)),
        _OWN,
        F.sequence(F.col(_OWN), last).alias(_REACH),
        *(_carried(n) for n in runs),
    )


def _with_chunks(
    df: DataFrame,
    layout: DataFrame,
    keys: Sequence[str],
    order_by: str,
    runs: Mapping[str, Running],
    block: Callable[[Column], Column],
) -> DataFrame:
    """Rows with their chunk, once more for every later chunk they reach."""
    names = [*keys, _BLOCK]
    rows = df.withColumn(_BLOCK, block(F.col(order_by)))
    same_block = [rows[n].eqNullSafe(layout[_key(n)]) for n in names]
    # Small keys are not in the layout and are one chunk, number 0; others count from 1.
    own, reached = F.coalesce(_OWN, F.lit(0)), F.coalesce(_REACH, F.array(F.lit(0)))
    return rows.join(layout, same_block, "left").select(
        *df.columns,
        *(_carried(n) for n in runs),
        own.alias(_OWN),
        F.explode(reached).alias(_CHUNK),
    ).select(
        *df.columns,
        *(_carried(n) for n in runs),
        _CHUNK,
        (F.col(_CHUNK) != F.col(_OWN)).alias(_COPY),
    )

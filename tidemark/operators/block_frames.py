"""Sliding aggregates whose cost does not grow with the length of the frame.

The rows of a key are numbered and cut into blocks as long as the frame. A frame of s
rows that ends at a row is then the rest of the block before, from the row s - 1
earlier on, and the beginning of its own block. Two running passes, one forward and one
backward inside the blocks, give the states of all beginnings and rests, and a frame
merges two of them. States are count, mean and squared deviations, minimum and maximum;
nothing is subtracted, so no digits are lost. A plain frame adds up its s rows again
for each row.

Blocks of frames whose lengths divide each other lie inside each other, so that one
sort serves the forward passes of all of them and one the backward passes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Aggregations with a state that can be merged.
MERGEABLE = frozenset(
    ["avg", "mean", "sum", "count", "min", "max", "stddev", "stddev_samp", "stddev_pop"]
    + ["std", "variance", "var_samp", "var_pop"]
)

_ROW = "_frame_row"
_DEVIATIONS = frozenset(["stddev", "stddev_samp", "stddev_pop", "std"]) | frozenset(
    ["variance", "var_samp", "var_pop"]
)


def with_block_frames(
    rows: DataFrame,
    keys: Sequence[str],
    order_by: str,
    metric: str,
    sizes: Sequence[int],
    aggregations: Sequence[str],
) -> DataFrame:
    """``rows`` with ``{aggregation}_{metric}_{size}d``, as over plain trailing frames."""
    whole = Window.partitionBy(*keys).orderBy(order_by)
    out = rows.withColumn(_ROW, F.row_number().over(whole) - 1)
    value = F.col(metric)
    wanted = set(aggregations)
    for chain in _chains(sizes):
        out = _running(out, keys, order_by, value, chain, wanted)
    # Rows that are equal in the order keep the numbers they got.
    numbered = Window.partitionBy(*keys).orderBy(_ROW)
    # A frame that is its whole block needs no rest of the block before.
    out = out.withColumns(
        {
            _earlier(size): F.when(
                F.col(_ROW) % size != size - 1, F.lag(_rest(size), size - 1).over(numbered)
            )
            for size in sizes
        }
    )
    columns = {}
    for size in sizes:
        for aggregation in aggregations:
            columns[f"{aggregation}_{metric}_{size}d"] = _merged(
                aggregation, F.col(_begun(size)), F.col(_earlier(size))
            )
    return out.select(*rows.columns, *(column.alias(name) for name, column in columns.items()))


def _chains(sizes: Sequence[int]) -> list[list[int]]:
    """The sizes in groups, each of which holds multiples of the next one, longest first."""
    chains: list[list[int]] = []
    for size in sorted(set(sizes), reverse=True):
        chain = next((c for c in chains if c[-1] % size == 0), None)
        if chain is None:
            chains.append([size])
        else:
            chain.append(size)
    return chains


def _running(
    rows: DataFrame,
    keys: Sequence[str],
    order_by: str,
    value: Column,
    chain: Sequence[int],
    wanted: set[str],
) -> DataFrame:
    """States of the beginnings and of the rests of the blocks of nested sizes.

    Later blocks come first in the backward pass: their numbers are negated, so that one
    ascending order of (keys, blocks) serves the windows of all sizes.
    """
    forward = [f"_block_{size}" for size in chain]
    backward = [f"_back_{size}" for size in chain]
    out = rows.withColumns(
        {
            **{n: F.floor(F.col(_ROW) / size) for n, size in zip(forward, chain)},
            **{n: -F.floor(F.col(_ROW) / size) for n, size in zip(backward, chain)},
        }
    )
    for blocks, order, name in (
        (forward, F.col(_ROW).asc(), _begun),
        (backward, F.col(_ROW).desc(), _rest),
    ):
        states = {}
        for depth, size in enumerate(chain, start=1):
            window = (
                Window.partitionBy(*keys, *blocks[:depth])
                .orderBy(*blocks[depth:], order)
                .rowsBetween(Window.unboundedPreceding, Window.currentRow)
            )
            states[name(size)] = _state(value, window, wanted)
        out = out.withColumns(states)
    return out.drop(*forward, *backward)


def _state(value: Column, window, wanted: set[str]) -> Column:
    """What the aggregations need of a stretch of rows."""
    parts = [F.count(value).over(window).alias("n")]
    if wanted & ({"avg", "mean"} | _DEVIATIONS):
        parts.append(F.avg(value).over(window).alias("mean"))
    if wanted & _DEVIATIONS:
        parts.append(F.var_pop(value).over(window).alias("variance"))
    parts += [
        F.call_function(name, value).over(window).alias(name)
        for name in ("sum", "min", "max")
        if name in wanted
    ]
    return F.struct(*parts)


def _merged(aggregation: str, a: Column, b: Column) -> Column:
    """An aggregation over two stretches, the second of which may be missing."""
    n_a, n_b = a["n"], F.coalesce(b["n"], F.lit(0))
    n = n_a + n_b
    if aggregation == "count":
        return n
    if aggregation == "sum":
        return F.coalesce(a["sum"] + b["sum"], a["sum"], b["sum"])
    if aggregation in ("min", "max"):
        pick = F.least if aggregation == "min" else F.greatest
        return pick(a[aggregation], b[aggregation])
    mean_a, mean_b = F.coalesce(a["mean"], F.lit(0.0)), F.coalesce(b["mean"], F.lit(0.0))
    apart = mean_b - mean_a
    if aggregation in ("avg", "mean"):
        both = mean_a + apart * n_b / F.when(n > 0, n)
        return F.when(n_a == 0, b["mean"]).when(n_b == 0, a["mean"]).otherwise(both)
    squares = F.coalesce(a["variance"], F.lit(0.0)) * n_a
    squares += F.coalesce(b["variance"], F.lit(0.0)) * n_b
    squares += F.when((n_a > 0) & (n_b > 0), apart * apart * n_a * n_b / n).otherwise(0.0)
    over = n if aggregation in ("stddev_pop", "var_pop") else n - 1
    variance = squares / F.when(over > 0, over)
    return F.sqrt(variance) if aggregation.startswith("std") else variance


def _begun(size: int) -> str:
    return f"_begun_{size}"


def _rest(size: int) -> str:
    return f"_rest_{size}"


def _earlier(size: int) -> str:
    return f"_earlier_{size}"

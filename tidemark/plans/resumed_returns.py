"""Market returns extended by new quotes instead of rebuilt.

What the metrics of a ticker need to go on from the end of a period is small: its last
quote, the sum of its returns, its peak and its last 62 returns with their volumes.
This state is stored for the newest periods, a part of a table each. When quotes of
some periods have come or changed, the state before the first of them and the quotes
from there on give the same returns as a full build; earlier periods are not read.

Which periods have changed is told by the manifests: the stored returns note the version
of the quotes they were made from, and parts that are the same files are the same rows.
Returns and states are two tables and two commits. The states note which version of the
returns they belong to; if a run fails between the two, the next one finds that out and
derives the states from the stored returns.

The sums are those of a full build but added in another order, so they may differ in
the last digits (about 1e-14).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators.row_groups import MAX_ROWS, group_rows, running_max, running_sum
from tidemark.plans.market import (
    QUARTER_ROWS,
    int_market_returns,
    return_columns,
    valid_returns,
    with_metrics,
)
from tidemark.plans.staging import typed_prices
from tidemark.schemas import PRICES_SCHEMA
from tidemark.sources import versions
from tidemark.sources.tables import (
    NULL_PART,
    periods_of,
    present,
    read_periods,
    read_table,
    replace_periods,
    write_table,
)
from tidemark.sources.versions import PART, Version

# Newest periods whose states are kept. Changes further back lead to a full build.
KEPT_STATES = 10
ORDER = ["ticker", "trade_date"]

_TAIL = "tail array<struct<trade_date:date,log_return_daily:double,volume:bigint>>"
STATE = (
    "ticker string, quote_date date, quote_adj_close double, total_return double, "
    f"running_peak double, {_TAIL}"
)
_MADE_FROM, _STATE_OF = "made_from", "state_of"


# One step: returns and state after some more quotes


def extended_returns(raw: DataFrame, state: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """Returns of the raw quotes, all of which lie after those of the state."""
    known = state.select("ticker", F.col("quote_date").alias("trade_date"), "quote_adj_close")
    last = known.filter("trade_date is not null").select(
        "ticker",
        "trade_date",
        F.col("quote_adj_close").alias("price_adj_close"),
        F.lit(True).alias("_known"),
    )
    quotes = group_rows(
        typed_prices(raw).withColumn("_known", F.lit(False)).unionByName(
            last, allowMissingColumns=True
        ),
        ["ticker"],
        "trade_date",
        lookback=1,
        max_rows=max_rows,
    )
    fresh = valid_returns(quotes).filter(~F.col("_known"))
    tail = state.select("ticker", F.explode("tail").alias("_row")).select(
        "ticker", "_row.*", F.lit(True).alias("_known")
    )
    own = ~F.col("_known")
    groups = group_rows(
        fresh.unionByName(tail, allowMissingColumns=True),
        ["ticker"],
        "trade_date",
        lookback=QUARTER_ROWS - 1,
        runs={
            "own_return": running_sum(F.when(own, F.col("log_return_daily"))),
            "own_peak": running_max(F.when(own, F.col("price_adj_close"))),
        },
        max_rows=max_rows,
    )
    carried = state.select("ticker", "total_return", "running_peak")
    own_return, own_peak = F.col("own_return"), F.col("own_peak")
    metrics = with_metrics(groups).filter(own).join(carried, "ticker", "left")
    return return_columns(
        metrics.withColumns(
            {
                "total_return": F.coalesce(F.col("total_return") + own_return, own_return),
                "running_peak": F.greatest("running_peak", own_peak),
            }
        )
    )


def next_state(state: DataFrame, raw: DataFrame, returns: DataFrame) -> DataFrame:
    """The state after the quotes of ``raw`` and their ``returns``, later than its own."""
    quotes = typed_prices(raw).groupBy("ticker").agg(
        F.max(F.struct("trade_date", "price_adj_close")).alias("_quote")
    )
    totals = returns.groupBy("ticker").agg(
        F.max(F.struct("trade_date", "cumulative_return_index", "running_peak")).alias("_last")
    )
    rows = state.select("ticker", F.explode("tail").alias("_row")).select("ticker", "_row.*")
    rows = rows.unionByName(returns.select(*rows.columns))
    newest = Window.partitionBy("ticker").orderBy(F.desc("trade_date"))
    tails = (
        rows.withColumn("_age", F.row_number().over(newest))
        .filter(F.col("_age") < QUARTER_ROWS)
        .groupBy("ticker")
        .agg(
            F.array_sort(
                F.collect_list(F.struct("trade_date", "log_return_daily", "volume"))
            ).alias("_tail")
        )
    )
    joined = (
        state.join(quotes, "ticker", "full_outer")
        .join(totals, "ticker", "left")
        .join(tails, "ticker", "left")
    )
    return joined.select(
        "ticker",
        F.coalesce("_quote.trade_date", "quote_date").alias("quote_date"),
        F.when(F.col("_quote").isNotNull(), F.col("_quote.price_adj_close"))
        .otherwise(F.col("quote_adj_close"))
        .alias("quote_adj_close"),
        F.coalesce(F.ln("_last.cumulative_return_index"), "total_return").alias("total_return"),
        F.coalesce("_last.running_peak", "running_peak").alias("running_peak"),
        F.coalesce("_tail", "tail").alias("tail"),
    )


def no_state(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], STATE)


# The stored tables


def refresh_returns(
    spark: SparkSession,
    prices_path: str,
    returns_path: str,
    state_path: str,
    unit: str = "month",
    full_refresh: bool = False,
    max_rows: int = MAX_ROWS,
    kept_states: int = KEPT_STATES,
) -> list[str] | None:
    """Bring the stored returns up to the stored quotes.

    Returns the periods that were written, None for a full build.
    """
    prices = present(spark, prices_path)
    returns = versions.newest(spark, returns_path)
    before = None if full_refresh else _made_from(spark, prices_path, returns)
    changed = None if before is None else _changed(before, prices)
    if before is not None:
        # Nothing to do, unless the last run failed before it stored its states.
        _bring_states(spark, prices_path, before, returns_path, returns, state_path, kept_states)
    if changed == []:
        return []
    note = {_MADE_FROM: str(prices.number)}
    first = None if changed is None else min(changed)
    state = None if first is None else _state_before(spark, prices, returns, state_path, first)
    if state is None:
        first = None
        raw = read_table(spark, prices_path, PRICES_SCHEMA, prices)
        built = int_market_returns(raw, max_rows)
        returns = write_table(built, returns_path, "trade_date", unit, ORDER, note)
        written = None
    else:
        later = [p for p in periods_of(prices) if p >= first]
        raw = read_periods(spark, prices_path, later, PRICES_SCHEMA, prices)
        gone = [p for p in periods_of(returns) if p >= first]
        returns = replace_periods(
            extended_returns(raw, state, max_rows),
            returns_path,
            "trade_date",
            unit,
            returns,
            ORDER,
            emptied=gone,
            notes=note,
        )
        written = sorted({*later, *gone})
    _bring_states(
        spark, prices_path, prices, returns_path, returns, state_path, kept_states, first
    )
    return written


def _made_from(spark: SparkSession, prices_path: str, returns: Version | None) -> Version | None:
    """The quotes that the stored returns were made from, if that version is still there."""
    number = None if returns is None else returns.notes.get(_MADE_FROM)
    if number is None or int(number) not in versions.version_numbers(spark, prices_path):
        return None
    return versions.read_version(spark, prices_path, int(number))


def _changed(before: Version, now: Version) -> list[str] | None:
    """Periods that are not the same files in both; None if rows without a date are not."""
    names = versions.changed_parts(before, now)
    return None if NULL_PART in names else sorted(names)


def _state_before(
    spark: SparkSession, prices: Version, returns: Version, state_path: str, first: str
) -> DataFrame | None:
    """The state at the end of the period before ``first``, if it is stored."""
    earlier = [p for p in periods_of(prices) if p < first]
    states = versions.newest(spark, state_path)
    if states is None or states.notes.get(_STATE_OF) != str(returns.number):
        return None
    if not earlier or earlier[-1] not in states.parts:
        return None
    return read_periods(spark, state_path, earlier[-1:], version=states)


def _bring_states(
    spark: SparkSession,
    prices_path: str,
    prices: Version,
    returns_path: str,
    returns: Version,
    state_path: str,
    kept_states: int,
    first: str | None = None,
) -> None:
    """Store the states after the newest periods; those before ``first`` still hold."""
    states = versions.newest(spark, state_path)
    periods = periods_of(prices)
    wanted = periods[-kept_states:]
    if states is not None and first is None and states.notes.get(_STATE_OF) == str(returns.number):
        return
    held = [] if states is None or first is None else [p for p in wanted if p in states.parts]
    held = [p for p in held if p < first]
    missing = [p for p in wanted if not held or p > held[-1]]
    if held:
        before, state = held[-1], read_periods(spark, state_path, held[-1:], version=states)
    else:
        before, state = "", no_state(spark)
    parts: dict[str, list[str]] = {p: list(states.parts[p]) for p in held}
    schema = versions.next_schema(states, no_state(spark).schema)
    for period in missing:
        span = [p for p in periods if before < p <= period]
        raw = read_periods(spark, prices_path, span, PRICES_SCHEMA, prices)
        made = read_periods(spark, returns_path, span, version=returns)
        state = next_state(state, raw, made).withColumn(PART, F.lit(period))
        staged = versions.stage(state, state_path, schema, by_part=True)
        parts.update(staged)
        paths = [versions.data_path(state_path, p) for p in staged.get(period, [])]
        state = versions.read_paths(spark, state_path, schema, paths).drop(PART)
        before = period
    versions.commit(
        spark, state_path, states, schema, parts, {_STATE_OF: str(returns.number)}, whole=True
    )

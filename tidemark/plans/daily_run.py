"""One run over all layers, each checked before the next is built."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.check_state import incremental_checks
from tidemark.operators.incremental import lookback_start_of_table, refresh_table
from tidemark.operators.quarantine import read_quarantine, store_rejects
from tidemark.operators.quality import Check, freshness, require
from tidemark.operators.scd2 import read_history, scd2_table
from tidemark.operators.upsert import known_values, load_report, upsert_table
from tidemark.plans import checks
from tidemark.plans.macro import int_macro_pivoted, mart_macro_indicators
from tidemark.plans.marts import STOCK_KEY, mart_stock_performance
from tidemark.plans.resumed_returns import refresh_returns
from tidemark.plans.snapshot import CHECK_COLUMNS, SNAPSHOT_KEY, ticker_metadata
from tidemark.plans.staging import stg_bacen_series, stg_market_prices, typed_prices
from tidemark.schemas import PRICES_KEY, PRICES_SCHEMA, SERIES_KEY, SERIES_SCHEMA
from tidemark.sources.calendar import read_calendar_csv
from tidemark.sources.tables import (
    PERIOD,
    period_of,
    read_since,
    read_table,
    table_exists,
    write_sorted,
)


_REPORT = "table_rows long, batch_rows long, batch_keys long, table_name string"


@dataclass(frozen=True)
class Warehouse:
    """The stored tables below one folder, the large ones in folders per period."""

    spark: SparkSession
    root: str
    unit: str = "month"

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"

    @property
    def series(self) -> DataFrame:
        return read_table(self.spark, self.path("raw/bacen_series"), SERIES_SCHEMA)

    @property
    def prices(self) -> DataFrame:
        return read_table(self.spark, self.path("raw/market_prices"), PRICES_SCHEMA)

    @property
    def quarantine(self) -> DataFrame:
        return read_quarantine(self.spark, self.path("raw/quarantine"))

    @property
    def calendar(self) -> DataFrame:
        return read_table(self.spark, self.path("seeds/dim_calendar"))

    @property
    def macro_pivoted(self) -> DataFrame:
        return read_table(self.spark, self.path("intermediate/int_macro_pivoted"))

    @property
    def market_returns(self) -> DataFrame:
        return read_table(self.spark, self.path("intermediate/int_market_returns"))

    @property
    def macro_indicators(self) -> DataFrame:
        return read_table(self.spark, self.path("marts/mart_macro_indicators"))

    @property
    def stock_performance(self) -> DataFrame:
        return read_table(self.spark, self.path("marts/mart_stock_performance"))

    @property
    def ticker_history(self) -> DataFrame:
        return read_history(self.spark, self.path("snapshots/snap_ticker_metadata"))

    def register_views(self) -> None:
        """Temporary views by table name, so that all layers can be used in SQL."""
        views = {
            "bacen_series": self.series,
            "market_prices": self.prices,
            "stg_bacen_series": stg_bacen_series(self.series),
            "stg_market_prices": stg_market_prices(self.prices),
            "int_macro_pivoted": self.macro_pivoted,
            "int_market_returns": self.market_returns,
            "mart_macro_indicators": self.macro_indicators,
            "mart_stock_performance": self.stock_performance,
            "snap_ticker_metadata": self.ticker_history,
        }
        if table_exists(self.spark, self.path("seeds/dim_calendar")):
            views["dim_calendar"] = self.calendar
        for name, df in views.items():
            df.createOrReplaceTempView(name)


def load_raw(
    warehouse: Warehouse, series: DataFrame | None = None, prices: DataFrame | None = None
) -> DataFrame:
    """Upsert parsed payload rows; series without a value are not loaded.

    A table without a batch is created empty if it is not there. Returns the
    load report: rows of each table, rows and distinct keys of its batch.
    """
    spark = warehouse.spark
    loads = [
        ("raw/bacen_series", series, SERIES_SCHEMA, SERIES_KEY),
        ("raw/market_prices", prices, PRICES_SCHEMA, PRICES_KEY),
    ]
    reports = []
    for table, batch, schema, keys in loads:
        if batch is None:
            if table_exists(spark, warehouse.path(table)):
                continue
            batch = spark.createDataFrame([], schema)
        if table == "raw/bacen_series":
            batch = known_values(batch, "value")
        path = warehouse.path(table)
        loaded = upsert_table(spark, path, batch, schema, keys, unit=warehouse.unit)
        report = load_report(read_table(spark, path, schema), loaded, keys[0])
        reports.append(report.withColumn("table_name", F.lit(table)))
    report = reports[0] if reports else spark.createDataFrame([], _REPORT)
    for other in reports[1:]:
        report = report.unionByName(other)
    return report


def hold_back(
    warehouse: Warehouse, source: str, rejects: DataFrame, reason: str, run_ts: dt.datetime | str
) -> None:
    """Store what a run's parsing held back in the quarantine table."""
    path = warehouse.path("raw/quarantine")
    store_rejects(rejects, path, source, reason, run_ts)


def load_calendar(warehouse: Warehouse, csv_path: str) -> None:
    """The calendar dimension from its CSV."""
    days = read_calendar_csv(warehouse.spark, csv_path)
    write_sorted(days, warehouse.path("seeds/dim_calendar"), ["date_id"])


def source_freshness(warehouse: Warehouse, as_of: dt.datetime | str) -> DataFrame:
    """Newest load and its status for each raw table."""
    limits = checks.FRESHNESS_WARN_DAYS, checks.FRESHNESS_ERROR_DAYS
    tables = {"bacen_series": warehouse.series, "market_prices": warehouse.prices}
    rows = [
        freshness(df, "ingested_at", as_of, *limits).withColumn("table_name", F.lit(name))
        for name, df in tables.items()
    ]
    return rows[0].unionByName(rows[1])


def build_models(
    warehouse: Warehouse, run_ts: dt.datetime | str, full_refresh: bool = False
) -> None:
    """Build every layer from the raw tables, then the snapshot.

    A layer with failing checks raises and nothing after it is built.
    """
    spark, unit = warehouse.spark, warehouse.unit
    _check(warehouse, "raw/bacen_series", checks.RAW_SERIES)
    _check(warehouse, "raw/market_prices", checks.RAW_PRICES)

    def staged_series(rows: DataFrame) -> DataFrame:
        return stg_bacen_series(rows).withColumn(PERIOD, period_of("reference_date", unit))

    def staged_prices(rows: DataFrame) -> DataFrame:
        # No check looks at the return, which alone needs other periods.
        staged = stg_market_prices(rows, max_rows=None)
        return staged.withColumn(PERIOD, period_of("trade_date", unit))

    _check(warehouse, "raw/bacen_series", checks.STG_SERIES, "stg_bacen_series", staged_series)
    _check(
        warehouse, "raw/market_prices", checks.STG_PRICES, "stg_market_prices",
        staged_prices, "trade_date",
    )

    series = stg_bacen_series(warehouse.series)
    write_sorted(
        int_macro_pivoted(series), warehouse.path("intermediate/int_macro_pivoted"), ["macro_date"]
    )
    refresh_returns(
        spark,
        warehouse.path("raw/market_prices"),
        warehouse.path("intermediate/int_market_returns"),
        warehouse.path("intermediate/returns_state"),
        unit,
        full_refresh,
    )
    _check(warehouse, "intermediate/int_macro_pivoted", checks.MACRO_PIVOTED)
    _check(warehouse, "intermediate/int_market_returns", checks.MARKET_RETURNS)

    write_sorted(
        mart_macro_indicators(warehouse.macro_pivoted, run_ts),
        warehouse.path("marts/mart_macro_indicators"),
        ["macro_date"],
    )
    _refresh_stock_mart(warehouse, run_ts, full_refresh)
    _check(warehouse, "marts/mart_macro_indicators", checks.MACRO_INDICATORS)
    _check(
        warehouse, "marts/mart_stock_performance", checks.STOCK_PERFORMANCE, part_key="trade_date"
    )

    scd2_table(
        spark,
        warehouse.path("snapshots/snap_ticker_metadata"),
        ticker_metadata(typed_prices(warehouse.prices), run_ts),
        SNAPSHOT_KEY,
        CHECK_COLUMNS,
        run_ts,
    )


def _refresh_stock_mart(
    warehouse: Warehouse, run_ts: dt.datetime | str, full_refresh: bool
) -> None:
    """The mart from the stored returns, cut to the look-back where it exists."""
    path = warehouse.path("marts/mart_stock_performance")
    returns = warehouse.market_returns
    if not full_refresh and table_exists(warehouse.spark, path):
        start = lookback_start_of_table(warehouse.spark, path, "trade_date")
        if start is not None:
            stored = warehouse.path("intermediate/int_market_returns")
            returns = read_since(warehouse.spark, stored, "trade_date", start, warehouse.unit)
    batch = mart_stock_performance(returns, warehouse.macro_pivoted, run_ts)
    refresh_table(
        warehouse.spark,
        path,
        batch,
        STOCK_KEY,
        "trade_date",
        warehouse.unit,
        full_refresh=full_refresh,
    )


def _check(
    warehouse: Warehouse,
    stored: str,
    table_checks: Sequence[Check],
    name: str | None = None,
    model: Callable[[DataFrame], DataFrame] | None = None,
    part_key: str | None = None,
) -> None:
    """Stop on failing checks of a stored table, of which changed parts alone are read."""
    name = name or stored.split("/")[-1]
    require(
        incremental_checks(
            warehouse.spark,
            warehouse.path(stored),
            warehouse.path(f"checks/{name}"),
            name,
            table_checks,
            model,
            part_key,
        )
    )

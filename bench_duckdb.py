"""The same queries in DuckDB, for a single-node comparison with bench.py."""

from __future__ import annotations

import json
import os
import time

import duckdb

from workload import ORACLES, oracle_parts
from workload.oracle_parts import FX_PRICES, FX_SERIES

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

# On the loaded tables; then on the test tables. Payloads have no counterpart.
MODELS = [
    "stg_market_prices",
    "market_returns",
    "macro_pivoted",
    "mart_macro",
    "mart_stock",
    "rolling_metrics",
    "incremental_delete_insert",
]
REGISTERED = ["upsert_raw", "scd2_change", "dq_unique_combo", "compare_relations", "calendar"]


def main() -> None:
    con = duckdb.connect()
    con.execute(f"set threads = {CPUS}")
    for file in os.listdir(SF_DIR):
        name = file.removesuffix(".parquet")
        con.execute(f"create view {name} as select * from '{SF_DIR}/{file}'")
    seconds: dict[str, float] = {}

    def timed(name: str, *statements: str) -> None:
        best = float("inf")
        for _ in range(2):
            start = time.perf_counter()
            for sql in statements:
                con.execute(sql)
            best = min(best, time.perf_counter() - start)
        seconds[name] = round(best, 3)

    timed(
        "load_raw",
        f"create or replace table fx_market_prices as with {FX_PRICES} select * from fx_market_prices",
        f"create or replace table fx_bacen_series as with {FX_SERIES} select * from fx_bacen_series",
    )
    for name in MODELS:
        sql = ORACLES[name]
        for part in (oracle_parts.FX_PRICES, oracle_parts.FX_SERIES):
            sql = sql.replace(f"{part},", "")
        timed(name, f"create or replace temp table result as {sql}")
    for name in REGISTERED:
        timed(name, f"create or replace temp table result as {ORACLES[name]}")
    print(json.dumps({"unit": "sec", "value": round(sum(seconds.values()), 3), "queries": seconds}))


if __name__ == "__main__":
    main()

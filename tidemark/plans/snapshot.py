"""History of the descriptive columns of each ticker."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from tidemark.functions.keys import run_stamp

SNAPSHOT_KEY = "ticker"
CHECK_COLUMNS = ["company_name", "sector", "market_index"]


def ticker_metadata(prices: DataFrame, run_ts: dt.datetime | str) -> DataFrame:
    """Distinct metadata over all quotes, stamped with the run time.

    A ticker with two spellings yields two rows, which the snapshot refuses.
    """
    distinct = prices.select(SNAPSHOT_KEY, *CHECK_COLUMNS).distinct()
    return distinct.withColumn("updated_at", run_stamp(run_ts))

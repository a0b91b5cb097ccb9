"""Hash keys, run stamps and constraint expressions."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the text that stands for NULL inside a surrogate key.
NULL_KEY_TEXT = "_dbt_utils_surrogate_key_null_"


def surrogate_key(columns: Sequence[str | Column]) -> Column:
    """MD5 over the text of several columns, NULL kept apart from empty text."""
    cols = [F.col(c) if isinstance(c, str) else c for c in columns]
    texts = [F.coalesce(c.cast("string"), F.lit(NULL_KEY_TEXT)) for c in cols]
    return F.md5(F.concat_ws("-", *texts))


def run_stamp(run_ts: dt.datetime | str) -> Column:
    """The run time as a zone-free timestamp constant."""
    text = run_ts if isinstance(run_ts, str) else run_ts.isoformat(sep=" ")
    return F.lit(text).cast(T.TimestampNTZType())


def required(column: str, data_type: T.DataType) -> Column:
    """The column itself, failing the job on a NULL (a NOT NULL constraint)."""
    failure = F.raise_error(F.lit(f"NULL in required column {column}"))
    return F.coalesce(F.col(column).cast(data_type), failure.cast(data_type)).alias(column)

"""Upserts that open only the files which may hold a key of the batch."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators import upsert as keyed
from tidemark.operators.upsert import upsert_table
from tidemark.session import scratch_path
from tidemark.sources import versions
from tidemark.sources.file_stats import files_of, files_with
from tidemark.sources.tables import PERIOD, read_table, replace_periods

SCHEMA = T.StructType(
    [
        T.StructField("ticker", T.StringType(), False),
        T.StructField("date", T.DateType(), False),
        T.StructField("v", T.LongType(), True),
        T.StructField("ingested_at", T.TimestampNTZType(), False),
    ]
)
KEYS = ["ticker", "date"]


def batch(spark, tickers, value, first="2024-01-01", days=10, missing=()):
    rows = spark.createDataFrame([(t,) for t in tickers], "ticker string")
    date = F.date_add(F.lit(first).cast("date"), F.col("id").cast("int"))
    rows = rows.crossJoin(spark.range(days)).withColumn("date", date)
    if missing:
        rows = rows.filter(~F.col("date").isin([F.lit(d).cast("date") for d in missing]))
    return rows.select(
        "ticker", "date", F.lit(value).cast("long").alias("v"),
        F.lit("2024-02-01").cast("timestamp_ntz").alias("ingested_at"),
    )


def load(spark, path, rows):
    upsert_table(spark, path, rows, SCHEMA, KEYS)


def stored(spark, path):
    out = {(r.ticker, r.date): r.v for r in read_table(spark, path, SCHEMA).collect()}
    assert len(out) == read_table(spark, path).count()
    return out


def expected(*loads):
    out = {}
    for rows in loads:
        out.update({(r.ticker, r.date): r.v for r in rows.collect()})
    return out


@pytest.fixture
def month_of_files(spark, tmp_path):
    """A month in 100 files of 100 rows, without the fifth of January."""
    spark.conf.set("spark.sql.files.maxRecordsPerFile", 100)
    tickers = [f"T{i:04}" for i in range(1000)]
    path = str(tmp_path / "t")
    rows = batch(spark, tickers, 1, days=11, missing=["2024-01-05"])
    load(spark, path, rows)
    spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    return path, tmp_path, rows


def break_files(tmp_path, files):
    """What cannot be read harms nothing that does not read it."""
    for name in files:
        file = tmp_path / "t" / "data" / name
        file.write_bytes(b"no parquet")
        file.with_name(f".{file.name}.crc").unlink(missing_ok=True)


def test_a_small_batch_opens_few_files(spark, month_of_files):
    path, tmp_path, _ = month_of_files
    base = versions.newest(spark, path)
    files = [r[0] for r in files_of(spark, path, base, base.parts, KEYS).select(versions.FILE).collect()]
    assert len(files) >= 100
    # A hundred keys: five tickers over ten days each, and new days of others.
    known = batch(spark, [f"T{i:04}" for i in (3, 4, 500, 501, 502)], 2, days=11, missing=["2024-01-05"])
    new = batch(spark, [f"T{i:04}" for i in range(0, 1000, 20)], 3, first="2024-01-05", days=1)
    both = known.unionByName(new)
    assert both.count() == 100
    dated = both.withColumn(PERIOD, F.lit("m2024-01"))
    opened = files_with(
        spark, path, base, dated, KEYS, files_of(spark, path, base, base.parts, KEYS)
    )
    assert len(opened) < 10
    break_files(tmp_path, set(files) - set(opened))
    load(spark, path, both)
    now = versions.newest(spark, path).parts["m2024-01"]
    assert len(set(now) & set(files)) == len(files) - len(opened)


def test_new_days_of_known_keys_are_appended(spark, month_of_files):
    path, _, rows = month_of_files
    before = versions.newest(spark, path)
    fifth = batch(spark, [f"T{i:04}" for i in range(0, 1000, 7)], 5, first="2024-01-05", days=1)
    load(spark, path, fifth)
    assert stored(spark, path) == expected(rows, fifth)
    kept = versions.newest(spark, path).parts["m2024-01"]
    assert len(kept) > 95 and before.parts["m2024-01"][0] not in kept


def test_random_batches_give_the_table_of_plain_upserts(spark, monkeypatch):
    rng = random.Random(11)
    path = scratch_path(spark, "t")
    spark.conf.set("spark.sql.files.maxRecordsPerFile", 40)
    try:
        loads = []
        for n in range(9):
            tickers = [f"T{i}" for i in rng.sample(range(60), rng.choice([1, 5, 40]))]
            first = f"2024-0{rng.randint(1, 2)}-{rng.randint(10, 28)}"
            loads.append(batch(spark, tickers, n, first=first, days=rng.randint(1, 12)))
            # Some in whole periods: too many keys, or too many paths, to ask for.
            monkeypatch.setattr(keyed, "ASKED_KEYS", rng.choice([20_000, 20_000, 30]))
            monkeypatch.setattr(keyed, "MOST_PATHS", rng.choice([256, 5]))
            load(spark, path, loads[-1])
            assert stored(spark, path) == expected(*loads)
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")


def test_files_that_nobody_described_are_read(spark):
    path = scratch_path(spark, "t")
    first = batch(spark, ["A", "B"], 1)
    load(spark, path, first)
    third = batch(spark, ["C"], 3)
    replace_periods(expected_frame(spark, path).unionByName(third, allowMissingColumns=True), path, "date")
    second = batch(spark, ["B", "C"], 4, days=3)
    load(spark, path, second)
    assert stored(spark, path) == expected(first, third, second)


def expected_frame(spark, path):
    return read_table(spark, path)


def test_other_keys_are_described_anew(spark):
    path = scratch_path(spark, "t")
    load(spark, path, batch(spark, ["A", "B"], 1))
    upsert_table(
        spark, path, batch(spark, ["C"], 2, first="2024-01-03", days=1), SCHEMA, ["date"]
    )
    found = read_table(spark, path).filter("date = date'2024-01-03'").collect()
    assert {r.ticker for r in found} == {"C"}


def test_no_key_is_missed(spark):
    """Every stored key is found in its file, whatever its filter says of others."""
    path = scratch_path(spark, "t")
    load(spark, path, batch(spark, [f"T{i}" for i in range(300)], 1, days=8))
    base = versions.newest(spark, path)
    files = files_of(spark, path, base, base.parts, KEYS)
    for ticker in ("T0", "T150", "T299"):
        wanted = batch(spark, [ticker], 1, days=8).withColumn(PERIOD, F.lit("m2024-01"))
        hit = files_with(spark, path, base, wanted, KEYS, files)
        paths = [versions.data_path(path, f) for f in hit]
        rows = versions.read_paths(spark, path, base.schema, paths)
        assert rows.filter(F.col("ticker") == ticker).count() == 8
    new = batch(spark, [f"N{i}" for i in range(50)], 1).withColumn(PERIOD, F.lit("m2024-01"))
    assert files_with(spark, path, base, new, KEYS, files) == []

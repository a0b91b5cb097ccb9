"""Upsert, incremental refresh and their stored tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from rows import LOADED, day, observation, prices, quote, series

from tidemark.operators.incremental import (
    delete_insert,
    lookback_start,
    lookback_start_of_table,
    refresh_table,
    since,
    since_by_key,
)
from tidemark.operators.quarantine import read_quarantine, store_rejects
from tidemark.operators.upsert import (
    PULLED_AT,
    conform,
    known_values,
    newest_per_key,
    upsert,
    upsert_table,
)
from tidemark.schemas import PRICES_KEY, PRICES_SCHEMA, SERIES_KEY, SERIES_SCHEMA
from tidemark.session import scratch_path
from tidemark.sources import versions
from tidemark.sources.tables import (
    newest_date,
    read_since,
    read_table,
    table_exists,
    write_sorted,
)

LATER = LOADED + dt.timedelta(days=1)


def stored(spark, path):
    rows = read_table(spark, path, SERIES_SCHEMA).collect()
    return sorted((r.series_name, r.date, r.value) for r in rows)


def load(spark, path, rows):
    batch = known_values(series(spark, rows), "value")
    upsert_table(spark, path, batch, SERIES_SCHEMA, SERIES_KEY)


def test_upsert_twice_is_upsert_once(spark):
    path = scratch_path(spark, "t")
    first = [observation("cdi_rate", day(n), 1.0) for n in range(40)]
    second = [observation("cdi_rate", day(n), 2.0, LATER) for n in range(35, 70)]
    load(spark, path, first)
    load(spark, path, second)
    once = stored(spark, path)
    load(spark, path, second)
    assert stored(spark, path) == once
    assert len(once) == 70
    assert [v for _, d, v in once if d >= day(35)] == [2.0] * 35


def test_upsert_writes_only_periods_of_the_batch(spark, tmp_path):
    path = str(tmp_path / "t")
    load(spark, path, [observation("cdi_rate", dt.date(2024, m, 1), 1.0) for m in (1, 2, 3)])
    before = {p: p.stat().st_mtime_ns for p in tmp_path.glob("t/data/*/*/*.parquet")}
    parts = versions.newest(spark, path).parts
    load(spark, path, [observation("cdi_rate", dt.date(2024, 2, 5), 1.0, LATER)])
    after = {p: p.stat().st_mtime_ns for p in tmp_path.glob("t/data/*/*/*.parquet")}
    assert before.items() <= after.items()
    assert {p.parent.name for p in after.keys() - before.keys()} == {"_period=m2024-02"}
    now = versions.newest(spark, path).parts
    assert {name for name in now if now[name] != parts[name]} == {"m2024-02"}
    assert len(stored(spark, path)) == 4


def test_days_as_periods(spark, tmp_path):
    path = str(tmp_path / "t")
    first = [observation("cdi_rate", day(n), 1.0) for n in range(4)]
    second = [observation("cdi_rate", day(2), 2.0, LATER)]
    for rows in (first, second):
        batch = series(spark, rows)
        upsert_table(spark, path, batch, SERIES_SCHEMA, SERIES_KEY, unit="day")
    assert [v for _, _, v in stored(spark, path)] == [1.0, 1.0, 2.0, 1.0]
    recent = read_since(spark, path, "date", day(2), "day")
    assert sorted(r.date for r in recent.collect()) == [day(2), day(3)]
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_period" in plan


def test_newest_of_duplicate_keys_wins(spark):
    path = scratch_path(spark, "t")
    rows = [
        observation("cdi_rate", day(0), 2.0, LATER),
        observation("cdi_rate", day(0), 1.0, LOADED),
    ]
    load(spark, path, rows)
    assert [v for _, _, v in stored(spark, path)] == [2.0]


def test_missing_series_values_are_not_loaded(spark):
    path = scratch_path(spark, "t")
    values = [None, float("nan"), 3.0]
    load(spark, path, [observation("cdi_rate", day(n), v) for n, v in enumerate(values)])
    assert [v for _, _, v in stored(spark, path)] == [3.0]


def test_missing_value_does_not_replace_a_known_one(spark):
    path = scratch_path(spark, "t")
    load(spark, path, [observation("cdi_rate", day(0), 1.0)])
    load(spark, path, [observation("cdi_rate", day(0), None, LATER)])
    assert [v for _, _, v in stored(spark, path)] == [1.0]


def test_null_quotes_are_loaded(spark):
    path = scratch_path(spark, "t")
    batch = prices(spark, [quote("A", 0, None, close=None)])
    upsert_table(spark, path, batch, PRICES_SCHEMA, PRICES_KEY)
    assert read_table(spark, path, PRICES_SCHEMA).head().close is None


def test_null_key_fails_the_load(spark):
    batch = prices(spark, [quote("A", 0, 1.0)]).selectExpr(
        "* except (ticker)", "cast(null as string) as ticker"
    )
    with pytest.raises(Exception, match="NULL in required column ticker"):
        upsert_table(spark, scratch_path(spark, "t"), batch, PRICES_SCHEMA, PRICES_KEY)


def test_columns_are_matched_by_name(spark):
    batch = prices(spark, [quote("A", 0, 1.0)]).select(
        "ingested_at", "date", "ticker", "volume", "close"
    )
    row = conform(batch, PRICES_SCHEMA).head()
    assert row.asDict().keys() == set(PRICES_SCHEMA.fieldNames())
    assert (row.ticker, row.close, row.volume, row.open) == ("A", 10.0, 100, None)


def test_lazy_upsert(spark):
    schema = "k int, v string, at int"
    target = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], schema)
    batch = spark.createDataFrame([(2, "c", 2), (3, "d", 2), (3, "e", 3)], schema)
    rows = upsert(target, newest_per_key(batch, ["k"], "at"), ["k"]).collect()
    assert sorted((r.k, r.v) for r in rows) == [(1, "a"), (2, "c"), (3, "e")]


# Incremental refresh

STOCK = "ticker string, trade_date date, v int"


def stock(spark, *rows):
    return spark.createDataFrame([(t, day(n), v) for t, n, v in rows], STOCK)


def test_lookback_is_inclusive_and_global(spark):
    target = stock(spark, ("A", 20, 1), ("B", 3, 1))
    start = lookback_start(target, "trade_date")
    assert start == day(13)
    source = stock(spark, ("A", 12, 1), ("A", 13, 1), ("B", 13, 1), ("LATE", 5, 1))
    kept = {(r.ticker, r.trade_date) for r in since(source, "trade_date", start).collect()}
    assert kept == {("A", day(13)), ("B", day(13))}


def test_lookback_of_a_stored_table_reads_its_latest_period(spark):
    path = scratch_path(spark, "t")
    refresh_table(spark, path, stock(spark, ("A", 50, 1), ("B", 20, 1)), ["ticker"], "trade_date")
    assert lookback_start_of_table(spark, path, "trade_date") == day(43)
    assert lookback_start_of_table(spark, path, "trade_date", days=0) == day(50)


def test_late_ticker_loads_by_its_own_mark(spark):
    target = stock(spark, ("A", 40, 1), ("B", 10, 1))
    source = stock(spark, ("A", 30, 1), ("A", 35, 1), ("B", 4, 1), ("B", 2, 1), ("LATE", 1, 1))
    kept = since_by_key(source, target, "ticker", "trade_date").collect()
    assert {(r.ticker, r.trade_date) for r in kept} == {
        ("A", day(35)),
        ("B", day(4)),
        ("LATE", day(1)),
    }


def test_empty_target_loads_everything(spark):
    source = stock(spark, ("A", 1, 1), ("A", 99, 1))
    start = lookback_start(stock(spark).limit(0), "trade_date")
    assert start is None
    assert since(source, "trade_date", start).count() == 2


def test_delete_insert_keeps_the_batch_as_it_is(spark):
    target = stock(spark, ("A", 1, 1), ("A", 2, 1))
    batch = stock(spark, ("A", 2, 5), ("A", 2, 6), ("B", 2, 7))
    rows = delete_insert(target, batch, ["ticker", "trade_date"]).collect()
    assert sorted((r.ticker, r.trade_date, r.v) for r in rows) == [
        ("A", day(1), 1),
        ("A", day(2), 5),
        ("A", day(2), 6),
        ("B", day(2), 7),
    ]


def test_split_load_equals_full_load(spark):
    rows = [(t, n, n) for t in "AB" for n in range(0, 60, 3)]
    path = scratch_path(spark, "t")
    keys = ["ticker", "trade_date"]
    refresh_table(spark, path, stock(spark, *[r for r in rows if r[1] < 40]), keys, "trade_date")
    start = lookback_start(read_table(spark, path), "trade_date")
    batch = since(stock(spark, *rows), "trade_date", start)
    refresh_table(spark, path, batch, keys, "trade_date")
    found = [(r.ticker, r.trade_date, r.v) for r in read_table(spark, path).collect()]
    assert sorted(found) == sorted((t, day(n), v) for t, n, v in rows)


def test_new_and_gone_columns(spark):
    path, keys = scratch_path(spark, "t"), ["ticker", "trade_date"]
    refresh_table(spark, path, stock(spark, ("A", 0, 1), ("A", 40, 2)), keys, "trade_date")
    batch = stock(spark, ("A", 40, 0), ("A", 41, 0)).selectExpr("ticker", "trade_date", "'x' as w")
    refresh_table(spark, path, batch, keys, "trade_date")
    table = read_table(spark, path)
    assert table.columns == ["ticker", "trade_date", "v", "w"]
    rows = {r.trade_date: (r.v, r.w) for r in table.collect()}
    assert rows == {day(0): (1, None), day(40): (None, "x"), day(41): (None, "x")}


def test_full_refresh_drops_what_is_gone(spark):
    path, keys = scratch_path(spark, "t"), ["ticker", "trade_date"]
    refresh_table(spark, path, stock(spark, ("A", 0, 1), ("GONE", 0, 1)), keys, "trade_date")
    refresh_table(spark, path, stock(spark, ("A", 0, 2)), keys, "trade_date", full_refresh=True)
    assert [(r.ticker, r.v) for r in read_table(spark, path).collect()] == [("A", 2)]


def test_sorted_write(spark):
    path = scratch_path(spark, "t")
    rows = stock(spark, *[("A", (7 * n) % 50, n) for n in range(50)])
    write_sorted(rows, path, ["trade_date"])
    stored = spark.read.parquet(f"{path}/data")
    files = stored.selectExpr("trade_date", "_metadata.file_name as f").collect()
    by_file: dict[str, list] = {}
    for r in files:
        by_file.setdefault(r.f, []).append(r.trade_date)
    spans = sorted((min(d), max(d)) for d in by_file.values())
    assert all(d == sorted(d) for d in by_file.values())
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:], strict=False))


def test_newest_pull_wins_in_any_batch(spark):
    def pulled(value, hour, when):
        row = known_values(series(spark, [observation("cdi_rate", day(0), value, when)]), "value")
        return row.withColumn(PULLED_AT, F.lit(f"2024-01-01 {hour:02}:00:00").cast("timestamp_ntz"))

    old, new = pulled(9.0, 1, LATER), pulled(8.0, 2, LOADED)
    for batches in ([old, new], [new, old], [old.unionByName(new)], [new.unionByName(old)]):
        path = scratch_path(spark, "t")
        for batch in batches:
            upsert_table(spark, path, batch, SERIES_SCHEMA, SERIES_KEY)
        assert [v for _, _, v in stored(spark, path)] == [8.0]


def test_only_repeated_keys_are_shuffled_whole(spark):
    path = scratch_path(spark, "t")
    rows = [observation("cdi_rate", day(n % 50), float(n)) for n in range(60)]
    load(spark, path, rows)
    assert len(stored(spark, path)) == 50


def test_another_period_unit_is_refused(spark):
    path = scratch_path(spark, "t")
    batch = series(spark, [observation("cdi_rate", day(0), 1.0)])
    upsert_table(spark, path, batch, SERIES_SCHEMA, SERIES_KEY, unit="day")
    with pytest.raises(ValueError, match="not stored by month"):
        upsert_table(spark, path, batch, SERIES_SCHEMA, SERIES_KEY)
    with pytest.raises(ValueError, match="not stored by year"):
        refresh_table(spark, path, batch, SERIES_KEY, "date", unit="year")


def test_an_empty_batch_creates_the_table(spark):
    path = scratch_path(spark, "t")
    assert not table_exists(spark, path)
    upsert_table(spark, path, series(spark, []), SERIES_SCHEMA, SERIES_KEY)
    assert table_exists(spark, path) and stored(spark, path) == []
    assert newest_date(spark, path, "date") is None
    load(spark, path, [observation("cdi_rate", day(0), 1.0)])
    assert len(stored(spark, path)) == 1


def test_newest_date_reads_one_folder(spark, tmp_path):
    path = str(tmp_path / "t")
    load(spark, path, [observation("cdi_rate", dt.date(2024, m, 3), 1.0) for m in (1, 2, 3)])
    # Earlier periods are not opened: what cannot be read there does no harm.
    for part in tmp_path.glob("t/data/*/_period=m2024-01/*.parquet"):
        part.write_bytes(b"no parquet")
        part.with_name(f".{part.name}.crc").unlink(missing_ok=True)
    assert newest_date(spark, path, "date") == dt.date(2024, 3, 3)


def test_quarantine_keeps_each_batch_once(spark):
    path = scratch_path(spark, "q")
    assert read_quarantine(spark, path).collect() == []
    rejects = spark.createDataFrame([("n/d", 11, "f")], "data string, series_code int, _file string")
    twice = rejects.unionByName(rejects).withColumn("_file", F.lit("g"))
    for batch in (rejects, twice, twice, rejects):
        store_rejects(batch, path, "series", "bad date", LOADED)
    rows = read_quarantine(spark, path).collect()
    assert sorted((r.source, r.reason, r.payload, r.run_ts, r.file) for r in rows) == [
        ("series", "bad date", '{"data":"n/d","series_code":11}', LOADED, file)
        for file in ("f", "g", "g")
    ]

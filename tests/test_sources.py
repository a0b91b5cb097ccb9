"""Payload parsing and the calendar."""

import datetime as dt
import json

import pytest

from tidemark.operators.quarantine import read_quarantine
from tidemark.operators.upsert import PULLED_AT
from tidemark.schemas import SERIES_SCHEMA
from tidemark.session import scratch_path
from tidemark.sources import calendar as cal
from tidemark.sources import payloads as pay
from tidemark.sources.tables import read_table
from tidemark.streaming.ingest import load_series_files

RUN_TS = "2024-01-31 07:00:00"


def land(tmp_path, key, documents):
    """Files as the providers send them: one pretty-printed document each."""
    for name, document in documents.items():
        folder = tmp_path / f"{key}={name}"
        folder.mkdir(parents=True)
        text = document if isinstance(document, str) else json.dumps(document, indent=2)
        (folder / "payload.json").write_text(text)
    return str(tmp_path)


def load_series(spark, path, **options):
    records = pay.read_series_payloads(spark, path, multi_line=True)
    return pay.parse_series(records, RUN_TS, **options)


def test_series_payload(spark, tmp_path):
    path = land(
        tmp_path,
        "series_code",
        {
            11: [{"data": "02/01/2020", "valor": "4,40"}, {"data": "03/01/2020", "valor": "n/d"}],
            433: [{"data": "01/02/2020", "valor": "0.25"}],
        },
    )
    rows = load_series(spark, path).rows.drop(PULLED_AT).orderBy("series_code", "date").collect()
    assert [tuple(r) for r in rows] == [
        (11, "selic_rate", "daily", "pct_per_year", dt.date(2020, 1, 2), 4.4, dt.datetime(2024, 1, 31, 7)),
        (11, "selic_rate", "daily", "pct_per_year", dt.date(2020, 1, 3), None, dt.datetime(2024, 1, 31, 7)),
        (433, "ipca_inflation", "monthly", "pct_change", dt.date(2020, 2, 1), 0.25, dt.datetime(2024, 1, 31, 7)),
    ]


def test_bad_series_harm_no_other(spark, tmp_path):
    good = [{"data": "02/01/2020", "valor": "1"}]
    path = land(
        tmp_path,
        "series_code",
        {
            1: good,
            11: [*good, {"data": "2020-01-03", "valor": "2"}],
            433: "<html>try again</html>",
            189: [],
            777: good,
        },
    )
    loaded = load_series(spark, path)
    assert [r.series_code for r in loaded.rows.collect()] == [1]
    assert {r.series_code for r in loaded.rejects.collect()} == {11, 433}


def test_series_date_range_is_inclusive(spark, tmp_path):
    days = [{"data": f"0{d}/01/2020", "valor": "1"} for d in range(1, 6)]
    path = land(tmp_path, "series_code", {11: days})
    loaded = load_series(spark, path, start=dt.date(2020, 1, 2), end=dt.date(2020, 1, 4))
    assert sorted(r.date.day for r in loaded.rows.collect()) == [2, 3, 4]


def quote(date: dt.date, **other):
    seconds = (date - dt.date(1970, 1, 1)).days * 86_400 + 75_600
    values = {"open": 1.5, "high": 2, "low": 1, "close": 1.8, "volume": 1e7, "adjustedClose": 1.7}
    return {"date": seconds, **values, **other}


def document(*quotes):
    return {"results": [{"historicalDataPrice": list(quotes)}, {"historicalDataPrice": []}]}


def load_quotes(spark, path, **options):
    payloads = pay.read_quote_payloads(spark, path, multi_line=True)
    return pay.parse_quotes(payloads, RUN_TS, **options)


def test_quote_payload(spark, tmp_path):
    path = land(
        tmp_path,
        "ticker",
        {
            "PETR4": document(quote(dt.date(2019, 12, 31)), quote(dt.date(2020, 1, 1))),
            "XYZ9": document(quote(dt.date(2020, 1, 2), volume=None)),
        },
    )
    rows = load_quotes(spark, path).rows.drop(PULLED_AT).orderBy("ticker").collect()
    loaded_at = dt.datetime(2024, 1, 31, 7)
    assert [tuple(r) for r in rows] == [
        ("PETR4", "Petrobras", "Energy", "IBOVESPA", dt.date(2020, 1, 1),
         1.5, 2.0, 1.0, 1.8, 1.7, 10_000_000, 0.0, 0.0, loaded_at),
        ("XYZ9", "XYZ9", "Unknown", "Unknown", dt.date(2020, 1, 2),
         1.5, 2.0, 1.0, 1.8, 1.7, None, 0.0, 0.0, loaded_at),
    ]


def test_bad_quotes_harm_no_other(spark, tmp_path):
    path = land(
        tmp_path,
        "ticker",
        {
            "GOOD3": document(quote(dt.date(2024, 1, 2))),
            "CUT4": '{"results": [{"historicalDataPrice": [{"date": 17',
            "EMPTY3": document(),
            "NONE3": {"results": []},
            "ERROR3": {"error": True},
        },
    )
    loaded = load_quotes(spark, path)
    assert [r.ticker for r in loaded.rows.collect()] == ["GOOD3"]
    assert {r.ticker for r in loaded.rejects.collect()} == {"CUT4", "EMPTY3", "NONE3", "ERROR3"}


def test_missing_quote_field_is_null(spark, tmp_path):
    one = quote(dt.date(2024, 1, 2))
    del one["adjustedClose"]
    path = land(tmp_path, "ticker", {"A": document(one)})
    assert load_quotes(spark, path).rows.head().adj_close is None


def test_ticker_parameter(spark, tmp_path):
    quotes = document(quote(dt.date(2024, 1, 2)))
    path = land(tmp_path, "ticker", {"A": quotes, "B": quotes, "C": quotes})
    found = load_quotes(spark, path, tickers=pay.ticker_list(" A, C ")).rows.collect()
    assert sorted(r.ticker for r in found) == ["A", "C"]


@pytest.mark.parametrize(
    "zone", ["UTC", "America/Sao_Paulo", "Asia/Tokyo"]
)
def test_epoch_date_ignores_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(0,), (86_399,), (86_400,), (-1,)], "s bigint")
        from pyspark.sql import functions as F

        found = [r[0] for r in df.select(pay.epoch_date(F.col("s"))).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    epoch = dt.date(1970, 1, 1)
    one = dt.timedelta(days=1)
    assert found == [epoch, epoch, epoch + one, epoch - one]


def test_calendar(spark):
    rows = {r.full_date: r for r in cal.dim_calendar(spark).collect()}
    assert len(rows) == 4_383
    assert (min(rows), max(rows)) == (dt.date(2019, 1, 1), dt.date(2030, 12, 31))
    new_year = rows[dt.date(2024, 1, 1)]
    assert (new_year.date_id, new_year.month_name, new_year.day_name) == (20240101, "January", "Monday")
    assert (new_year.week, new_year.day_of_week, new_year.quarter) == (1, 1, 1)
    assert not new_year.is_weekend and not new_year.is_business_day
    carnival = dt.date(2024, 2, 12)
    assert not rows[carnival].is_business_day
    assert rows[carnival + dt.timedelta(days=2)].is_business_day
    # Movable holidays are listed to 2026 only.
    assert rows[dt.date(2027, 2, 8)].is_business_day
    assert rows[dt.date(2027, 9, 7)].is_business_day is False


def test_calendar_csv(spark):
    path = scratch_path(spark, "calendar")
    calendar = cal.dim_calendar(spark)
    cal.write_calendar_csv(calendar, path)
    loaded = cal.read_calendar_csv(spark, path)
    assert loaded.dtypes == calendar.dtypes
    assert loaded.exceptAll(calendar).isEmpty() and calendar.exceptAll(loaded).isEmpty()


def test_holidays_are_a_parameter(spark):
    days = cal.dim_calendar(spark, dt.date(2024, 3, 1), dt.date(2024, 3, 8), ["03-05"])
    closed = [r.full_date.day for r in days.filter("not is_business_day").collect()]
    assert sorted(closed) == [2, 3, 5]


def test_date_spine_excludes_its_end(spark):
    bounds = spark.sql("select date '2024-01-01' as a, date '2024-01-04' as b")
    found = [r[0].day for r in cal.date_spine(bounds, "a", "b").collect()]
    assert sorted(found) == [1, 2, 3]


def test_a_quote_without_a_date_holds_back_its_payload_alone(spark, tmp_path):
    good, bad = quote(dt.date(2020, 1, 2)), dict(quote(dt.date(2020, 1, 3)), date=None)
    path = land(tmp_path, "ticker", {"GOOD3": document(good), "BAD3": document(good, bad)})
    for start in (None, dt.date(2020, 1, 1)):
        loaded = load_quotes(spark, path, start=start)
        assert [r.ticker for r in loaded.rows.collect()] == ["GOOD3"]
        assert [r.ticker for r in loaded.rejects.collect()] == ["BAD3"]


@pytest.mark.parametrize("files_per_batch", [1, 100])
def test_a_bad_series_file_is_held_back_alone(spark, tmp_path, files_per_batch):
    for number, date in enumerate(["02/01/2020", "n/d"]):
        folder = tmp_path / "landing" / "series_code=11"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"{number}.json").write_text(json.dumps([{"data": date, "valor": "1,5"}]))
    table, quarantine = str(tmp_path / "table"), str(tmp_path / "quarantine")
    load_series_files(
        spark, str(tmp_path / "landing"), table, str(tmp_path / "checkpoint"), RUN_TS,
        files_per_batch, quarantine=quarantine,
    ).awaitTermination()
    assert [r.value for r in read_table(spark, table, SERIES_SCHEMA).collect()] == [1.5]
    held = read_quarantine(spark, quarantine).collect()
    assert [json.loads(r.payload)["data"] for r in held] == ["n/d"]

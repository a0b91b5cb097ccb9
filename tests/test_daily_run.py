"""The whole run over landed payloads, in batch and as a stream."""

import datetime as dt
import json

import pytest

from tidemark.operators.quality import ChecksFailed
from tidemark.plans.daily_run import (
    Warehouse,
    build_models,
    load_calendar,
    load_raw,
    source_freshness,
)
from tidemark.sources import payloads as pay
from tidemark.sources.calendar import dim_calendar, write_calendar_csv
from tidemark.streaming.ingest import load_quote_files, load_series_files, read_reports

START = dt.date(2024, 1, 1)


def land(folder, first: int, last: int, factor: float = 1.0, name: str = "a"):
    """Quotes of two tickers and four series for a range of days, a line per payload."""
    days = [START + dt.timedelta(days=n) for n in range(first, last)]
    for i, ticker in enumerate(["PETR4", "VALE3"]):
        quotes = [
            {
                "date": (d - dt.date(1970, 1, 1)).days * 86_400,
                "open": 1.0,
                "high": 1.0,
                "low": 1.0,
                "close": 10.0 + i,
                "volume": 100 + d.day,
                "adjustedClose": factor * (10 + i + d.day % 7),
            }
            for d in days
        ]
        path = folder / "quotes" / f"ticker={ticker}"
        path.mkdir(parents=True, exist_ok=True)
        document = {"results": [{"historicalDataPrice": quotes}]}
        (path / f"{name}.json").write_text(json.dumps(document))
    for code, value in ((11, "11,75"), (1, "4,95"), (4189, "11,65")):
        path = folder / "series" / f"series_code={code}"
        path.mkdir(parents=True, exist_ok=True)
        records = [{"data": f"{d:%d/%m/%Y}", "valor": value} for d in days]
        (path / f"{name}.json").write_text(json.dumps(records))


def load(spark, warehouse, folder, run_ts):
    series = pay.read_series_payloads(spark, str(folder / "series"))
    quotes = pay.read_quote_payloads(spark, str(folder / "quotes"))
    load_raw(
        warehouse, pay.parse_series(series, run_ts).rows, pay.parse_quotes(quotes, run_ts).rows
    )


def mart(warehouse):
    columns = ["ticker", "trade_date", "cumulative_return_index", "running_peak", "selic_rate"]
    return sorted(tuple(r) for r in warehouse.stock_performance.select(*columns).collect())


def test_two_runs(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    land(tmp_path / "one", 0, 50)
    load(spark, warehouse, tmp_path / "one", "2024-02-20 07:00:00")
    build_models(warehouse, "2024-02-20 07:00:00")
    assert warehouse.prices.count() == 100
    assert warehouse.series.count() == 150
    assert warehouse.stock_performance.count() == 98
    assert warehouse.macro_indicators.count() == 50
    assert warehouse.ticker_history.count() == 2

    # A second run without news changes nothing but the run stamps.
    before = mart(warehouse)
    build_models(warehouse, "2024-02-21 07:00:00")
    assert mart(warehouse) == before
    stamps = warehouse.stock_performance.groupBy("dbt_updated_at").count().collect()
    assert sorted((r.dbt_updated_at.day, r["count"]) for r in stamps) == [(20, 82), (21, 16)]
    assert warehouse.ticker_history.count() == 2

    # New days arrive and all prices were adjusted: only the look-back is refreshed.
    land(tmp_path / "two", 0, 60, factor=2.0)
    load(spark, warehouse, tmp_path / "two", "2024-03-01 07:00:00")
    build_models(warehouse, "2024-03-01 07:00:00")
    peaks = {d: p for t, d, _, p, _ in mart(warehouse) if t == "PETR4"}
    cut = START + dt.timedelta(days=42)
    assert len(peaks) == 59
    assert all((p > 16) == (d >= cut) for d, p in peaks.items())
    build_models(warehouse, "2024-03-01 08:00:00", full_refresh=True)
    assert {p for t, d, _, p, _ in mart(warehouse) if d >= cut and t == "PETR4"} == {32.0}
    assert min(p for _, d, _, p, _ in mart(warehouse) if d < cut) > 16


def test_all_layers_in_sql(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "wh"), unit="day")
    land(tmp_path / "one", 0, 10)
    load(spark, warehouse, tmp_path / "one", "2024-01-11 07:00:00")
    write_calendar_csv(dim_calendar(spark), str(tmp_path / "calendar"))
    load_calendar(warehouse, str(tmp_path / "calendar"))
    build_models(warehouse, "2024-01-11 07:00:00")
    warehouse.register_views()
    row = spark.sql("""
        select count(*) as days, count(distinct m.ticker) as tickers, max(i.selic_rate) as selic,
               count(h.ticker) as known, count_if(c.is_business_day) as business_days
        from mart_stock_performance m
        join mart_macro_indicators i on m.trade_date = i.macro_date
        left join snap_ticker_metadata h on m.ticker = h.ticker and h.dbt_valid_to is null
        join dim_calendar c on c.full_date = m.trade_date
    """).head()
    # 2 January to 10 January 2024, seven of them business days.
    assert tuple(row) == (18, 2, 11.75, 18, 14)
    report = source_freshness(warehouse, "2024-01-15 07:00:00").collect()
    assert {(r.table_name, r.status) for r in report} == {
        ("bacen_series", "warn"),
        ("market_prices", "warn"),
    }


def test_failing_check_stops_the_run(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    land(tmp_path / "one", 0, 5)
    load(spark, warehouse, tmp_path / "one", "2024-02-20 07:00:00")
    broken = warehouse.prices.limit(1).selectExpr(
        "* except (date, close)", "date'2024-05-05' as date", "cast(null as double) as close"
    )
    load_raw(warehouse, prices=broken)
    with pytest.raises(ChecksFailed, match="not_null"):
        build_models(warehouse, "2024-02-20 07:00:00")
    assert not (tmp_path / "wh" / "intermediate").exists()


def test_stream_takes_each_file_once(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "wh"))

    def run(run_ts):
        load_quote_files(
            spark,
            str(tmp_path / "in" / "quotes"),
            warehouse.path("raw/market_prices"),
            str(tmp_path / "checkpoint-quotes"),
            run_ts,
            reports=str(tmp_path / "reports"),
        ).awaitTermination()
        load_series_files(
            spark,
            str(tmp_path / "in" / "series"),
            warehouse.path("raw/bacen_series"),
            str(tmp_path / "checkpoint-series"),
            run_ts,
            reports=str(tmp_path / "reports"),
        ).awaitTermination()

    land(tmp_path / "in", 0, 10)
    run("2024-01-11 07:00:00")
    land(tmp_path / "in", 5, 20, name="b")
    run("2024-01-21 07:00:00")
    stamps = warehouse.prices.groupBy("ingested_at").count().collect()
    assert sorted((r.ingested_at.day, r["count"]) for r in stamps) == [(11, 10), (21, 30)]
    assert warehouse.series.count() == 60
    found = sorted(
        (r.stream.split("-")[-1], r.batch, r.table_rows, r.batch_rows, r.batch_keys)
        for r in read_reports(spark, str(tmp_path / "reports")).collect()
    )
    assert found == [
        ("quotes", 0, 20, 20, 2),
        ("quotes", 1, 40, 30, 2),
        ("series", 0, 30, 30, 3),
        ("series", 1, 60, 45, 3),
    ]

"""Returns extended from stored states, and checks of changed parts."""

import datetime as dt
import random
from pathlib import Path

import pytest
from rows import LOADED, day, prices, quote

from tidemark.operators import quality as q
from tidemark.operators.check_state import incremental_checks
from tidemark.operators.upsert import upsert_table
from tidemark.plans import resumed_returns as resumed
from tidemark.plans.market import int_market_returns
from tidemark.schemas import PRICES_KEY, PRICES_SCHEMA
from tidemark.session import scratch_path
from tidemark.sources import versions
from tidemark.sources.tables import (
    PERIOD,
    period_of,
    read_table,
    replace_periods,
    write_sorted,
    write_table,
)


class Store:
    """Raw quotes, returns and their states below one folder."""

    def __init__(self, spark, unit="month"):
        self.spark, self.unit = spark, unit
        root = scratch_path(spark, "returns")
        self.prices, self.returns, self.state = (f"{root}/{n}" for n in ("raw", "out", "state"))

    def load(self, rows, hour=0):
        batch = prices(self.spark, rows).selectExpr(
            "* except (ingested_at)", f"timestamp_ntz'{LOADED + dt.timedelta(hours=hour)}' as ingested_at"
        )
        upsert_table(
            self.spark, self.prices, batch, PRICES_SCHEMA, PRICES_KEY, unit=self.unit
        )

    def refresh(self, **options):
        return resumed.refresh_returns(
            self.spark, self.prices, self.returns, self.state, self.unit, **options
        )

    def agrees(self):
        """The stored returns are those of a full build."""
        raw = read_table(self.spark, self.prices, PRICES_SCHEMA)
        full = rounded(int_market_returns(raw))
        found = rounded(read_table(self.spark, self.returns))
        assert found == full
        return len(found)


def rounded(df):
    out = {}
    for row in df.collect():
        values = tuple(round(v, 9) if isinstance(v, float) else v for v in row)
        assert (row.ticker, row.trade_date) not in out
        out[row.ticker, row.trade_date] = values
    return out


def walk(ticker, first, last, seed):
    rng = random.Random(f"{ticker}{seed}")
    rows = []
    for n in range(first, last):
        if rng.random() < 0.8:
            adjusted = None if rng.random() < 0.04 else round(rng.uniform(5, 50), 2)
            close = rng.choice([10.0, 11.0, 0.0]) if rng.random() < 0.1 else 10.0
            rows.append(quote(ticker, n, adjusted, close=close, volume=rng.randint(1, 99)))
    return rows


@pytest.mark.parametrize("unit", ["month", "day"])
def test_batches_give_the_returns_of_a_full_build(spark, unit):
    store = Store(spark, unit)
    span = 150 if unit == "month" else 24
    step = span // 3
    store.load([r for t in "ABC" for r in walk(t, 0, span, 1)])
    assert store.refresh() is None
    store.agrees()
    # New days, a new ticker, and one that has ended.
    store.load([r for t in "ABN" for r in walk(t, span, span + step, 2)], 1)
    written = store.refresh()
    assert written and len(written) <= (3 if unit == "month" else step)
    store.agrees()
    # A late correction some days back, and nothing of other tickers.
    store.load(walk("A", span + step - 4, span + step + 2, 3), 2)
    assert store.refresh()
    before = versions.newest(spark, store.returns)
    assert store.refresh() == []
    assert versions.newest(spark, store.returns).number == before.number
    # The ended ticker goes on after months without a quote.
    store.load([r for t in "C" for r in walk(t, span + step + 2, span + step + 5, 4)], 3)
    assert store.refresh()
    assert store.agrees() > 50


def test_a_change_before_the_kept_states_is_built_in_full(spark):
    store = Store(spark)
    store.load(walk("A", 0, 200, 1))
    store.refresh(kept_states=2)
    store.load(walk("A", 43, 49, 5), 1)
    assert store.refresh(kept_states=2) is None
    store.load(walk("A", 198, 230, 6), 2)
    assert store.refresh(kept_states=2)
    store.agrees()


def test_split_tickers_go_on_from_their_state(spark):
    store = Store(spark)
    store.load([r for t in "AB" for r in walk(t, 0, 130, 1)])
    store.refresh(max_rows=40)
    store.load([r for t in "AB" for r in walk(t, 130, 330, 2)], 1)
    assert store.refresh(max_rows=40)
    store.agrees()


@pytest.mark.parametrize("step", ["write_table", "replace_periods", "_bring_states"])
def test_a_run_that_fails_between_its_commits(spark, monkeypatch, step):
    store = Store(spark)
    store.load(walk("A", 0, 100, 1))
    if step != "write_table":
        store.refresh()
        store.load(walk("A", 100, 120, 2), 1)
    original = getattr(resumed, step)
    calls = []

    def die(*args, **kwargs):
        calls.append(step)
        # The first call of _bring_states finds nothing to do.
        if step == "_bring_states" and len(calls) == 1:
            return original(*args, **kwargs)
        raise RuntimeError(step)

    with monkeypatch.context() as patch:
        patch.setattr(resumed, step, die)
        with pytest.raises(RuntimeError):
            store.refresh()
    store.refresh()
    store.agrees()
    store.load(walk("A", 120, 140, 3), 2)
    assert store.refresh()
    store.agrees()


def test_only_touched_periods_are_read(spark, tmp_path):
    store = Store(spark)
    store.load(walk("A", 0, 150, 1))
    store.refresh()
    store.load(walk("A", 150, 155, 2), 1)
    old = "m2024-01"
    stored = versions.newest(spark, store.prices)
    folders = [versions.data_path(store.prices, p) for p in stored.parts[old]]
    made = versions.newest(spark, store.returns)
    folders += [versions.data_path(store.returns, p) for p in made.parts[old]]
    for folder in folders:
        for file in Path(folder.removeprefix("file:")).glob("*.parquet"):
            file.write_bytes(b"no parquet")
            file.with_name(f".{file.name}.crc").unlink(missing_ok=True)
    assert store.refresh() == ["m2024-05", "m2024-06"][: len(store_periods(store))]


def store_periods(store):
    made = versions.newest(store.spark, store.returns).parts
    return [p for p in made if p >= "m2024-05"]


def test_no_quotes(spark):
    store = Store(spark)
    store.load([])
    assert store.refresh() is None
    assert read_table(spark, store.returns).count() == 0
    store.load(walk("A", 0, 20, 1))
    store.refresh()
    assert store.agrees() > 5


# Checks by part

CHECKS = [
    q.not_null("k"),
    q.between("v", 0, 10),
    q.unique_combination("k", "d"),
    q.accepted_values("k", ["A", "B"]),
]


def rows(spark, *values):
    return spark.createDataFrame([(k, day(n), v) for k, n, v in values], "k string, d date, v int")


def outcome(report):
    return {(r.table_name, r.check_name, r.column_name): r.failures for r in report.collect()}


def test_checks_of_parts_merge_to_those_of_the_table(spark):
    rng = random.Random(3)
    path, state = scratch_path(spark, "t"), scratch_path(spark, "s")
    write_table(rows(spark, ("A", 0, 1)), path, "d")
    for _ in range(4):
        batch = [
            (rng.choice(["A", "B", "bad", "worse", None]), rng.randint(0, 120), rng.randint(-2, 12))
            for _ in range(60)
        ]
        replace_periods(rows(spark, *batch[: rng.randint(1, 60)]), path, "d")
        found = incremental_checks(spark, path, state, "t", CHECKS, part_key="d")
        assert outcome(found) == outcome(q.run_checks(read_table(spark, path), "t", CHECKS))


def test_only_changed_parts_are_checked(spark, tmp_path):
    path, state = str(tmp_path / "t"), str(tmp_path / "s")
    write_table(rows(spark, ("A", 0, 99), ("B", 40, 1)), path, "d")
    incremental_checks(spark, path, state, "t", CHECKS, part_key="d")
    for file in tmp_path.glob("t/data/*/*=m2024-01/*.parquet"):
        file.write_bytes(b"no parquet")
        file.with_name(f".{file.name}.crc").unlink(missing_ok=True)
    replace_periods(rows(spark, ("bad", 40, 1), (None, 41, 99)), path, "d")
    found = outcome(incremental_checks(spark, path, state, "t", CHECKS, part_key="d"))
    assert found == {
        ("t", "not_null", "k"): 1,
        ("t", "between", "v"): 2,
        ("t", "unique_combination", "k, d"): 0,
        ("t", "accepted_values", "k"): 1,
    }
    # Without changes nothing is read, with other checks everything is.
    number = versions.newest(spark, state).number
    assert outcome(incremental_checks(spark, path, state, "t", CHECKS, part_key="d")) == found
    assert versions.newest(spark, state).number == number
    with pytest.raises(Exception, match="parquet"):
        incremental_checks(spark, path, state, "t", CHECKS[:2], part_key="d")


def test_checks_of_a_table_without_parts_and_of_a_model(spark):
    path, state = scratch_path(spark, "t"), scratch_path(spark, "s")
    checks = [q.unique("k"), q.not_null("v")]
    write_sorted(rows(spark, ("A", 0, 1), ("A", 1, None)), path, ["d"])
    found = outcome(incremental_checks(spark, path, state, "t", checks))
    assert list(found.values()) == [1, 1]
    write_sorted(rows(spark, ("A", 0, 1)), path, ["d"])
    assert set(outcome(incremental_checks(spark, path, state, "t", checks)).values()) == {0}

    def doubled(stored):
        twice = stored.drop(PERIOD).unionByName(stored.drop(PERIOD))
        return twice.withColumn(PERIOD, period_of("d", "month"))

    found = incremental_checks(spark, path, scratch_path(spark, "s"), "m", checks, doubled)
    assert list(outcome(found).values()) == [1, 0]
    write_sorted(rows(spark), path, ["d"])
    assert set(outcome(incremental_checks(spark, path, state, "t", checks)).values()) == {0}


def test_a_key_that_may_repeat_in_other_parts_is_refused(spark):
    path = scratch_path(spark, "t")
    write_table(rows(spark, ("A", 0, 1)), path, "d")
    with pytest.raises(ValueError, match="k may repeat"):
        incremental_checks(spark, path, scratch_path(spark, "s"), "t", [q.unique("k")], part_key="d")

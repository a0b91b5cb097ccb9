"""Type 2 history: rules, intervals and the stored form."""

import random
from collections import defaultdict

import pytest

from tidemark.operators.scd2 import (
    newest_row_per_key,
    read_history,
    scd2_merge,
    scd2_start,
    scd2_table,
)
from tidemark.session import scratch_path

CHECKS = ["name", "sector"]
SCHEMA = "ticker string, name string, sector string, updated_at string"


def source(spark, *rows):
    return spark.createDataFrame([(*r, "now") for r in rows], SCHEMA)


def stamp(n: int) -> str:
    return f"2024-01-{n:02d} 07:00:00"


def versions(history):
    return sorted(
        (r.ticker, r.name, r.dbt_valid_from.day, r.dbt_valid_to and r.dbt_valid_to.day)
        for r in history.collect()
    )


def test_rules(spark):
    first = source(spark, ("same", "n", None), ("changed", "n", "s"), ("gone", "n", "s"), ("nulled", "n", "s"))
    second = source(spark, ("same", "n", None), ("changed", "m", "s"), ("new", "n", "s"), ("nulled", "n", None))
    history = scd2_merge(scd2_start(first, "ticker", stamp(1)), second, "ticker", CHECKS, stamp(2))
    assert versions(history) == [
        ("changed", "m", 2, None),
        ("changed", "n", 1, 2),
        ("gone", "n", 1, 2),
        ("new", "n", 2, None),
        ("nulled", "n", 1, 2),
        ("nulled", "n", 2, None),
        ("same", "n", 1, None),
    ]


def test_second_run_changes_nothing(spark):
    rows = source(spark, ("A", "n", "s"), ("B", "n", None))
    history = scd2_start(rows, "ticker", stamp(1))
    again = scd2_merge(history, rows, "ticker", CHECKS, stamp(2))
    assert sorted(map(str, again.collect())) == sorted(map(str, history.collect()))


def test_update_time_opens_no_version(spark):
    rows = source(spark, ("A", "n", "s"))
    later = rows.selectExpr("ticker", "name", "sector", "'later' as updated_at")
    history = scd2_merge(scd2_start(rows, "ticker", stamp(1)), later, "ticker", CHECKS, stamp(2))
    assert versions(history) == [("A", "n", 1, None)]


def test_conflicting_rows_fail(spark):
    rows = source(spark, ("A", "n", "s"), ("A", "m", "s"))
    with pytest.raises(Exception, match="several rows for ticker A"):
        scd2_start(rows, "ticker", stamp(1)).collect()


def test_newest_of_conflicting_rows(spark):
    rows = spark.createDataFrame(
        [("A", "old", 1), ("A", "new", 2), ("B", "b", 1)], "ticker string, name string, d int"
    )
    found = newest_row_per_key(rows, "ticker", "d").collect()
    assert sorted((r.ticker, r.name) for r in found) == [("A", "new"), ("B", "b")]


def test_stored_history_keeps_its_intervals(spark):
    """Random states: intervals never overlap, one open row per present key."""
    rng = random.Random(1)
    path = scratch_path(spark, "scd2")
    history = None
    for run in range(1, 6):
        present = [k for k in "ABCDEFGH" if rng.random() < 0.7]
        state = source(spark, *((k, rng.choice("xy"), rng.choice(["s", None])) for k in present))
        scd2_table(spark, path, state, "ticker", CHECKS, stamp(run))
        history = (
            scd2_start(state, "ticker", stamp(run))
            if history is None
            else scd2_merge(history, state, "ticker", CHECKS, stamp(run))
        )
        stored = read_history(spark, path)
        assert versions(stored) == versions(history)
        spans = defaultdict(list)
        for ticker, _, opened, closed in versions(stored):
            spans[ticker].append((opened, closed or 99))
        for intervals in spans.values():
            intervals.sort()
            assert all(a[1] <= b[0] for a, b in zip(intervals, intervals[1:], strict=False))
        open_keys = [t for t, _, _, closed in versions(stored) if closed is None]
        assert sorted(open_keys) == present


def test_closed_rows_are_not_rewritten(spark, tmp_path):
    path = str(tmp_path / "t")
    for run, name in ((1, "a"), (2, "b")):
        scd2_table(spark, path, source(spark, ("A", name, "s")), "ticker", CHECKS, stamp(run))
    closed = {p for p in tmp_path.glob("t/data/*/_period=closed-*/*.parquet")}
    scd2_table(spark, path, source(spark, ("A", "c", "s")), "ticker", CHECKS, stamp(3))
    assert len(closed) == 1
    assert closed < {p for p in tmp_path.glob("t/data/*/_period=closed-*/*.parquet")}


def test_runs_in_any_order_give_one_history(spark):
    for seed in range(4):
        rng = random.Random(seed)
        states = []
        for _ in range(6):
            present = [k for k in "ABCDEFGHIJ" if rng.random() < 0.75]
            states.append(source(spark, *((k, rng.choice("xy"), rng.choice(["s", None])) for k in present)))
        ordered, shuffled = scratch_path(spark, "scd2"), scratch_path(spark, "scd2")
        runs = list(enumerate(states, start=1))
        for run, state in runs:
            scd2_table(spark, ordered, state, "ticker", CHECKS, stamp(run))
        # The first run comes first: nothing is known of what was before it.
        late = runs[1:]
        rng.shuffle(late)
        for run, state in [runs[0], *late]:
            scd2_table(spark, shuffled, state, "ticker", CHECKS, stamp(run))
        assert versions(read_history(spark, shuffled)) == versions(read_history(spark, ordered))
        ids = [
            sorted((r.ticker, r.dbt_scd_id, r.dbt_updated_at) for r in read_history(spark, p).collect())
            for p in (ordered, shuffled)
        ]
        assert ids[0] == ids[1]


def test_a_late_run_before_all_others(spark):
    path = scratch_path(spark, "scd2")
    scd2_table(spark, path, source(spark, ("A", "b", "s"), ("C", "c", "s")), "ticker", CHECKS, stamp(5))
    scd2_table(spark, path, source(spark, ("A", "b", "s"), ("B", "x", "s")), "ticker", CHECKS, stamp(3))
    assert versions(read_history(spark, path)) == [
        ("A", "b", 3, None),
        ("B", "x", 3, 5),
        ("C", "c", 5, None),
    ]
    with pytest.raises(ValueError, match="only the newest"):
        scd2_table(spark, path, source(spark), "ticker", CHECKS, stamp(3))


def test_a_late_run_reads_only_what_ended_later(spark, tmp_path):
    path = str(tmp_path / "t")
    for run, name in ((1, "a"), (2, "b"), (4, "c")):
        scd2_table(spark, path, source(spark, ("A", name, "s")), "ticker", CHECKS, stamp(run))
    closed = {p for p in tmp_path.glob("t/data/*/_period=closed-20240102*/*.parquet")}
    assert len(closed) == 1
    for file in closed:
        file.write_bytes(b"no parquet")
        file.with_name(f".{file.name}.crc").unlink(missing_ok=True)
    scd2_table(spark, path, source(spark, ("A", "late", "s")), "ticker", CHECKS, stamp(3))

"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import pytest
from compare import connect, differences

import __spark_entry__ as entry_points
from workload import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    with connect(SF_DIR) as con:
        yield con


# Nothing is late, and no value repeats, in tables this small.
EMPTY_AT_THIS_SIZE: set[str] = set()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, duck, name):
    df = entry_points.queries()[name](spark, SF_DIR)
    found = differences(df, duck, entry_points.oracle_sql()[name])
    assert found is None or (found == "no rows" and name in EMPTY_AT_THIS_SIZE)


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()


def test_entry_has_every_query():
    assert QUERIES.items() <= entry_points.queries().items()
    assert ORACLES.items() <= entry_points.oracle_sql().items()


def test_entry(spark):
    assert entry_points.entry(spark).count() == 5_673

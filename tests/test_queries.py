"""Every registered query against its checking SQL, on the smallest tables."""

import pytest
from compare import connect, differences, duck_side, spark_side

from paralex.plans import catalog

SF = "/root/testdata/sf0.001"
RUNS, CHECKS = catalog.queries(), catalog.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("key", list(RUNS))
def test_query_matches_check(spark, duck, key):
    rows = spark_side(RUNS[key](spark, SF))
    assert rows[1], "a query that returns nothing checks nothing"
    if key in CHECKS:
        assert differences(rows, duck_side(duck, CHECKS[key])) is None


def test_every_query_has_a_check():
    assert set(RUNS) == set(CHECKS)


def test_entry_returns_the_usage_report(spark):
    import __spark_entry__ as entry

    assert "tokens_per_line" in entry.entry(spark).columns

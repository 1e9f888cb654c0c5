"""Every registered query against its DuckDB oracle on the smallest tables."""

import pytest

from conftest import SMALL_SF
from oracle_harness import compare

import __spark_entry__ as entry
from tripmart import catalog


@pytest.fixture(scope="module")
def report(spark):
    return compare(spark, SMALL_SF, verbose=False)


def test_every_query_has_an_oracle_or_is_rows_only(report):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    # The document operators, where present, have their own tests.
    assert set(catalog.queries()) == set(catalog.oracle_sql())


@pytest.mark.parametrize("key", sorted(entry.queries()))
def test_query_matches_oracle(report, key):
    rec = report[key]
    assert "error" not in rec, rec
    if "oracle_rows" in rec:
        assert rec["cols_match"] and rec["rows_match"] and rec["hash_match"], rec


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == [
        "pickup_year", "pickup_month", "pickup_borough", "dropoff_borough",
        "total_trips", "total_revenue", "total_trip_distance", "total_passengers",
    ]

"""Every registered query against its DuckDB oracle on the driver tables."""

import os

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from oracle_compare import compare, duck
from stockbook.plans.queries import registry

SF = os.environ.get("STOCKBOOK_TEST_SF", SF_SMALL)
NAMES = sorted(registry())


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_an_oracle():
    assert set(NAMES) <= set(entry.oracle_sql()) and set(NAMES) <= set(entry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF)
    ok, msg = compare(df, con, entry.oracle_sql()[name])
    assert ok, msg


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns[:6] == ["IdProduct", "IDCountry", "Date", "forecast_snapshot", "Measure", "Version"]
    assert df.count() > 0

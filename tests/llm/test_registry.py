"""The registered queries against DuckDB where SQL can express them."""

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF_MID
from oracle_compare import compare
from stockbook.llm import registry


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_MID}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_matches_sql(spark, con, name):
    ok, msg = compare(entry.queries()[name](spark, SF_MID), con, entry.oracle_sql()[name])
    assert ok, msg


def test_all_queries_and_the_pipeline_are_registered():
    names = entry.queries()
    assert [sum(x.startswith(f"op{n}_") for x in names) for n in range(1, 14)] == [1] * 13
    assert "pipeline" in names

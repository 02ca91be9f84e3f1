"""Physical-plan shape: what Catalyst should (not) plan for the models."""

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL


def _plan(spark, name):
    df = entry.queries()[name](spark, SF_SMALL)
    return df._jdf.queryExecution().executedPlan().toString()


FACTS = ["fact_sales_full", "fact_forecast_full", "fact_pos_full", "fact_wholesale_full"]


@pytest.mark.parametrize("name", FACTS)
def test_newest_version_is_hash_aggregation_not_window_or_sort(spark, name):
    plan = _plan(spark, name)
    assert "HashAggregate" in plan
    for bad in ("SortAggregate", "ObjectHashAggregate", "Window", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan, bad


def test_book_has_no_pair_producing_join(spark):
    plan = _plan(spark, "planning_book")
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert "Subquery" in plan          # the snapshot marks


def test_book_computes_the_forecast_once(spark):
    """The marks and the branch read the stored forecast: lineitem serves each other fact once."""
    plan = _plan(spark, "planning_book")
    assert plan.count("/lineitem.parquet") == 3                # sales, POS, wholesale
    marks = [x for x in plan.split("\n") if "FileScan" in x and "/table-" in x and "pos_end_amount" not in x]
    assert marks and all("ReadSchema: struct<forecast_snapshot:date>" in x for x in marks)


def test_scans_read_only_needed_columns(spark):
    plan = _plan(spark, "dim_customers_full")
    assert "ReadSchema: struct<c_custkey:bigint,c_name:string,c_nationkey:int,c_mktsegment:string>" in plan
    plan = _plan(spark, "fact_pos_full")
    assert "l_tax" not in plan and "l_linestatus" not in plan


def test_high_water_mark_is_a_scalar_subquery(spark):
    plan = _plan(spark, "fact_pos_delta")
    assert "Subquery" in plan
    assert "CartesianProduct" not in plan


def test_recompute_uses_semi_and_anti_joins(spark):
    plan = _plan(spark, "fact_pos_recompute")
    assert "LeftSemi" in plan and "LeftAnti" in plan


@pytest.mark.parametrize("name", FACTS)
def test_facts_read_every_input_once(spark, name):
    """Versioning is two aggregations over one scan: no self-join, no second read."""
    plan = _plan(spark, name)
    assert "LeftSemi" not in plan
    for table in ("lineitem", "orders", "customer", "supplier"):
        assert plan.count(f"/{table}.parquet") <= 1, table

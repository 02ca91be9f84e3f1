"""Properties: recompute = full refresh, merge idempotence, stored-table loads."""

import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from stockbook.functions.audit import RunInfo
from stockbook.operators.incremental import merge_upsert
from stockbook.plans import dimensions as dims
from stockbook.plans.facts import FACT_FORECAST, FACT_POS, FACT_SALES, FACT_WHOLESALE
from stockbook.sources.driver_tables import before_cut, bronze_from_driver
from stockbook.sources.tables import load_model, load_table

RUN = RunInfo(user="p")


def _rows(df):
    keep = [c for c in df.columns if c not in ("update_ts", "insert_ts", "updated_by", "inserted_by")]
    return sorted((tuple(r) for r in df.select(*keep).collect()), key=repr)


@pytest.fixture(scope="module")
def bronze(spark):
    return bronze_from_driver(spark, SF_SMALL)


def _inputs(name, b, customers):
    return {"sales": (b.orders, b.order_details, customers), "forecast": (b.forecast_details,),
            "pos": (b.inventory_pos_history_details,),
            "wholesale": (b.inventory_wholesaler_history_details, customers)}[name]


MODELS = {"sales": FACT_SALES, "forecast": FACT_FORECAST, "pos": FACT_POS, "wholesale": FACT_WHOLESALE}


@pytest.mark.parametrize("name", sorted(MODELS))
def test_recompute_equals_full_refresh_when_append_only(spark, bronze, name):
    customers = dims.customer_rows(bronze.customers, bronze.countries)
    model = MODELS[name]
    target = model.full(*_inputs(name, before_cut(bronze), customers), run=RUN)
    inc = model.incremental(*_inputs(name, bronze, customers), target=target, run=RUN, mode="recompute")
    assert _rows(inc) == _rows(model.full(*_inputs(name, bronze, customers), run=RUN))


def test_merge_is_idempotent(spark, bronze):
    target = dims.dim_customers(before_cut(bronze).customers, bronze.countries, RUN)
    src = dims.dim_customers(bronze.customers, bronze.countries, RUN).filter(
        F.col("customer_update_date") >= F.lit("2000-04-01").cast("timestamp_ntz"))
    cols = ["company_name", "last_update", "customer_update_date"]
    once = merge_upsert(target, src, ["customer_id"], cols)
    twice = merge_upsert(once, src, ["customer_id"], cols)
    assert _rows(once) == _rows(twice)


def test_merge_error_on_several_source_rows_per_key(spark, bronze):
    target = dims.dim_customers(bronze.customers, bronze.countries, RUN)
    src = target.unionByName(target)
    with pytest.raises(Exception):
        merge_upsert(target, src, ["customer_id"], ["company_name"]).collect()


def test_stored_table_partition_merge_equals_full_refresh(spark, bronze):
    d = tempfile.mkdtemp(prefix="tbl-", dir="/tmp")
    customers = dims.customer_rows(bronze.customers, bronze.countries)
    old = before_cut(bronze)
    assert load_model(spark, FACT_WHOLESALE, old.inventory_wholesaler_history_details, customers,
                      path=f"{d}/wh", run=RUN) == "full"
    assert load_model(spark, FACT_WHOLESALE, bronze.inventory_wholesaler_history_details, customers,
                      path=f"{d}/wh", run=RUN) == "partitions"
    full = FACT_WHOLESALE.full(bronze.inventory_wholesaler_history_details, customers, run=RUN)
    assert _rows(load_table(spark, f"{d}/wh", like=full)) == _rows(full)


def test_book_totals_equal_filtered_fact_totals(spark, bronze):
    from stockbook.plans import gold
    customers = dims.customer_rows(bronze.customers, bronze.countries)
    sales = FACT_SALES.full(*_inputs("sales", bronze, customers), run=RUN)
    fc = FACT_FORECAST.full(bronze.forecast_details, run=RUN)
    pos = FACT_POS.full(bronze.inventory_pos_history_details, run=RUN)
    wh = FACT_WHOLESALE.full(*_inputs("wholesale", bronze, customers), run=RUN)
    book = gold.planning_book(sales, fc, pos, wh)
    cur = fc.agg(F.max("forecast_snapshot")).first()[0]
    got = book.filter((F.col("Measure") == "EA") & (F.col("Version") == "Current")).agg(
        F.sum("Consumer_Off_Take")).first()[0]
    exp = pos.filter(F.col("transaction_date") < F.lit(cur)).agg(F.sum("pos_sell_out_quantity")).first()[0]
    exp += fc.filter((F.col("forecast_snapshot") == F.lit(cur)) & (F.col("forecast_date") >= F.lit(cur))).agg(
        F.sum("pos_sell_out_quantity")).first()[0]
    assert got == pytest.approx(exp)


def test_book_from_stored_silver_equals_book_from_frames(spark, bronze):
    from stockbook.plans import gold
    d = tempfile.mkdtemp(prefix="lake-", dir="/tmp")
    customers = dims.customer_rows(bronze.customers, bronze.countries)
    frames = []
    for name in ("sales", "forecast", "pos", "wholesale"):
        load_model(spark, MODELS[name], *_inputs(name, bronze, customers), path=f"{d}/{name}", run=RUN)
        frames.append(MODELS[name].full(*_inputs(name, bronze, customers), run=RUN))
    stored = [load_table(spark, f"{d}/{n}") for n in ("sales", "forecast", "pos", "wholesale")]
    assert _rows(gold.planning_book(*stored)) == _rows(gold.planning_book(*frames))

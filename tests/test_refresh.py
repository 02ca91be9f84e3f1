"""The model graph on storage: two runs, gold from silver, data tests."""

import datetime as dt
import os
import tempfile

import pytest
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import functions as F

from conftest import SF_SMALL
from stockbook.functions.audit import RunInfo
from stockbook.plans import dimensions as dims
from stockbook.plans import gold
from stockbook.plans.facts import FACT_FORECAST, FACT_POS, FACT_SALES, FACT_WHOLESALE
from stockbook.plans.refresh import data_tests, refresh_gold, refresh_silver
from stockbook.sources.driver_tables import before_cut, bronze_from_driver
from stockbook.sources.tables import load_model, load_table, replace_partitions, save_table, table_exists

RUN = RunInfo(user="r")


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_two_runs_then_gold_equal_a_full_build(spark):
    b = bronze_from_driver(spark, SF_SMALL)
    lake = tempfile.mkdtemp(prefix="lake-", dir="/tmp")
    first = refresh_silver(spark, before_cut(b), lake, RUN)
    assert set(first.values()) == {"full"}
    second = refresh_silver(spark, b, lake, RUN)
    assert second["s_f_sales"] == "partitions" and second["s_dim_customers"] == "merged"
    refresh_gold(spark, lake, as_of="2024-06-15")

    customers = dims.customer_rows(b.customers, b.countries)
    expected = gold.planning_book(
        FACT_SALES.full(b.orders, b.order_details, customers, run=RUN),
        FACT_FORECAST.full(b.forecast_details, run=RUN),
        FACT_POS.full(b.inventory_pos_history_details, run=RUN),
        FACT_WHOLESALE.full(b.inventory_wholesaler_history_details, customers, run=RUN))
    got = load_table(spark, f"{lake}/gold/g_f_planning_book").select(*expected.columns)
    assert _rows(got) == _rows(expected)
    assert load_table(spark, f"{lake}/gold/g_dim_dates").count() == 2557
    for name, df in data_tests(spark, lake).items():
        assert df.agg(F.count(F.lit(1))).first()[0] == 0, name


def test_command_line_run_on_bronze_folders(spark):
    from stockbook.plans.refresh import main

    b = bronze_from_driver(spark, SF_SMALL)
    root = tempfile.mkdtemp(prefix="cli-", dir="/tmp")
    for name in b.names():
        getattr(b, name).write.parquet(f"{root}/bronze/{name}")
    assert main(["--bronze", f"{root}/bronze", "--lake", f"{root}/lake", "--as-of", "2024-06-15",
                 "--user", "cli"]) == 0
    book = load_table(spark, f"{root}/lake/gold/g_f_planning_book")
    assert book.count() > 0


def test_command_line_fails_when_a_data_test_finds_rows(spark):
    from stockbook.plans.refresh import main

    b = bronze_from_driver(spark, SF_SMALL)
    root = tempfile.mkdtemp(prefix="cli-", dir="/tmp")
    for name in b.names():
        df = getattr(b, name)
        if name == "customers":          # a customer delivered twice: duplicate-key test must fail
            df = df.unionByName(df.limit(1))
        df.write.parquet(f"{root}/bronze/{name}")
    assert main(["--bronze", f"{root}/bronze", "--lake", f"{root}/lake", "--as-of", "2024-06-15"]) == 1


def _pos(spark, months, snapshot_clock="2000-06-01"):
    rows = [(k, 1, dt.datetime.fromisoformat(clock), dt.date.fromisoformat(day), 5.0, 1.0, 1.0, 2.0) for k, (day, clock) in enumerate(months)]
    return spark.createDataFrame(rows, "product_id long, country_id int, update_date timestamp_ntz, transaction_date date, "
                                 "pos_sell_out_quantity double, pos_open_quantity double, pos_end_quantity double, unit_price double")


def test_stored_book_holds_exactly_two_snapshots(spark):
    """A rebuild replaces the whole table: the snapshot before last leaves."""
    root = f"{tempfile.mkdtemp(prefix='book-', dir='/tmp')}/book"
    book = spark.createDataFrame([("2000-03-01", 1), ("2000-02-01", 1)], "forecast_snapshot string, n int")
    later = spark.createDataFrame([("2000-04-01", 2), ("2000-03-01", 2)], "forecast_snapshot string, n int")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")  # whatever the session says
    try:
        save_table(book, root, "forecast_snapshot")
        save_table(later, root, "forecast_snapshot")
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    got = sorted((str(r.forecast_snapshot), r.n) for r in load_table(spark, root).collect())
    assert got == [("2000-03-01", 2), ("2000-04-01", 2)]
    save_table(load_table(spark, root).filter("n = 2").withColumn("n", F.lit(3)), root, "forecast_snapshot")  # reads what it replaces
    assert {r.n for r in load_table(spark, root).collect()} == {3}


def test_full_refresh_drops_a_vanished_month(spark):
    root = f"{tempfile.mkdtemp(prefix='pos-', dir='/tmp')}/pos"
    load_model(spark, FACT_POS, _pos(spark, [("2000-01-05", "2000-01-06"), ("2000-02-05", "2000-02-06")]), path=root)
    load_model(spark, FACT_POS, _pos(spark, [("2000-02-05", "2000-02-06")]), path=root, full_refresh=True)
    assert [str(r[0]) for r in load_table(spark, root).select("transaction_date").collect()] == ["2000-02-01"]


def test_an_emptied_touched_month_is_emptied(spark):
    root = f"{tempfile.mkdtemp(prefix='pos-', dir='/tmp')}/pos"
    load_model(spark, FACT_POS, _pos(spark, [("2000-01-05", "2000-01-06"), ("2000-02-05", "2000-02-06")]), path=root)
    table = load_table(spark, root)
    touched = table.select("transaction_date").checkpoint()
    staged = table.filter("month(transaction_date) = 2").checkpoint()
    replace_partitions(staged, touched, root, "transaction_date")
    assert [str(r[0]) for r in load_table(spark, root).select("transaction_date").collect()] == ["2000-02-01"]


def test_a_failed_rebuild_leaves_the_table(spark):
    root = f"{tempfile.mkdtemp(prefix='t-', dir='/tmp')}/t"
    save_table(spark.range(3), root)
    with pytest.raises(PySparkException):
        save_table(spark.range(5).select(F.raise_error(F.lit("broken")).alias("id")), root)
    assert load_table(spark, root).count() == 3
    os.rename(root, root + ".replaced")  # broken off between the two renames
    assert table_exists(spark, root) and load_table(spark, root).count() == 3
    assert not table_exists(spark, root + "-none")
    os.mkdir(root + "-empty")
    with pytest.raises(AnalysisException):  # there, but no table: an error, not a first load
        table_exists(spark, root + "-empty")


def test_delta_stops_on_duplicates_unless_combined_and_never_doubles(spark):
    """Several rows of one key in target and source: delta stops, as MERGE does; combine leaves one row a key."""
    inv = "customer_id long, product_id long, transaction_date date, update_date timestamp_ntz, unit_price double, " \
          "whrs_sell_in_quantity double, whrs_open_quantity double, whrs_end_quantity double"
    def rows(*clocks):
        return spark.createDataFrame([(1, 1, dt.date(2000, 1, d), dt.datetime(2000, m, 1), 2.0, 10.0, 0.0, 0.0) for d, m in clocks], inv)
    customers = spark.createDataFrame([(1, 1)], "customer_id long, country_id int")
    target = FACT_WHOLESALE.full(rows((1, 2), (2, 3)), customers, run=RUN).checkpoint()
    assert target.count() == 2  # two clocks in the grain
    after = rows((3, 4), (4, 5))
    with pytest.raises(PySparkException, match="several source rows"):
        FACT_WHOLESALE.incremental(after, customers, target=target, run=RUN, mode="delta").collect()
    got = FACT_WHOLESALE.incremental(after, customers, target=target, run=RUN, mode="delta", on_duplicate="combine").collect()
    assert [(r.whrs_sell_in_quantity, r.whrs_sell_in_amount) for r in got] == [(20.0, 40.0)]


def test_checkpoint_folder_is_never_local_on_a_cluster(monkeypatch):
    from stockbook import session

    class Context:
        master = "spark://host:7077"
        def getCheckpointDir(self):
            return None
        def getConf(self):
            return {}
    class Session:
        sparkContext = Context()
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())

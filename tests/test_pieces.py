"""Facts in pieces: rows move once and narrow, parts keep their size, results stay as without."""

import pytest

from conftest import SF_SMALL
from pyspark.sql import functions as F

from stockbook.plans import queries
from stockbook.plans.facts import FACT_FORECAST, FACT_POS, FACT_SALES, FACT_WHOLESALE
from stockbook.sources import driver_tables
from stockbook.sources.driver_tables import bronze_from_driver, fact_pieces

MODELS = {"sales": FACT_SALES, "forecast": FACT_FORECAST, "pos": FACT_POS, "wholesale": FACT_WHOLESALE}


def _inputs(spark, name):
    b = bronze_from_driver(spark, SF_SMALL)
    return queries._fact_inputs(name, b, queries._customers(b))


def _rows(df):
    return sorted(map(repr, df.drop("update_ts", "insert_ts").collect()))


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def small_pieces(monkeypatch):
    monkeypatch.setattr(driver_tables, "SPREAD_FROM", 1 << 10)
    monkeypatch.setattr(driver_tables, "PIECE", 1 << 14)


@pytest.mark.parametrize("name", MODELS)
def test_sums_are_made_where_the_dealt_rows_lie(spark, name):
    inputs = _inputs(spark, name)
    dealt = MODELS[name].in_pieces(5).full(*inputs, run=queries.RUN)
    above = _plan(dealt).split("REPARTITION_BY_NUM")[0]
    assert above.count("Exchange") == 1 and ", 5)" in above       # the deal itself is the only one
    assert "partial_" in above
    assert _rows(dealt) == _rows(MODELS[name].full(*inputs, run=queries.RUN))


@pytest.mark.parametrize("name", MODELS)
def test_null_keys_and_copies_in_pieces(spark, name):
    *inputs, last = _inputs(spark, name)
    if name in ("forecast", "pos"):
        k = F.col("product_id")
        odd = last.withColumn("product_id", F.when(k % 3 == 0, F.lit(None)).when(k % 3 == 1, F.lit(1)).otherwise(k).cast("long"))
    else:
        odd = last.withColumn("country_id", F.when(F.col("country_id") % 3 > 0, F.col("country_id")))
    odd = odd.unionByName(odd.filter(F.rand(3) < 0.3)).localCheckpoint()
    model = MODELS[name]
    assert _rows(model.in_pieces(7).full(*inputs, odd, run=queries.RUN)) == _rows(model.full(*inputs, odd, run=queries.RUN))
    rows = model.rows(*inputs, odd)
    assert _rows(model.table_of_state(model.in_pieces(7).state(rows))) == _rows(model.table_of_state(model.state(rows)))


def test_parts_keep_their_size_as_lineitem_grows(spark, monkeypatch):
    assert fact_pieces(spark, SF_SMALL) is None
    monkeypatch.setattr(driver_tables, "SPREAD_FROM", 1)
    monkeypatch.setattr(driver_tables, "PIECE", 512)
    few = fact_pieces(spark, SF_SMALL)
    monkeypatch.setattr(driver_tables, "PIECE", 64)
    assert few > spark.sparkContext.defaultParallelism and 8 * few - 8 <= fact_pieces(spark, SF_SMALL) <= 8 * few


def test_book_sums_where_the_facts_lie(spark, small_pieces):
    book = queries.planning_book(spark, SF_SMALL)
    above = _plan(book).split("Union")[0]
    assert "HashAggregate" in above and "Exchange" not in above
    got = _rows(book)
    driver_tables.SPREAD_FROM = 1 << 30
    assert got == _rows(queries.planning_book(spark, SF_SMALL))


@pytest.mark.parametrize("name", ["pos", "wholesale"])
def test_state_is_written_where_it_lies_and_equals_a_full_refresh(spark, small_pieces, monkeypatch, name):
    from stockbook.sources import version_state

    def refuse(df, by):
        raise AssertionError("a state in pieces is not dealt again")
    monkeypatch.setattr(version_state, "_balanced", refuse)
    got = queries.registry()[f"fact_{name}_state"](spark, SF_SMALL)
    assert _rows(got) == _rows(queries.registry()[f"fact_{name}_full"](spark, SF_SMALL))


@pytest.mark.parametrize("name", ["fact_pos_recompute", "high_water_mark"])
def test_the_mark_reads_one_column_of_a_stored_target(spark, name):
    plan = _plan(queries.registry()[name](spark, SF_SMALL))
    assert "Scan ExistingRDD" not in plan
    scans = [x for x in plan.split("\n") if "FileScan" in x and "/table-" in x]
    assert any("update_date" in x and "amount" not in x for x in scans)


@pytest.mark.parametrize("name", MODELS)
def test_a_delivery_moves_state_and_table_once_and_is_not_checkpointed(spark, tmp_path, monkeypatch, name):
    from pyspark.sql.classic.dataframe import DataFrame

    from stockbook.sources import version_state as vs
    from stockbook.sources.driver_tables import before_cut
    from stockbook.sources.tables import load_table

    model, b = MODELS[name].in_pieces(5), bronze_from_driver(spark, SF_SMALL)
    args = {"path": f"{tmp_path}/t", "state": f"{tmp_path}/s", "run": queries.RUN}
    monkeypatch.setattr(DataFrame, "checkpoint", lambda *a, **k: pytest.fail("checkpointed"))
    plans, real = [], vs.replace_partitions
    monkeypatch.setattr(vs, "replace_partitions", lambda staged, *a: (plans.append(_plan(staged)), real(staged, *a)))
    for x in (before_cut(b), b):
        inputs = queries._fact_inputs(name, x, queries._customers(x))
        vs.load_with_state(spark, model, *inputs, **args)
    full = MODELS[name].full(*inputs, run=queries.RUN)
    assert _rows(load_table(spark, f"{tmp_path}/t", like=full)) == _rows(full)
    assert "Join" not in plans[0]
    assert plans[0].count("Exchange") == (3 if model.by_day else 2)      # days are rolled up to months after the merge


def test_null_keys_of_a_delivery_meet_in_pieces(spark, tmp_path):
    from stockbook.sources import version_state as vs
    from stockbook.sources.tables import load_table

    rows = FACT_FORECAST.rows(bronze_from_driver(spark, SF_SMALL).forecast_details)
    k = F.col("product_id")
    rows = rows.withColumn("product_id", F.when(k % 3 > 0, k % 3)).localCheckpoint()
    cut = F.col("update_date") < F.lit("2000-06-05").cast("timestamp_ntz")
    model, args = FACT_FORECAST.in_pieces(3), {"path": f"{tmp_path}/t", "state": f"{tmp_path}/s", "run": queries.RUN}
    for n, part in enumerate([rows.filter(cut), rows.filter(~cut & (k.isNull() | (F.col("country_id") % 2 == 0)))]):
        vs.apply_delivery(spark, model, part, number=n, **args)
    full = FACT_FORECAST.full(rows.filter(cut | k.isNull() | (F.col("country_id") % 2 == 0)), run=queries.RUN)
    assert _rows(load_table(spark, f"{tmp_path}/t", like=full)) == _rows(full)


def _shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def test_a_stored_table_leaves_no_shuffle_files(spark):
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, held = _shuffle_files(spark), spark.conf.get(setting)
    rows = spark.range(1000).select((F.col("id") % 7).alias("k"), F.col("id").alias("v"))
    queries._stored_table(rows.repartition(5, "k"))
    queries._stored_by_key(rows, ["k"])
    assert _shuffle_files(spark) <= before and spark.conf.get(setting) == held


def test_lines_of_the_forecast_move_to_one_join_before_their_copies_are_made(spark):
    plan = _plan(bronze_from_driver(spark, SF_SMALL).forecast_details)
    assert plan.count("Generate") == 2 and plan.rindex("Generate") < plan.index("Join")


def _odd(spark, name):
    """Prepared rows with NULL keys, NULL clocks and copies; the cut between two deliveries."""
    model = MODELS[name]
    rows, clock = model.rows(*_inputs(spark, name)), model.clocks[0]
    k = F.col("product_id")
    odd = rows.withColumn("product_id", F.when(k % 3 > 0, k % 40)).withColumn("country_id", F.when(F.col("country_id") % 4 > 0, F.col("country_id")))
    odd = odd.withColumn(clock, F.when(F.rand(5) < 0.9, F.col(clock)))
    cut = "2000-06-05" if name == "forecast" else "1998-01-01"
    return odd.unionByName(odd.filter(F.rand(3) < 0.2)).localCheckpoint(), F.col(clock) < F.lit(cut).cast("timestamp_ntz")


@pytest.mark.parametrize("name", ["forecast", "pos", "wholesale"])
def test_recompute_in_pieces_moves_rows_once_and_the_target_not_at_all(spark, monkeypatch, name):
    rows, cut = _odd(spark, name)
    model = MODELS[name].in_pieces(5)
    monkeypatch.setattr(type(model), "rows", lambda self, df: df)
    target = queries._stored_in_pieces(model, model.full(rows.filter(cut), run=queries.RUN))
    got = model.incremental(rows, target=target, run=queries.RUN, mode="recompute")
    above = _plan(got).split("REPARTITION_BY_NUM")[0]
    assert "Join" not in above and above.count("Exchange hashpartitioning") == 1
    assert _rows(got) == _rows(MODELS[name].incremental(rows, target=target, run=queries.RUN, mode="recompute"))


def test_a_forecast_delta_in_pieces_moves_its_rows_once(spark, small_pieces):
    got = queries.registry()["fact_forecast_delta"](spark, SF_SMALL)
    above = _plan(got).split("REPARTITION_BY_NUM")[0]
    assert "Bucketed: true" in above and above.count("Exchange") == 1
    rows = _rows(got)
    driver_tables.SPREAD_FROM = 1 << 30
    assert rows == _rows(queries.registry()["fact_forecast_delta"](spark, SF_SMALL))


@pytest.mark.parametrize("name", ["planning_book", "planning_aligned_union"])
def test_facts_in_pieces_are_stored_one_by_one_and_read_where_they_lie(spark, small_pieces, name):
    before = _shuffle_files(spark)
    df = queries.registry()[name](spark, SF_SMALL)
    assert _shuffle_files(spark) <= before
    plan = _plan(df)
    assert "/lineitem.parquet" not in plan and "Exchange hashpartitioning" not in plan
    got = _rows(df)
    driver_tables.SPREAD_FROM = 1 << 30
    assert got == _rows(queries.registry()[name](spark, SF_SMALL))


def test_months_new_to_the_state_are_not_merged(spark, tmp_path, monkeypatch):
    from stockbook.sources import version_state as vs
    from stockbook.sources.driver_tables import before_cut
    from stockbook.sources.tables import load_table

    b, met, files = bronze_from_driver(spark, SF_SMALL), [], _shuffle_files(spark)
    args = {"path": f"{tmp_path}/t", "state": f"{tmp_path}/s", "run": queries.RUN}
    real = vs.affected_table
    monkeypatch.setattr(vs, "affected_table", lambda m, s, delta, months: (met.append((months, delta)), real(m, s, delta, months))[1])
    model = FACT_FORECAST.in_pieces(5)
    assert vs.load_with_state(spark, model, before_cut(b).forecast_details, **args) == "full"
    assert vs.load_with_state(spark, model, b.forecast_details, **args) == "partitions"
    (months, delta), = met                       # June was stored, July is the delivery's alone
    assert [str(m) for m in months] == ["2000-06-01"] and delta.filter("forecast_snapshot <> DATE'2000-06-01'").isEmpty()
    full = FACT_FORECAST.full(b.forecast_details, run=queries.RUN)
    assert _rows(load_table(spark, f"{tmp_path}/t", like=full)) == _rows(full)
    met.clear()
    late = FACT_FORECAST.rows(b.forecast_details).filter("product_id % 5 = 0").withColumn("forecast_snapshot", F.lit(None).cast("date"))
    vs.apply_delivery(spark, model, late, number=9, **args)      # a NULL month, new as a whole
    both = FACT_FORECAST.rows(b.forecast_details).unionByName(late)
    assert met == [] and _rows(load_table(spark, f"{tmp_path}/t", like=full)) == _rows(FACT_FORECAST.in_pieces(None).table_of_state(
        FACT_FORECAST.state(both)).withColumns({"updated_by": F.lit("stockbook"), "inserted_by": F.lit("stockbook")}))
    vs.apply_delivery(spark, model, late.withColumn("quantity", F.lit(1.0)), number=10, **args)
    assert [m for m, _ in met] == [[None]]                       # and met once it is stored

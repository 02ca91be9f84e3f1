"""Silver stored in buckets of the merge key: merge plan, one-change switch, broken runs."""

import os
import re
import tempfile
import uuid

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from conftest import SF_SMALL
from stockbook.functions.audit import RunInfo
from stockbook.operators.incremental import merge_upsert
from stockbook.plans import dimensions as dims
from stockbook.plans.facts import FACT_FORECAST, FACT_SALES
from stockbook.sources import keyed_tables as kt
from stockbook.sources.driver_tables import before_cut, bronze_from_driver

RUN = RunInfo(user="k")


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def _fresh():
    return f"keyed_t_{uuid.uuid4().hex[:8]}", tempfile.mkdtemp(prefix="keyed-", dir="/tmp") + "/t"


def _above_scans(df, table):
    """For each scan of ``table`` in the executed plan, the operators above it up to the root."""
    df.collect()
    lines = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0].split("\n")
    depth = [len(re.match(r"[\s:+\-]*", x).group()) for x in lines]
    found = []
    for i, x in enumerate(lines):
        if "FileScan" in x and table in x:
            d, above = depth[i], []
            for j in range(i - 1, -1, -1):
                if depth[j] < d:
                    d = depth[j]
                    above.append(lines[j].strip())
                    if lines[j].lstrip(" :+-").startswith("Subquery"):   # the mark's own plan ends here
                        break
            found.append(above)
    return found


@pytest.mark.parametrize("name", ["fact_sales_delta", "fact_forecast_delta"])
def test_delta_leaves_the_stored_target_where_it_lies(spark, name):
    df = entry.queries()[name](spark, SF_SMALL)
    scans = _above_scans(df, "keyed_")
    merged = [above for above in scans if any("FullOuter" in x for x in above)]
    assert len(merged) == 1                                   # the target is read once for the merge
    assert not any("Exchange" in x for x in merged[0])


@pytest.mark.parametrize("buckets", [3, 13])
@pytest.mark.parametrize("mode", ["error", "combine"])
def test_merge_moves_only_the_source_at_any_bucket_count(spark, buckets, mode):
    rows = [(k % 50 if k % 7 else None, k, float(k)) for k in range(400)]
    target = spark.createDataFrame(rows, "key long, grain long, v double")
    source = spark.createDataFrame([(k, 1000 + k, -1.0) for k in range(40, 60)] + [(None, 2000, -1.0)], "key long, grain long, v double")
    stored = kt.keyed_frame(target, _fresh()[1], ["key"], buckets)
    combine = (lambda s: s) if mode == "combine" else None
    got = merge_upsert(stored, source, ["key"], ["v"], on_duplicate=mode, combine=combine, buckets=buckets)
    matched = {r[0] for r in rows if r[0] is not None} & set(range(40, 60))
    first = {k: min(g for key, g, _ in rows if key == k) for k in matched}
    expected = ([r for r in rows if r[0] not in matched]
                + [(k, g, -1.0) for k, g, _ in rows if k in matched and (mode == "error" or g == first[k])]
                + [(k, 1000 + k, -1.0) for k in range(40, 60) if k not in matched] + [(None, 2000, -1.0)])
    assert _rows(got) == sorted(expected, key=repr)
    (above,) = _above_scans(got, "keyed_")
    assert not any("Exchange" in x for x in above)


def test_two_deliveries_into_a_keyed_table(spark):
    b = bronze_from_driver(spark, SF_SMALL)
    old = before_cut(b)
    customers = dims.customer_rows(b.customers, b.countries).checkpoint()
    visible = [c for c in FACT_SALES.full(b.orders, b.order_details, customers, run=RUN).columns if not c.endswith("_ts")]
    plain = FACT_SALES.full(old.orders, old.order_details, customers, run=RUN).checkpoint()
    for mode in ("delta", "recompute"):
        name, root = _fresh()
        args = {"name": name, "root": root, "buckets": 5, "run": RUN, "mode": mode, "on_duplicate": "combine"}
        assert kt.load_keyed_model(spark, FACT_SALES, old.orders, old.order_details, customers, **args) == "full"
        assert kt.load_keyed_model(spark, FACT_SALES, b.orders, b.order_details, customers, **args) == "merged"
        expected = FACT_SALES.incremental(b.orders, b.order_details, customers, target=plain, run=RUN, mode=mode, on_duplicate="combine")
        assert _rows(spark.table(name).select(*visible)) == _rows(expected.select(*visible))
        assert len([f for f in os.listdir(root) if f.startswith("v-")]) == 2  # the newest and the one before
        at = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Location'").first().data_type.removeprefix("file:")
        assert len([f for f in os.listdir(at) if f.endswith(".parquet")]) == 5  # one file a bucket, merged without a shuffle
        kt.drop_keyed_table(spark, name)


def test_first_load_refresh_and_empty_delivery(spark):
    b = bronze_from_driver(spark, SF_SMALL)
    name, root = _fresh()
    args = {"name": name, "root": root, "buckets": 4, "run": RUN, "mode": "delta"}
    kt.load_keyed_model(spark, FACT_FORECAST, b.forecast_details.limit(0), **args)
    assert spark.table(name).count() == 0
    kt.load_keyed_model(spark, FACT_FORECAST, b.forecast_details, **args)
    n = spark.table(name).count()
    assert n == FACT_FORECAST.full(b.forecast_details, run=RUN).count() > 0
    kt.load_keyed_model(spark, FACT_FORECAST, b.forecast_details.limit(0), **args)
    assert spark.table(name).count() == n
    kt.load_keyed_model(spark, FACT_FORECAST, b.forecast_details.limit(0), full_refresh=True, **args)
    assert spark.table(name).count() == 0
    kt.drop_keyed_table(spark, name)


@pytest.mark.parametrize("step", ["_tidy", "_write_version", "_point"])
@pytest.mark.parametrize("done", [False, True])
def test_a_reader_sees_old_or_new_wherever_a_run_breaks_off(spark, monkeypatch, step, done):
    """The run ends right before or right after each of its steps."""
    name, root = _fresh()
    kt.save_keyed_table(spark.range(10), name, root, ["id"], 2)
    reading = spark.table(name)                                # opened before the run, read after it
    real = getattr(kt, step)

    def broken(*a):
        if done:
            real(*a)
        raise RuntimeError("broken off")

    with monkeypatch.context() as m:
        m.setattr(kt, step, broken)
        with pytest.raises(RuntimeError):
            kt.save_keyed_table(spark.range(20), name, root, ["id"], 2)
    assert spark.table(name).count() == (20 if step == "_point" and done else 10)
    assert reading.count() == 10
    assert kt.save_keyed_table(spark.table(name).select((F.col("id") + 1).alias("id")), name, root, ["id"], 2).agg(
        F.max("id")).first()[0] == (20 if step == "_point" and done else 10)
    assert len(os.listdir(root)) == 2
    assert [t.name for t in spark.catalog.listTables() if t.name.startswith(name)] == [name]
    kt.drop_keyed_table(spark, name)


def test_a_broken_first_load_leaves_no_table(spark, monkeypatch):
    name, root = _fresh()
    with monkeypatch.context() as m:
        m.setattr(kt, "_point", lambda *a: (_ for _ in ()).throw(RuntimeError("broken off")))
        with pytest.raises(RuntimeError):
            kt.save_keyed_table(spark.range(3), name, root, ["id"], 2)
    assert not kt.keyed_table_exists(spark, name)
    assert kt.save_keyed_table(spark.range(4), name, root, ["id"], 2).count() == 4
    kt.drop_keyed_table(spark, name)


def test_other_layouts_are_refused(spark):
    name, root = _fresh()
    kt.save_keyed_table(spark.range(3), name, root, ["id"], 2)
    for df, buckets in ((spark.range(3), 3), (spark.range(3).withColumn("x", F.lit(1)), 2)):
        with pytest.raises(ValueError, match="drop it first"):
            kt.save_keyed_table(df, name, root, ["id"], buckets)
    assert spark.table(name).count() == 3
    kt.drop_keyed_table(spark, name)

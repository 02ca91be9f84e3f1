"""Facts loaded from a kept state: equal to full refreshes, from the delivery and the touched months alone."""

import datetime as dt
import glob
import random
import tempfile

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import SF_SMALL
from stockbook.functions.audit import RunInfo
from stockbook.operators.versions import merge_version_states, newest_of_state, newest_version_sums, version_state
from stockbook.functions.nulls import strict_greatest
from stockbook.plans import dimensions as dims
from stockbook.plans.facts import FACT_FORECAST, FACT_POS, FACT_SALES, FACT_WHOLESALE
from stockbook.sources import version_state as vs
from stockbook.sources.driver_tables import before_cut, bronze_from_driver
from stockbook.sources.tables import load_table

RUN = RunInfo(user="v")
MODELS = {"sales": FACT_SALES, "forecast": FACT_FORECAST, "pos": FACT_POS, "wholesale": FACT_WHOLESALE}


def _rows(df):
    return sorted((tuple(r) for r in df.select(*[c for c in df.columns if not c.endswith("_ts")]).collect()), key=repr)


def _root():
    return tempfile.mkdtemp(prefix="state-", dir="/tmp")


def _inputs(name, b, customers):
    return {"sales": (b.orders, b.order_details, customers), "forecast": (b.forecast_details,),
            "pos": (b.inventory_pos_history_details,),
            "wholesale": (b.inventory_wholesaler_history_details, customers)}[name]


POS = "product_id long, country_id int, update_date timestamp_ntz, transaction_date date, " \
      "pos_sell_out_quantity double, pos_open_quantity double, pos_end_quantity double, unit_price double"


def _pos(spark, *rows):
    """(product, clock, day, quantity) as POS rows; the clock may be None."""
    return spark.createDataFrame([
        (p, 1, clock and dt.datetime.fromisoformat(clock), day and dt.date.fromisoformat(day), q, 1.0, 1.0, 2.0) for p, clock, day, q in rows], POS)


@pytest.mark.parametrize("name", sorted(MODELS))
def test_deliveries_equal_a_full_refresh(spark, name):
    b, model, root = bronze_from_driver(spark, SF_SMALL), MODELS[name], _root()
    customers = dims.customer_rows(b.customers, b.countries).checkpoint()
    args = {"path": f"{root}/t", "state": f"{root}/s", "run": RUN}
    done = [vs.load_with_state(spark, model, *_inputs(name, x, customers), **args) for x in (before_cut(b), b, b)]
    full = model.full(*_inputs(name, b, customers), run=RUN)
    assert _rows(load_table(spark, f"{root}/t", like=full)) == _rows(full)
    assert done == ["full", "partitions", "no new rows"]


def test_rows_of_the_same_day_count_once(spark):
    """The wholesale table keeps dates: a mark from it would load the rest of its last day again."""
    root, schema = _root(), ("customer_id long, product_id long, transaction_date date, update_date timestamp_ntz, unit_price double, "
                             "whrs_sell_in_quantity double, whrs_open_quantity double, whrs_end_quantity double")
    customers = spark.createDataFrame([(1, 1)], "customer_id long, country_id int")
    inv = spark.createDataFrame([(1, 1, dt.date(2000, 1, 1), dt.datetime(2000, 1, 2, h), 2.0, 10.0, 0.0, 0.0) for h in (9, 9)], schema)
    for _ in range(3):
        vs.load_with_state(spark, FACT_WHOLESALE, inv, customers, path=f"{root}/t", state=f"{root}/s")
    assert load_table(spark, f"{root}/t").first().whrs_sell_in_quantity == 20.0
    more = inv.unionByName(spark.createDataFrame([(1, 1, dt.date(2000, 1, 1), dt.datetime(2000, 1, 2, 10), 2.0, 7.0, 0.0, 0.0)], schema))
    vs.load_with_state(spark, FACT_WHOLESALE, more, customers, path=f"{root}/t", state=f"{root}/s")
    assert [r.whrs_sell_in_quantity for r in load_table(spark, f"{root}/t").collect()] == [7.0]


def test_only_touched_months_and_the_delivery_are_read(spark):
    root = _root()
    rows = [(p, f"2000-{m:02d}-20", f"2000-{m:02d}-{d:02d}", 1.0) for p in range(5) for m in (1, 2, 3, 4) for d in (3, 9)]
    _pos(spark, *rows).write.parquet(f"{root}/bronze/a")
    args = {"path": f"{root}/t", "state": f"{root}/s", "run": RUN}
    bronze = spark.read.parquet(f"{root}/bronze/a")
    vs.load_with_state(spark, FACT_POS, bronze, **args)
    for part in ("transaction_date=2000-01-01", "transaction_date=2000-04-01"):
        assert len(glob.glob(f"{root}/t/{part}/*.parquet")) == 1
    before = {f: open(f, "rb").read() for f in glob.glob(f"{root}/t/transaction_date=2000-0[134]-01/*.parquet")}

    # the mark comes from the footers, the bronze filter reaches Parquet
    plan = vs.seen_by(spark, FACT_POS, FACT_POS.rows(bronze), f"{root}/s")._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [MAX(_seen)]" in plan
    new = vs.above_mark(FACT_POS.rows(bronze), FACT_POS.delivery_clock(), vs.state_mark(spark, FACT_POS, FACT_POS.rows(bronze), f"{root}/s"))
    assert "GreaterThan(update_date,2000-04-20T00:00)" in new._jdf.queryExecution().executedPlan().toString()

    # stored state of other months is cut off by partition
    delta = vs._with_month(FACT_POS, FACT_POS.state(FACT_POS.rows(_pos(spark, (0, "2000-05-01", "2000-02-03", 5.0)))))
    stored = vs.read_state(spark, FACT_POS, FACT_POS.rows(bronze), f"{root}/s")
    text = vs.affected_table(FACT_POS, stored, delta, [dt.date(2000, 2, 1)])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month_part" in text and "2000-02-01" in text.replace("10988", "2000-02-01")

    # the delivery alone gives what all rows give; other months' files stay
    _pos(spark, (0, "2000-05-01", "2000-02-03", 5.0), (9, "2000-05-01", "2000-06-03", 4.0)).write.parquet(f"{root}/bronze/b")
    assert vs.load_with_state(spark, FACT_POS, spark.read.parquet(f"{root}/bronze/b"), **args) == "partitions"
    full = FACT_POS.full(spark.read.parquet(f"{root}/bronze/a", f"{root}/bronze/b"), run=RUN)
    assert _rows(load_table(spark, f"{root}/t", like=full)) == _rows(full)
    assert before == {f: open(f, "rb").read() for f in glob.glob(f"{root}/t/transaction_date=2000-0[134]-01/*.parquet")}


def test_untouched_keys_of_a_touched_month_keep_their_stamps(spark):
    root = _root()
    one, two = RunInfo(ts=dt.datetime(2001, 1, 1), user="one"), RunInfo(ts=dt.datetime(2001, 2, 1), user="two")
    old = _pos(spark, (1, "2000-01-20", "2000-01-03", 1.0), (2, "2000-01-20", "2000-01-03", 1.0))
    vs.load_with_state(spark, FACT_POS, old, path=f"{root}/t", state=f"{root}/s", run=one)
    vs.load_with_state(spark, FACT_POS, old.unionByName(_pos(spark, (2, "2000-01-21", "2000-01-04", 1.0))),
                       path=f"{root}/t", state=f"{root}/s", run=two)
    got = {r.product_id: (r.updated_by, r.update_ts, r.pos_sell_out_quantity) for r in load_table(spark, f"{root}/t").collect()}
    assert got == {1: ("one", dt.datetime(2001, 1, 1), 1.0), 2: ("two", dt.datetime(2001, 2, 1), 2.0)}


@pytest.mark.parametrize("step, done", [("_write_load", True), ("replace_partitions", False), ("_set_applied", False), ("_set_applied", True)])
def test_a_broken_run_is_done_again_and_counts_once(spark, monkeypatch, step, done):
    root = _root()
    args = {"path": f"{root}/t", "state": f"{root}/s", "run": RUN}
    old = _pos(spark, (1, "2000-01-20", "2000-01-03", 1.0), (1, "2000-01-20", "2000-02-03", 1.0))
    new = old.unionByName(_pos(spark, (1, "2000-01-25", "2000-01-03", 2.0), (1, "2000-01-25", "2000-01-03", 3.0), (7, "2000-01-26", "2000-03-03", 1.0)))
    vs.load_with_state(spark, FACT_POS, old, **args)
    real = getattr(vs, step)

    def broken(*a):
        if done:
            real(*a)
        raise RuntimeError("broken off")

    with monkeypatch.context() as m:
        m.setattr(vs, step, broken)
        with pytest.raises(RuntimeError):
            vs.load_with_state(spark, FACT_POS, new, **args)
    vs.load_with_state(spark, FACT_POS, new, **args)
    full = FACT_POS.full(new, run=RUN)
    assert _rows(load_table(spark, f"{root}/t", like=full)) == _rows(full)


def test_a_broken_first_load_is_no_state(spark, monkeypatch):
    root = _root()
    old = _pos(spark, (1, "2000-01-20", "2000-01-03", 1.0))
    with monkeypatch.context() as m:
        m.setattr(vs, "save_table", lambda *a: (_ for _ in ()).throw(RuntimeError("broken off")))
        with pytest.raises(RuntimeError):
            vs.load_with_state(spark, FACT_POS, old, path=f"{root}/t", state=f"{root}/s")
    assert vs.applied_loads(spark, f"{root}/s") is None
    assert vs.load_with_state(spark, FACT_POS, old, path=f"{root}/t", state=f"{root}/s") == "full"


def test_many_loads_merge_into_a_new_base(spark):
    root, rows = _root(), []
    for k in range(4):
        rows += [(p, f"2000-03-{k + 1:02d}", f"2000-{1 + (p + k) % 3:02d}-03", float(k)) for p in range(3)]
        vs.load_with_state(spark, FACT_POS, _pos(spark, *rows), path=f"{root}/t", state=f"{root}/s", run=RUN, max_loads=3 if k == 2 else 2)
    full = FACT_POS.full(_pos(spark, *rows), run=RUN)
    assert _rows(load_table(spark, f"{root}/t", like=full)) == _rows(full)
    base, loads = vs.applied_loads(spark, f"{root}/s")
    assert base == 2 and loads == [2, 3] and len(glob.glob(f"{root}/s/base-*")) == 1


def test_null_keys_months_clocks_and_empty_tables(spark):
    root = _root()
    args = {"path": f"{root}/t", "state": f"{root}/s", "run": RUN}
    none = _pos(spark, (1, "2000-01-20", "2000-01-03", 1.0)).limit(0)
    assert vs.load_with_state(spark, FACT_POS, none, **args) == "full"
    assert load_table(spark, f"{root}/t", like=FACT_POS.full(none)).count() == 0
    assert vs.load_with_state(spark, FACT_POS, none, **args) == "no new rows"
    first = [(None, "2000-01-20", "2000-01-03", 1.0), (1, "2000-01-20", None, 2.0), (1, None, "2000-01-03", 9.0)]
    then = [(None, "2000-01-21", "2000-01-03", 3.0), (1, "2000-01-21", None, 4.0), (1, "2000-01-21", None, None)]
    vs.load_with_state(spark, FACT_POS, _pos(spark, *first), **args)
    vs.load_with_state(spark, FACT_POS, _pos(spark, *first, *then), **args)
    full = FACT_POS.full(_pos(spark, *first, *then), run=RUN)
    got = _rows(load_table(spark, f"{root}/t", like=full))
    assert got == _rows(full) and {r[3] for r in got} == {3.0, 4.0}


def test_a_numbered_delivery_counts_once(spark):
    root = _root()
    args = {"path": f"{root}/t", "state": f"{root}/s", "run": RUN}
    vs.load_with_state(spark, FACT_POS, _pos(spark, (1, "2000-01-20", "2000-01-03", 1.0)), **args)
    late = FACT_POS.rows(_pos(spark, (1, "2000-01-20", "2000-01-03", 5.0)))   # a tie that comes late still counts
    assert vs.apply_delivery(spark, FACT_POS, late, number=1, **args) == "partitions"
    assert vs.apply_delivery(spark, FACT_POS, late, number=1, **args) == "applied before"
    assert load_table(spark, f"{root}/t").first().pos_sell_out_quantity == 6.0


_clock = st.one_of(st.none(), st.integers(1, 4))


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from([1, 2, None]), _clock, _clock, st.integers(0, 9), st.integers(0, 3)), max_size=14), st.integers(0, 99))
def test_states_of_any_split_give_the_sums_of_all_rows(spark, rows, seed):
    """Two clocks, ties, NULLs, any order of arrival: merged states know what one pass over all rows knows."""
    day = lambda n: n and dt.datetime(2000, 1, n)
    data = [(k, day(a), day(b), float(q), part) for k, a, b, q, part in rows]
    random.Random(seed).shuffle(data)
    df = spark.createDataFrame(data, "k int, a timestamp_ntz, b timestamp_ntz, q double, part int").coalesce(1)
    sums, clocks = {"s": F.col("q")}, ["a", "b"]
    state = lambda d: version_state(d, ["k"], clocks, sums, strict_greatest("a", "b"))
    halves = [state(df.filter(F.col("part") == p)) for p in range(4)]
    left = merge_version_states(halves[0].unionByName(halves[1]), ["k"], clocks, ["s"])
    merged = merge_version_states(left.unionByName(halves[2]).unionByName(halves[3]), ["k"], clocks, ["s"])
    assert _rows(newest_of_state(merged, ["k"], clocks, ["s"])) == _rows(newest_version_sums(df, ["k"], clocks, sums))
    assert _rows(merged) == _rows(state(df))

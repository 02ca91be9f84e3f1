"""A hot key holding half of all rows: results stay exact, plans stay partial.

The newest-version step must not route a hot key's rows to one task: its sums,
its newest clocks and the monthly rollup combine partially on the map side. The result is checked against the window formulation (the
brute-force reading of the semantics).
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_SMALL
from stockbook.functions.audit import RunInfo
from stockbook.functions.exact import as_double, qty
from stockbook.plans.facts import FACT_POS
from stockbook.sources.driver_tables import bronze_from_driver

RUN = RunInfo(user="k")


def _hot_pos(spark):
    pos = bronze_from_driver(spark, SF_SMALL).inventory_pos_history_details
    hot = F.col("pos_end_quantity") % 2 == 1          # over half of the rows
    return pos.select(
        F.when(hot, F.lit(0)).otherwise(F.col("product_id")).cast("long").alias("product_id"),
        F.when(hot, F.lit(0)).otherwise(F.col("country_id")).cast("int").alias("country_id"),
        "update_date",
        F.when(hot, F.lit("1999-05-05").cast("date")).otherwise(F.col("transaction_date")).alias("transaction_date"),
        "pos_sell_out_quantity", "pos_open_quantity", "pos_end_quantity", "unit_price")


def _window_reference(pos):
    w = Window.partitionBy("product_id", "country_id", "transaction_date")
    kept = pos.withColumn("_m", F.max("update_date").over(w)).filter(F.col("update_date") == F.col("_m"))
    return (kept.groupBy("product_id", "country_id", F.trunc("transaction_date", "MM").alias("transaction_date"))
            .agg(as_double(F.sum(qty("pos_sell_out_quantity"))).alias("q"), F.max("update_date").alias("u")))


def test_hot_key_result_matches_window_semantics(spark):
    pos = _hot_pos(spark)
    assert pos.filter(F.col("product_id") == 0).count() * 2 >= pos.count() * 0.9
    got = FACT_POS.full(pos, run=RUN).select(
        "product_id", "country_id", "transaction_date", F.col("pos_sell_out_quantity").alias("q"),
        F.col("pos_update_date").alias("u"))
    exp = _window_reference(pos)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, exp.collect()))


def test_hot_key_is_combined_before_every_shuffle(spark):
    plan = FACT_POS.full(_hot_pos(spark), run=RUN)._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    # every shuffle in front of an aggregation carries partial aggregates only
    feeds = [lines[i + 1] for i, line in enumerate(lines)
             if "Exchange hashpartitioning" in line and "HashAggregate" in lines[i + 1]]
    assert len(feeds) >= 3                         # sums a clock, newest clock, monthly rollup
    assert all("partial_" in f for f in feeds), feeds
    assert "LeftSemi" not in plan
    assert "Window" not in plan


def test_hot_order_join_is_split_and_result_unchanged(spark):
    """Half of all order lines on one order: AQE splits the join partition
    (forced, so the versioning gets its own shuffle) and the fact is the same."""
    from stockbook.plans.dimensions import customer_rows
    from stockbook.plans.facts import FACT_SALES

    b = bronze_from_driver(spark, SF_SMALL)
    hot = F.col("quantity") % 2 == 0
    # several map tasks, as a many-file bronze table has: a skewed partition
    # can only be split between the map outputs that feed it
    lines = (b.order_details.withColumn("order_id", F.when(hot, F.lit(1)).otherwise(F.col("order_id")).cast("long"))
             .repartition(8))
    cust = customer_rows(b.customers, b.countries)
    expected = sorted(map(tuple, FACT_SALES.full(b.orders, lines, cust, run=RUN).drop("update_ts", "insert_ts").collect()), key=repr)
    keys = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1KB",
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        df = FACT_SALES.full(b.orders, lines, cust, run=RUN).drop("update_ts", "insert_ts")
        got = sorted(map(tuple, df.collect()), key=repr)
        final = df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert got == expected
    assert "skew=true" in final

"""The stream-driven incremental load equals a full refresh."""

import tempfile

from pyspark.sql import functions as F

from stockbook.functions.audit import RunInfo
from stockbook.plans.facts import FACT_POS
from stockbook.sources.driver_tables import bronze_from_driver
from stockbook.sources.tables import load_table
from stockbook.streaming import stream_into_table

from conftest import SF_SMALL

RUN = RunInfo(user="s")


def _cmp(df):
    return sorted(tuple(r) for r in df.drop("update_ts", "insert_ts", "updated_by", "inserted_by").collect())


def test_two_drops_stream_equals_full_refresh(spark):
    pos = bronze_from_driver(spark, SF_SMALL).inventory_pos_history_details
    root = tempfile.mkdtemp(prefix="stream-", dir="/tmp")
    table = f"{root}/bronze/inventory_pos_history_details"
    cut = F.lit("1998-01-01").cast("timestamp_ntz")
    pos.filter(F.col("update_date") < cut).write.mode("append").parquet(table)

    def go():
        q = stream_into_table(spark, FACT_POS, "inventory_pos_history_details", f"{root}/bronze",
                              lambda df: (df,), f"{root}/s_f_pos", f"{root}/ckpt", run=RUN)
        q.awaitTermination()

    go()
    pos.filter(F.col("update_date") >= cut).write.mode("append").parquet(table)
    go()
    got = load_table(spark, f"{root}/s_f_pos", like=FACT_POS.full(pos, run=RUN))
    assert _cmp(got) == _cmp(FACT_POS.full(pos, run=RUN))


def test_delta_stream_of_new_months_equals_full_refresh(spark):
    pos = bronze_from_driver(spark, SF_SMALL).inventory_pos_history_details
    root = tempfile.mkdtemp(prefix="stream-", dir="/tmp")
    table = f"{root}/bronze/inventory_pos_history_details"
    cut = F.lit("1998-01-01").cast("date")
    # whole days per drop: every version of a day arrives in the same drop
    pos.filter(F.col("transaction_date") < cut).write.mode("append").parquet(table)

    def go():
        q = stream_into_table(spark, FACT_POS, "inventory_pos_history_details", f"{root}/bronze",
                              lambda df: (df,), f"{root}/s_f_pos", f"{root}/ckpt", run=RUN, mode="delta")
        q.awaitTermination()

    go()
    pos.filter(F.col("transaction_date") >= cut).write.mode("append").parquet(table)
    go()
    got = load_table(spark, f"{root}/s_f_pos", like=FACT_POS.full(pos, run=RUN))
    assert _cmp(got) == _cmp(FACT_POS.full(pos, run=RUN))
    # rows inserted by the delta batch carry no insert audit
    assert got.filter(F.col("inserted_by").isNull()).count() > 0


def test_state_stream_reads_each_file_once_and_equals_full_refresh(spark):
    """Late rows (below the newest clock) count."""
    pos = bronze_from_driver(spark, SF_SMALL).inventory_pos_history_details.filter("transaction_date < '1995-04-01'").checkpoint()
    root = tempfile.mkdtemp(prefix="stream-", dir="/tmp")
    table = f"{root}/bronze/inventory_pos_history_details"

    def go():
        q = stream_into_table(spark, FACT_POS, "inventory_pos_history_details", f"{root}/bronze", lambda df: (df,),
                              f"{root}/s_f_pos", f"{root}/ckpt", run=RUN, mode="state", state_path=f"{root}/state")
        q.awaitTermination()

    for late in (False, True):
        pos.filter((F.dayofmonth("update_date") <= 9) == late).coalesce(1).write.mode("append").parquet(table)
        go()
    got = load_table(spark, f"{root}/s_f_pos", like=FACT_POS.full(pos, run=RUN))
    assert _cmp(got) == _cmp(FACT_POS.full(pos, run=RUN))

"""Incremental loads driven by Structured Streaming.

The batch models find new rows with a high-water mark on an update clock;
rows that arrive late, at or below the mark, are never loaded. A file
stream tracks exactly which files it has read in its checkpoint instead, so
every delivered row is loaded once, late or not. Each micro-batch:

1. takes the batch's rows as the changed rows (``model.rows`` over the batch
   plus the static inputs, e.g. the customer dimension);
2. runs ``delta`` (merge the batch's aggregate), ``recompute`` (rebuild
   every touched key from all bronze rows, read statically) or ``state``
   (rebuild every touched key from the kept state of ``sources.version_state``
   and the batch; nothing delivered before is read) against the stored target;
3. stages the touched partitions with a reliable checkpoint and overwrites
   just those partitions.

``foreachBatch`` may replay a batch after a failure; ``delta`` and ``recompute``
give the same table when a batch is applied twice, ``state`` skips a batch whose
number it has applied, so the sink is idempotent.
``trigger(availableNow=True)`` drains what is there and stops, like a
scheduled batch run; a processing-time trigger keeps it running.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import functions as F
from pyspark.sql import DataFrame, SparkSession

from stockbook.functions.audit import RunInfo
from stockbook.plans.model import IncrementalModel
from stockbook.session import ensure_checkpoint_dir
from stockbook.sources.schemas import BRONZE_SCHEMAS
from stockbook.sources.tables import load_table, replace_partitions, save_table, table_exists
from stockbook.sources.version_state import apply_delivery


def stream_into_table(
    spark: SparkSession,
    model: IncrementalModel,
    streamed_table: str,
    bronze_root: str,
    inputs: Callable[[DataFrame], tuple[DataFrame, ...]],
    target_path: str,
    checkpoint_location: str,
    run: RunInfo = RunInfo(),
    mode: str = "recompute",
    on_duplicate: str = "error",
    max_files_per_trigger: int | None = None,
    state_path: str | None = None,
):
    """Load ``model`` at ``target_path`` from new files of one bronze table.

    ``inputs(df)`` turns a frame of ``streamed_table`` rows into the model's
    input tuple (adding static tables such as customers). ``mode="state"`` keeps
    its state at ``state_path``, which belongs to this stream alone.
    """
    if (mode == "state") != (state_path is not None):
        raise ValueError("state_path goes with mode='state'")
    schema = BRONZE_SCHEMAS[streamed_table]
    src_path = f"{bronze_root.rstrip('/')}/{streamed_table}"
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(src_path)

    def handle(batch: DataFrame, epoch_id: int) -> None:
        batch_spark = batch.sparkSession
        if mode == "state":
            apply_delivery(batch_spark, model, model.rows(*inputs(batch)), path=target_path, state=state_path,
                           run=run, number=epoch_id)
            return
        if not table_exists(batch_spark, target_path):
            everything = batch_spark.read.schema(schema).parquet(src_path)
            save_table(model.full(*inputs(everything), run=run), target_path, model.partition_col)
            return
        shape = model.full(*inputs(batch), run=run)
        target = load_table(batch_spark, target_path, like=shape)
        all_rows = model.rows(*inputs(batch_spark.read.schema(schema).parquet(src_path)))
        changed = model.rows(*inputs(batch))
        merged = model.incremental_from(all_rows, changed, target=target, run=run, mode=mode,
                                        on_duplicate=on_duplicate)
        part = model.partition_col
        exprs = model.key_exprs()
        ensure_checkpoint_dir(batch_spark)
        touched = changed.select(exprs[part].alias(part)).distinct().checkpoint(eager=True)
        probe = touched.select(F.col(part).alias("_p"))
        staged = merged.join(probe, merged[part].eqNullSafe(probe["_p"]), "left_semi").checkpoint(eager=True)
        replace_partitions(staged, touched, target_path, part)

    return (stream.writeStream.foreachBatch(handle)
            .option("checkpointLocation", checkpoint_location)
            .trigger(availableNow=True)
            .start())


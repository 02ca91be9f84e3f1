"""Shared helpers of the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockbook.session import ensure_checkpoint_dir

#: Bytes that part words: space and \t \n \v \f \r (what ``bytes.split()`` splits on).
BLANKS = " \t\n\x0b\x0c\r"
MASK64 = (1 << 64) - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame) -> DataFrame:
    """Cut the lineage: a reliable checkpoint in ``spark.checkpoint.dir``."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


#: Bytes of one Arrow batch of texts: Spark's own limits, 10,000 rows or 64 MB, let long texts fill a worker.
BATCH_BYTES = 8 << 20


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, whose texts go to Python workers in batches of some 8 MB, unless the session sets a limit of its own."""
    conf = df.sparkSession.conf
    if conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) in (None, ""):
        conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df


#: Rows of (long, long) up to which a counted side may be broadcast: some 16 MB.
BROADCAST_ROWS = 1_000_000


def small(df: DataFrame) -> DataFrame:
    """``df``, a stored frame of a few longs, broadcast if its counted rows allow it."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def fresh(df: DataFrame, base: str) -> str:
    """A column name that no column of ``df`` has (case-insensitively)."""
    taken = {c.lower() for c in df.columns}
    name = f"sb_{base}"
    while name.lower() in taken:
        name += "_"
    return name


def sorted_runs(batches: Iterator[pa.RecordBatch], keys: list[str], words: tuple[str, ...] = ()) -> Iterator[dict]:
    """Runs of equal ``keys`` in batches sorted by them: column name -> numpy array.

    Binary columns named in ``words`` are of one width within a run and come as
    a matrix of unsigned 64-bit words. Holds one run and one batch at a time; callers bound
    the runs.
    """
    import numpy as np

    def run(columns: dict, a: int, b: int | None) -> dict:
        out = {n: c[a:b] for n, c in columns.items()}
        return out | {n: np.frombuffer(b"".join(out[n].tolist()), np.uint64).reshape(len(out[n]), -1) for n in words}

    held: dict = {}
    for batch in batches:
        if not batch.num_rows:
            continue
        now = {n: batch.column(i).to_numpy(zero_copy_only=False) for i, n in enumerate(batch.schema.names)}
        if held:
            now = {n: np.concatenate([held[n], c]) for n, c in now.items()}
        rows = len(now[keys[0]])
        cut = np.zeros(rows, bool)
        for k in keys:
            cut[1:] |= now[k][1:] != now[k][:-1]
        starts = [0, *np.flatnonzero(cut).tolist()]
        for a, b in zip(starts, starts[1:], strict=False):
            yield run(now, a, b)
        held = {n: c[starts[-1]:] for n, c in now.items()}
    if held:
        yield run(held, 0, None)


def null_id(name: str = "doc_id") -> Column:
    """A document id for ordering: null counts as the smallest."""
    return F.coalesce(F.col(name), F.lit(-(2**63)))


def stored_table(df: DataFrame) -> DataFrame:
    """Like ``stored``, as a Parquet table beside the checkpoints: smaller, and pruned by column when read.

    The folder lies in the checkpoint directory and is named anew each time;
    whoever owns that directory removes it with the job's checkpoints.
    """
    import uuid

    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/table-{uuid.uuid4()}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)

"""Silver and gold tables on storage: full rebuild and incremental load.

Tables are parquet folders. A rebuild writes a fresh folder beside the table
and then switches: the old folder is renamed away, the new one takes its
name, and only then the old one is deleted. A failed write leaves the table as
it was, and no partition of an earlier build survives.

Facts are partitioned by month (their merge key always holds a month), so an
incremental run replaces only the months it touched, with dynamic partition
overwrite asked for at that write alone. Months the run left empty are dropped.
That write stages its files and puts them in place once all are written, so the
merged rows may read the partitions they replace. ``load_model`` needs them twice
and checkpoints them first, into the cluster's ``spark.checkpoint.dir``.
Tables are compressed with zstd.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockbook.functions.audit import RunInfo
from stockbook.plans.model import IncrementalModel
from stockbook.session import ensure_checkpoint_dir


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` holds a parquet table (lists files, reads no rows).

    Only a missing path counts as absent; a table that cannot be read is an
    error, never a reason to load it anew. A rebuild that broke off between its
    two renames is completed by putting the old table back.
    """
    fs, old = _fs(spark, path), f"{path.rstrip('/')}{_OLD}"
    if not _has(spark, fs, path) and _has(spark, fs, old):
        _rename(spark, fs, old, path)
    try:
        spark.read.parquet(path).schema
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return False
        if not _is_empty_write(spark, path, e):
            raise
    return True


def _is_empty_write(spark: SparkSession, path: str, e: AnalysisException) -> bool:
    """Whether a finished write of no rows by partition left nothing but its marker."""
    return e.getCondition() == "UNABLE_TO_INFER_SCHEMA" and _has(spark, _fs(spark, path), f"{path.rstrip('/')}/_SUCCESS")


_NEW, _OLD = ".rebuild", ".replaced"
CODEC = "zstd"


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path.rstrip("/"))


def _fs(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def _has(spark: SparkSession, fs, path: str) -> bool:
    return fs.exists(_path(spark, path))


def _rename(spark: SparkSession, fs, a: str, b: str) -> None:
    if not fs.rename(_path(spark, a), _path(spark, b)):
        raise OSError(f"cannot rename {a} to {b}")


_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Jobs run within remove their shuffle files when they end.

    Otherwise the files of a finished write stay on the executors' disks until the driver
    happens to collect its plan, beside the shuffles of all jobs that follow.
    """
    before = spark.conf.get(_FREE_SHUFFLES, None)
    spark.conf.set(_FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_FREE_SHUFFLES)
        else:
            spark.conf.set(_FREE_SHUFFLES, before)


def _balanced(df: DataFrame, partition_by: str) -> DataFrame:
    """Group rows by output partition before writing (AQE ``REBALANCE``).

    Without it every task writes a small file into every month it holds;
    with it AQE cuts large months into several tasks and merges small ones,
    so files come out near the advisory size.
    """
    return df.hint("rebalance", partition_by)


def save_table(df: DataFrame, path: str, partition_by: str | None = None, placed: bool = False) -> None:
    """Full rebuild (first load, full refresh, gold tables); ``df`` may read the old table.

    ``placed``: the rows already lie by partition, few partitions a task.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    fs, new, old = _fs(spark, path), path + _NEW, path + _OLD
    w = (_balanced(df, partition_by) if partition_by and not placed else df).write.mode("overwrite").options(
        partitionOverwriteMode="static", compression=CODEC)
    if partition_by:
        w = w.partitionBy(partition_by)
    with freed_shuffles(spark):
        w.parquet(new)
    if _has(spark, fs, path):
        fs.delete(_path(spark, old), True)
        _rename(spark, fs, path, old)
    _rename(spark, fs, new, path)
    fs.delete(_path(spark, old), True)
    spark.catalog.refreshByPath(path)


def replace_partitions(staged: DataFrame, touched: DataFrame, path: str, part: str, placed: bool = False) -> None:
    """Put the ``staged`` rows in place of the ``touched`` values' partitions; they may read the table itself.

    Values without a staged row lose their partition: the write leaves their files
    alone, all others' are new. ``touched`` gives one value a month; ``placed`` as in
    ``save_table``.
    """
    spark = staged.sparkSession
    fs = _fs(spark, path)
    values = [r.v for r in touched.select(F.col(part).cast("string").alias("v")).distinct().collect()]
    folders = [f"{path.rstrip('/')}/{part}={'__HIVE_DEFAULT_PARTITION__' if v is None else v}" for v in values]
    before = {f: _files(spark, fs, f) for f in folders}
    with freed_shuffles(spark):
        ((staged if placed else _balanced(staged, part)).write.mode("overwrite")
         .options(partitionOverwriteMode="dynamic", compression=CODEC).partitionBy(part).parquet(path))
    for folder, names in before.items():
        if names & _files(spark, fs, folder):
            fs.delete(_path(spark, folder), True)
    spark.catalog.refreshByPath(path)


def _files(spark: SparkSession, fs, folder: str) -> set[str]:
    return {f.getPath().getName() for f in fs.listStatus(_path(spark, folder))} if _has(spark, fs, folder) else set()


def as_view(df: DataFrame, name: str) -> DataFrame:
    """View sink: register ``df`` under ``name`` for SQL, nothing is written."""
    df.createOrReplaceTempView(name)
    return df


def load_table(spark: SparkSession, path: str, like: DataFrame | None = None) -> DataFrame:
    """Read a stored table; ``like`` restores the column order and types (and reads a table without rows)."""
    try:
        df = spark.read.parquet(path)
    except AnalysisException as e:
        if like is None or not _is_empty_write(spark, path, e):
            raise
        return spark.createDataFrame([], like.schema)
    if like is not None:
        df = df.select(*[F.col(f.name).cast(f.dataType.simpleString()).alias(f.name) for f in like.schema.fields])
    return df


def load_model(spark: SparkSession, model: IncrementalModel, *inputs: DataFrame, path: str,
               run: RunInfo = RunInfo(), mode: str = "recompute", on_duplicate: str = "error",
               full_refresh: bool = False) -> str:
    """Build or update ``model`` at ``path``; returns what was done.

    First load (or ``full_refresh``): build from all rows and overwrite.
    Otherwise: run the incremental load against the stored table and replace
    only the partitions holding a changed key.
    """
    part = model.partition_col
    if full_refresh or not table_exists(spark, path):
        save_table(model.full(*inputs, run=run), path, part)
        return "full"
    shape = model.full(*inputs, run=run)  # schema only, never executed
    target = load_table(spark, path, like=shape)
    merged = model.incremental(*inputs, target=target, run=run, mode=mode, on_duplicate=on_duplicate)
    if part is None:
        save_table(merged, path)
        return "rewritten"
    ensure_checkpoint_dir(spark)
    touched = model.touched_partitions(*inputs, target=target).checkpoint(eager=True)
    probe = touched.select(F.col(part).alias("_p"))
    staged = merged.join(probe, merged[part].eqNullSafe(probe["_p"]), "left_semi").checkpoint(eager=True)
    replace_partitions(staged, touched, path, part)
    return "partitions"

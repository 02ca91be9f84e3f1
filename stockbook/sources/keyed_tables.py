"""Silver tables stored by their merge key and switched by one catalog change.

A keyed table is an external catalog table (parquet) whose rows lie in buckets of
the merge key, sorted by it. Joins and windows on the key read it where it lies: a
merge shuffles the delivery to the table's buckets and never the table.

Every write goes to a fresh folder under the table's root. The switch is a single
catalog change, the table's location (at first: its name), so a reader sees the old
rows or the new ones at every moment, and a run broken off at any step leaves the
old table. The version before the newest stays on storage for readers that are
still at work on it; older ones, and those of broken runs, go with the next write.
One writer a table at a time.

The catalog keeps the number of buckets: files must never be read under another
one, so a change of keys, buckets or columns is refused (``drop_keyed_table`` first).
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockbook.functions.audit import RunInfo
from stockbook.plans.model import IncrementalModel
from stockbook.sources.tables import CODEC, _fs, _path, freed_shuffles


def keyed_table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def _details(spark: SparkSession, name: str) -> dict[str, str]:
    """Location, number of buckets and bucket columns as the catalog states them."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter(
        F.col("col_name").isin("Location", "Num Buckets", "Bucket Columns")).collect()
    return {r.col_name: r.data_type for r in rows}


def _write_version(df: DataFrame, name: str, path: str, keys: Sequence[str], buckets: int, placed: bool = False,
                   sort: Sequence[str] = ()) -> None:
    """A catalog entry ``name`` over the fresh folder ``path``: one task and one file a bucket, sorted by ``sort`` or the keys."""
    with freed_shuffles(df.sparkSession):
        ((df if placed else df.repartition(buckets, *keys)).write.format("parquet").bucketBy(buckets, *keys).sortBy(*(sort or keys))
         .options(path=path, compression=CODEC).saveAsTable(name))


def _point(spark: SparkSession, name: str, entry: str, path: str) -> None:
    """The switch: one catalog change makes ``path`` the table's rows."""
    if keyed_table_exists(spark, name):
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
    else:
        spark.sql(f"ALTER TABLE {entry} RENAME TO {name}")


def save_keyed_table(df: DataFrame, name: str, root: str, keys: Sequence[str], buckets: int,
                     placed: bool = False) -> DataFrame:
    """Replace the rows of table ``name`` by ``df``, which may read the table itself.

    ``buckets`` is fixed for the table's life; choose it so that a bucket is some
    hundred megabytes at the size expected. NULL keys are a bucket's rows like others.
    ``placed``: each task of ``df`` already holds one bucket, as after a merge into the
    table (Spark does not know it of a full outer join), so the rows are written where
    they are; where that is not so, a bucket only gets several files.
    """
    spark, root, keys = df.sparkSession, root.rstrip("/"), list(keys)
    old = None
    if keyed_table_exists(spark, name):
        d = _details(spark, name)
        same = (d.get("Num Buckets") == str(buckets) and d.get("Bucket Columns") == str([f"`{k}`" for k in keys]).replace("'", "")
                and [(f.name, f.dataType) for f in spark.table(name).schema] == [(f.name, f.dataType) for f in df.schema])
        if not same:
            raise ValueError(f"{name} is stored with other keys, buckets or columns; drop it first")
        old = d["Location"].rstrip("/").rsplit("/", 1)[-1]
    version = f"v-{uuid.uuid4().hex}"
    _tidy(spark, name, root, {old})
    entry = f"{name}__{version[2:]}"
    _write_version(df, entry, f"{root}/{version}", keys, buckets, placed)
    _point(spark, name, entry, f"{root}/{version}")
    spark.sql(f"DROP TABLE IF EXISTS {entry}")  # the entry alone: the files are the table's now
    return spark.table(name)


def _tidy(spark: SparkSession, name: str, root: str, keep: set[str | None]) -> None:
    """Remove entries and folders that neither the table nor its last readers use."""
    short = name.rsplit(".", 1)[-1]
    database = name[: -len(short) - 1] if "." in name else spark.catalog.currentDatabase()
    for t in spark.catalog.listTables(database, f"{short}__*"):
        spark.sql(f"DROP TABLE IF EXISTS {database}.{t.name}")
    fs, at = _fs(spark, root), _path(spark, root)
    if fs.exists(at):
        for f in fs.listStatus(at):
            folder = f.getPath().getName()
            if folder.startswith("v-") and folder not in keep:
                fs.delete(f.getPath(), True)


def drop_keyed_table(spark: SparkSession, name: str) -> None:
    """Forget the table; its files stay (it is external)."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def load_keyed_model(spark: SparkSession, model: IncrementalModel, *inputs: DataFrame, name: str, root: str,
                     buckets: int, run: RunInfo = RunInfo(), mode: str = "recompute", on_duplicate: str = "error",
                     full_refresh: bool = False) -> str:
    """Build or update ``model`` as the keyed table ``name``; returns what was done.

    ``delta`` merges the delivery into the buckets; ``recompute`` rebuilds the touched keys.
    """
    if full_refresh or not keyed_table_exists(spark, name):
        save_keyed_table(model.full(*inputs, run=run), name, root, model.keys, buckets)
        return "full"
    target = spark.table(name)
    after = model.incremental(*inputs, target=target, run=run, mode=mode, on_duplicate=on_duplicate, buckets=buckets)
    save_keyed_table(after, name, root, model.keys, buckets, placed=mode == "delta")
    return "merged"


def keyed_frame(df: DataFrame, path: str, keys: Sequence[str], buckets: int, placed: bool = False,
                sort: Sequence[str] = ()) -> DataFrame:
    """``df`` written in buckets to the fresh folder ``path`` and read back, without a lasting catalog entry.

    ``placed`` as in ``save_keyed_table``: a fact in pieces lies in buckets of ``dealt_by``.
    """
    spark, entry = df.sparkSession, f"keyed_{uuid.uuid4().hex}"
    _write_version(df, entry, path, keys, buckets, placed, sort)
    # columns without the entry as qualifier: with it a union of such frames forgets how they are dealt
    frame = spark.table(entry).select(*[F.col(c).alias(c) for c in df.columns])
    spark.sql(f"DROP TABLE {entry}")
    return frame

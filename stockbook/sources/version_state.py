"""Incremental facts from a kept state: a run costs its delivery, not the bronze tables.

Beside a fact table lies its state (``operators.versions.version_state``): one row
per version key with the newest clocks and the sums at them, in folders by month:

    <state>/base-<k>/load=<k>/month_part=...   all deliveries up to load k
    <state>/base-<k>/load=<n>/month_part=...   one delivery each, n > k

A run reads bronze above the state's own mark (exact clocks, where the tables keep
dates), writes the delivery's state as the next load, merges it with the stored
state of the months it touches, rolls up the touched keys alone and replaces those
months of the table. No row delivered earlier is read again: other months of state and
table are cut off by partition filters, and the mark is a maximum of longs that Spark
takes from the Parquet footers. The result is a full refresh of all rows, where sources
are append-only and rows arrive in the order of their clock; rows without a clock enter
with the first load alone.

The table is replaced first; the load counts once its marker file is there. A run that
breaks off between is done again with the same rows and the same result. After
``max_loads`` loads the state is merged into the next base, which counts from its own
marker on. One writer a table at a time.
"""

from __future__ import annotations

import datetime as _dt
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stockbook.functions.audit import RunInfo, with_audit
from stockbook.operators.incremental import DEFAULT_FALLBACK, above_mark
from stockbook.operators.versions import SEEN
from stockbook.plans.model import IncrementalModel
from stockbook.sources.tables import CODEC, _balanced, _fs, _path, freed_shuffles, load_table, replace_partitions, save_table, table_exists

MONTH, APPLIED = "month_part", "_APPLIED"
NEW = "_new"  # whether a row comes from the delivery
# Spark's second Parquet reader answers a bare MAX of longs from the files' footers.
_FOOTER_READER = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}


# ---------------------------------------------------------------- layout

def _base_path(state: str, base: int) -> str:
    return f"{state.rstrip('/')}/base-{base:012d}"


def _load_path(state: str, base: int, n: int) -> str:
    return f"{_base_path(state, base)}/load={n:012d}"


def _numbers(spark: SparkSession, path: str, kind: str) -> list[int]:
    fs, at = _fs(spark, path), _path(spark, path)
    names = [f.getPath().getName() for f in fs.listStatus(at)] if fs.exists(at) else []
    return sorted(int(x.removeprefix(kind)) for x in names if x.startswith(kind))


def _is_applied(spark: SparkSession, path: str) -> bool:
    return _fs(spark, path).exists(_path(spark, f"{path}/{APPLIED}"))


def _set_applied(spark: SparkSession, path: str) -> None:
    """The commit of a load: one small file, created in one step on any file system."""
    _fs(spark, path).create(_path(spark, f"{path}/{APPLIED}"), True).close()


def applied_loads(spark: SparkSession, state: str) -> tuple[int, list[int]] | None:
    """(base, its applied loads, the base first), or None where no load was applied."""
    for base in reversed(_numbers(spark, state, "base-")):
        if _is_applied(spark, _load_path(state, base, base)):
            return base, [n for n in _numbers(spark, _base_path(state, base), "load=") if _is_applied(spark, _load_path(state, base, n))]
    return None


def _drop_other_bases(spark: SparkSession, state: str, keep: int) -> None:
    for base in _numbers(spark, state, "base-"):
        if base != keep:
            _fs(spark, state).delete(_path(spark, _base_path(state, base)), True)


# ---------------------------------------------------------------- reading and writing

def _with_month(model: IncrementalModel, state: DataFrame) -> DataFrame:
    return state.withColumn(MONTH, model.key_exprs()[model.partition_col])


def _write_load(df: DataFrame, path: str, placed: bool = False) -> None:
    """``placed``: the rows already lie by month (``IncrementalModel.state`` in pieces)."""
    with freed_shuffles(df.sparkSession):
        ((df if placed else _balanced(df, MONTH)).write.mode("overwrite").options(partitionOverwriteMode="static", compression=CODEC)
         .partitionBy(MONTH).parquet(path))


def _read_loads(spark: SparkSession, schema: StructType, state: str, base: int, loads: list[int]) -> DataFrame:
    read = spark.read.schema(schema).option("basePath", _base_path(state, base))
    return read.parquet(*[_load_path(state, base, n) for n in loads]).select(*schema.names)


def read_state(spark: SparkSession, model: IncrementalModel, rows: DataFrame, state: str) -> DataFrame:
    """The stored state rows of all applied loads (a key has one a load); ``rows`` gives the types."""
    base, loads = applied_loads(spark, state)
    return _read_loads(spark, _with_month(model, model.state(rows)).schema, state, base, loads)


def seen_by(spark: SparkSession, model: IncrementalModel, rows: DataFrame, state: str) -> DataFrame:
    """One row, the latest delivery clock of the applied loads in microseconds (footers alone are read).

    The schema given must be the files' own, all columns in their order: Spark takes
    the footer's statistics by the column's place in it, not by its name.
    """
    base, loads = applied_loads(spark, state)
    aside = spark.newSession()  # the reader is chosen by settings, which the caller's session keeps
    for key, value in _FOOTER_READER.items():
        aside.conf.set(key, value)
    read = aside.read.schema(model.state(rows).schema).option("basePath", _base_path(state, base))
    return read.parquet(*[_load_path(state, base, n) for n in loads]).agg(F.max(SEEN).alias("mark"))


def state_mark(spark: SparkSession, model: IncrementalModel, rows: DataFrame, state: str) -> Column:
    """The state's mark as a literal, so that the filter on bronze reaches its Parquet files."""
    micros = seen_by(spark, model, rows, state).first()[0]
    mark = DEFAULT_FALLBACK if micros is None else (_dt.datetime(1970, 1, 1) + _dt.timedelta(microseconds=micros)).isoformat(" ")
    return F.lit(mark).cast("timestamp_ntz")


def _in_months(column: str, months: list) -> Column:
    dates = [F.col(column) == F.lit(m) for m in months if m is not None]
    return reduce(lambda a, b: a | b, dates + ([F.col(column).isNull()] if None in months else []))


# ---------------------------------------------------------------- loads

def load_with_state(spark: SparkSession, model: IncrementalModel, *inputs: DataFrame, path: str, state: str,
                    run: RunInfo = RunInfo(), full_refresh: bool = False, max_loads: int = 16) -> str:
    """Build or update ``model`` at ``path`` with its state at ``state``; returns what was done."""
    rows = model.rows(*inputs)
    known = applied_loads(spark, state)
    if full_refresh or known is None or not table_exists(spark, path):
        _first_load(spark, model, rows, path, state, run, known[1][-1] + 1 if known else 0)
        return "full"
    new = above_mark(rows, model.delivery_clock(), state_mark(spark, model, rows, state))
    return apply_delivery(spark, model, new, path=path, state=state, run=run, max_loads=max_loads)


def _first_load(spark: SparkSession, model: IncrementalModel, rows: DataFrame, path: str, state: str, run: RunInfo, n: int) -> None:
    at = _load_path(state, n, n)
    _write_load(_with_month(model, model.state(rows)), at, bool(model.pieces))
    stored = _read_loads(spark, _with_month(model, model.state(rows)).schema, state, n, [n])
    # files of the state hold one month each, and without a rollup the rows stay with their file
    save_table(with_audit(model.table_of_state(stored), run, first_load=True), path, model.partition_col,
               bool(model.pieces) and not model.rolls_up)
    _set_applied(spark, at)
    _drop_other_bases(spark, state, n)


def apply_delivery(spark: SparkSession, model: IncrementalModel, delivered: DataFrame, path: str, state: str,
                   run: RunInfo = RunInfo(), number: int | None = None, max_loads: int = 16) -> str:
    """Merge new prepared rows into state and table.

    ``number`` names the delivery (a stream's batch): one that was applied before is
    skipped, so each counts once. Without it the next number is taken. Where there is
    no state yet, the delivery is the first load.
    """
    known = applied_loads(spark, state)
    if known is None:
        _first_load(spark, model, delivered, path, state, run, number or 0)
        return "full"
    base, loads = known
    if number is not None and number <= loads[-1]:
        return "applied before"
    if len(loads) >= max_loads:
        base, loads = _compact(spark, model, delivered, state, base, loads)
    n = loads[-1] + 1 if number is None else number
    at, part = _load_path(state, base, n), model.partition_col
    fresh = _with_month(model, model.state(delivered))
    _write_load(fresh, at, bool(model.pieces))
    delta = _read_loads(spark, fresh.schema, state, base, [n])
    months = [r[0] for r in delta.select(MONTH).distinct().collect()]  # one value a month
    if not months:
        _set_applied(spark, at)
        return "no new rows"
    stored = _read_loads(spark, fresh.schema, state, base, loads)
    shape = with_audit(model.rollup(delta), run, first_load=True)  # for its columns and types alone
    held, parts = months, []
    if not model.rolls_up:  # a month without a stored row is the delivery's alone: its states are the table's rows as they lie
        known_months = {r[0] for r in stored.filter(_in_months(MONTH, months)).select(MONTH).distinct().collect()}
        held = [m for m in months if m in known_months]
        if len(held) < len(months):
            parts.append(model.table_of_state(delta.filter(_in_months(MONTH, [m for m in months if m not in known_months]))))
    if held:
        met = delta.filter(_in_months(MONTH, held)) if len(held) < len(months) else delta
        parts.append(affected_table(model, stored, met, held))
    rows = reduce(DataFrame.unionByName, parts)
    staged = with_audit(rows, run, first_load=True).select(*shape.columns)
    if held:
        target = load_table(spark, path, like=shape).filter(_in_months(part, held))
        staged = untouched_rows(model, target, met).unionByName(staged)
    replace_partitions(staged, delta.select(F.col(MONTH).alias(part)), path, part, bool(model.pieces) and not model.by_day)
    _set_applied(spark, at)
    return "partitions"


def _of_delivered_keys(keys: list[str]) -> Column:
    """Whether a row's key (NULLs equal) has a row of the delivery."""
    return F.max(NEW).over(Window.partitionBy(*keys))


def _table_keys(model: IncrementalModel, month: str) -> list[str]:
    """The table's key over state rows, whose ``month`` stands for the date."""
    return [month if k == model.partition_col else k for k in model.keys]


def affected_table(model: IncrementalModel, stored: DataFrame, delta: DataFrame, months: list) -> DataFrame:
    """The table's rows of the keys in ``delta``, from the stored state of their months and the delivery.

    Both are dealt once, by month, product and country; touched keys are told and their
    states merged where the rows lie.
    """
    month = MONTH if model.by_day else model.partition_col
    rows = (stored.filter(_in_months(MONTH, months)).select(*delta.columns, F.lit(False).alias(NEW))
            .unionByName(delta.withColumn(NEW, F.lit(True))))
    rows = model.dealt_by_date(rows, month)
    rows = rows.withColumn("_touched", _of_delivered_keys(_table_keys(model, month))).filter("_touched")
    return model.table_of_state(model.merge_states(rows, placed_by=month))


def untouched_rows(model: IncrementalModel, target: DataFrame, delta: DataFrame) -> DataFrame:
    """The rows of ``target`` whose key ``delta`` does not touch, dealt as in ``affected_table``."""
    held = {k: F.col(MONTH if k == model.partition_col else k).cast(target.schema[k].dataType) for k in model.keys}
    probe = delta.select(*[held.get(f.name, F.lit(None).cast(f.dataType)).alias(f.name) for f in target.schema.fields], F.lit(True).alias(NEW))
    rows = model.dealt_by_date(target.withColumn(NEW, F.lit(False)).unionByName(probe), model.partition_col)
    rows = rows.withColumn("_touched", _of_delivered_keys(list(model.keys)))
    return rows.filter(~F.col("_touched")).select(*target.columns)


def _compact(spark: SparkSession, model: IncrementalModel, rows: DataFrame, state: str, base: int, loads: list[int]) -> tuple[int, list[int]]:
    """All loads merged into a new base of the newest load's number."""
    last = loads[-1]
    if last == base:
        return base, loads
    stored = _read_loads(spark, _with_month(model, model.state(rows)).schema, state, base, loads)
    _write_load(_with_month(model, model.merge_states(stored)), _load_path(state, last, last))
    _set_applied(spark, _load_path(state, last, last))
    _drop_other_bases(spark, state, last)
    return last, [last]

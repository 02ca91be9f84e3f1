"""Incremental loading: high-water marks, changed keys, keyed merge.

High-water marks are uncorrelated scalar subqueries (``DataFrame.scalar()``):
Spark runs the one-row aggregate once and feeds the value into the filter,
nothing is collected to the driver by our code and no join is planned.

``merge_upsert`` is MERGE INTO on plain DataFrames (no table format needed):

* matched (plain ``=`` on every key, so NULL keys never match):
  the listed columns come from the source, even when NULL; the rest stay;
* source only: the whole source row is inserted;
* target only: unchanged.

Both modes are one full outer join: source and target are each read once, and the
windows before it (source rows counted per key in ``error`` mode, target rows of a
key numbered in ``combine`` mode) need the join's own partitioning and order, so
neither side is shuffled a second time. A target stored in buckets by the key
(``sources.keyed_tables``) is not shuffled at all: the source alone moves to it.
Rows of a key stream through their task; none are gathered in memory.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_FALLBACK = "1900-01-01"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- marks

def high_water_mark(target: DataFrame, clock: Column | str, fallback: str | None = DEFAULT_FALLBACK) -> Column:
    """``COALESCE((SELECT MAX(clock) FROM target), fallback)`` as a column.

    ``fallback=None`` keeps the bare maximum: an empty target then gives NULL
    and no row passes a ``>`` test against it.
    """
    mark = target.select(F.max(_col(clock).cast("timestamp_ntz")).alias("hwm")).scalar()
    if fallback is None:
        return mark
    return F.coalesce(mark, F.lit(fallback).cast("timestamp_ntz"))


def above_mark(df: DataFrame, clock: Column | str, mark: Column) -> DataFrame:
    """Rows strictly newer than the mark (a row at the mark is never reloaded)."""
    return df.filter(_col(clock).cast("timestamp_ntz") > mark)


def above_any_mark(df: DataFrame, pairs: Sequence[tuple[Column | str, Column]]) -> DataFrame:
    """Rows newer than at least one of several independent marks (OR)."""
    cond = reduce(lambda a, b: a | b, [_col(c).cast("timestamp_ntz") > m for c, m in pairs])
    return df.filter(cond)


# ---------------------------------------------------------------- keys

def drop_keys(df: DataFrame, keys_df: DataFrame, keys: Sequence[str], null_safe: bool = True) -> DataFrame:
    """Rows of ``df`` whose key is not among ``keys_df`` (left anti join)."""
    k = keys_df.select(*[F.col(c).alias(f"_k_{c}") for c in keys])
    cond = reduce(lambda a, b: a & b, [
        (df[c].eqNullSafe(k[f"_k_{c}"]) if null_safe else df[c] == k[f"_k_{c}"]) for c in keys])
    return df.join(k, cond, "left_anti")


def replace_keys(target: DataFrame, rebuilt: DataFrame, keys_df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target without the rebuilt keys, plus the rebuilt rows (NULL-safe keys).

    Used by ``recompute`` runs: every key touched by a change is rebuilt from
    all of its source rows and replaces whatever the target held for it.
    """
    kept = drop_keys(target, keys_df, keys, null_safe=True)
    return kept.unionByName(rebuilt.select(*target.columns))


# ---------------------------------------------------------------- merge

class MergeError(ValueError):
    pass


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update_cols: Sequence[str],
    on_duplicate: str = "error",
    combine: Callable[[DataFrame], DataFrame] | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """MERGE ``source`` INTO ``target`` ON keys; see the module notes.

    ``on_duplicate``:
      * ``"error"``: a target row matched by more than one source row fails
        the job (the warehouse MERGE raises a non-deterministic-merge error);
      * ``"combine"``: ``combine(source)`` first reduces the source to one row
        per key, and target rows that share a matched key collapse into one
        updated row, so sums over the table count the key once. The order of
        their remaining columns decides whose remaining columns stay.

    ``buckets``: the number of buckets by ``keys`` that the target is stored in, if any;
    the source is dealt to as many, so that Spark has no reason to move the target.
    """
    keys, update_cols = list(keys), list(update_cols)
    cols = target.columns
    missing = [c for c in cols if c not in source.columns]
    if missing:
        raise MergeError(f"source lacks target columns {missing}")
    if on_duplicate == "combine":
        if combine is None:
            raise MergeError("on_duplicate='combine' needs a combine function")
        source = combine(source)
    elif on_duplicate != "error":
        raise MergeError(f"unknown on_duplicate={on_duplicate!r}")

    keep_one = on_duplicate == "combine"
    rest = [c for c in cols if c not in keys and c not in update_cols]
    t = target.select(*[F.col(c).alias(f"_t_{c}") for c in cols], F.lit(True).alias("_in_t"))
    s = source.select(*cols, F.lit(True).alias("_in_s"))
    if buckets:
        s = s.repartition(buckets, *keys)
    if keep_one:
        order = [F.col(f"_t_{c}").asc_nulls_last() for c in rest] or [F.lit(1)]
        t = t.withColumn("_rn", F.row_number().over(Window.partitionBy(*[f"_t_{k}" for k in keys]).orderBy(*order)))
    else:
        s = s.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(*keys)))
    both = t.join(s, reduce(lambda a, b: a & b, [t[f"_t_{k}"] == s[k] for k in keys]), "full_outer")
    in_t, in_s = F.col("_in_t").isNotNull(), F.col("_in_s").isNotNull()
    if keep_one:
        both = both.filter(~(in_t & in_s) | (F.col("_rn") == 1))
    else:
        stop = F.raise_error(F.lit("merge: a target row matches several source rows"))
        both = both.filter(F.when(in_t & in_s & (F.col("_n") > 1), stop).otherwise(F.lit(True)).cast("boolean"))
    upd = {c for c in update_cols if c not in keys}
    return both.select(*[
        (F.when(in_s, F.col(c)).otherwise(F.col(f"_t_{c}")) if c in upd
         else F.when(in_t, F.col(f"_t_{c}")).otherwise(F.col(c))).alias(c) for c in cols])

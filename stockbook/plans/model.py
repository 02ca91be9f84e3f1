"""Shared shape of the incremental silver models.

A model turns prepared source rows into its table. On top of that it knows
its merge key, the columns a merge may update, and how to find changed rows
against the current target (its high-water mark). From these three parts it
offers the three ways to load:

``full``
    build from every row (first load or full refresh); insert audit stamped.
``delta``
    the source system's incremental run: aggregate only rows above the mark
    and MERGE them on the key. A month re-delivered in part is overwritten by
    that part (reproduced on purpose).
``recompute``
    find the keys touched by rows above the mark and rebuild each of them from
    all of its rows, replacing the target's rows for those keys. Equals a full
    refresh when sources are append-only and clocks arrive in order.

``in_pieces`` deals prepared rows over that many tasks by ``dealt_by``, columns of both
version key and merge key: the rows move once, as narrow as they are delivered, and
versions and rollup are summed where they lie. Without it every sum is combined before
and after a shuffle of its own, wide in its partial sums: dearer, but a key that
holds most rows never meets in one task.
"""

from __future__ import annotations

import copy
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockbook.functions.audit import RunInfo, with_audit
from stockbook.operators.incremental import above_mark, merge_upsert, replace_keys
from stockbook.operators.versions import merge_version_states, newest_of_state, newest_version_sums, version_state

MODES = ("delta", "recompute")


class IncrementalModel:
    name: str = ""
    keys: Sequence[str] = ()
    update_cols: Sequence[str] = ()
    partition_col: str | None = None
    version_key: Sequence[str] = ()   # rows of one key replace each other ...
    clocks: Sequence[str] = ()        # ... by these clocks
    dealt_by: Sequence[str] = ()      # columns of both version_key and keys
    by_day: bool = False              # version_key holds days where keys hold their months
    rolls_up: bool = True             # False: a row a version key is a row of the table
    pieces: int | None = None

    # --- to implement -------------------------------------------------
    def rows(self, *inputs: DataFrame) -> DataFrame:
        """Prepared source rows (casts, joins)."""
        raise NotImplementedError

    def measures(self) -> dict[str, Column]:
        """What is summed over the rows of a newest version."""
        raise NotImplementedError

    def rollup(self, latest: DataFrame, per_key: bool = False) -> DataFrame:
        """The table (without audit) from the sums of the newest versions.

        ``per_key=True`` reduces to exactly one row per merge key, for models
        whose natural grain is finer than the key.
        """
        raise NotImplementedError

    def delivery_clock(self) -> Column:
        """The clock over prepared rows that tells a new row from one loaded before."""
        raise NotImplementedError

    def mark(self, target: DataFrame) -> Column:
        """The target's high-water mark, which a new row's ``delivery_clock`` lies above."""
        raise NotImplementedError

    def key_exprs(self) -> dict[str, Column]:
        """Merge-key columns expressed over prepared rows."""
        return {k: F.col(k) for k in self.keys}

    # --- provided -----------------------------------------------------
    def in_pieces(self, pieces: int | None, by: Sequence[str] = ()) -> IncrementalModel:
        """The model with its rows dealt into so many parts; choose it so that a part fits a task's memory.

        ``by``: columns of both keys other than ``dealt_by``.
        """
        model = copy.copy(self)
        model.pieces, model.dealt_by = pieces, by or self.dealt_by
        return model

    def changed(self, rows: DataFrame, target: DataFrame) -> DataFrame:
        """Rows above the target's high-water mark."""
        return above_mark(rows, self.delivery_clock(), self.mark(target))

    def dealt(self, rows: DataFrame) -> DataFrame:
        return rows.repartition(self.pieces, *self.dealt_by) if self.pieces else rows

    def dealt_by_date(self, rows: DataFrame, date: str) -> DataFrame:
        """By ranges of ``date``, then ``dealt_by``: all rows of one date, product and country in one task."""
        return rows.repartitionByRange(*([self.pieces] if self.pieces else []), date, *self.dealt_by)

    def aggregate(self, rows: DataFrame, per_key: bool = False) -> DataFrame:
        """The table (without audit) from prepared rows."""
        return self.rollup(newest_version_sums(self.dealt(rows), self.version_key, self.clocks, self.measures()), per_key)

    def state(self, rows: DataFrame) -> DataFrame:
        """The rows' state (``operators.versions.version_state``); ``sources.version_state`` keeps it."""
        if self.pieces:  # a part holds few months, so the state is written by month where it lies
            rows = self.dealt_by_date(rows, self.partition_col)
        return version_state(rows, self.version_key, self.clocks, self.measures(), self.delivery_clock())

    def merge_states(self, states: DataFrame, placed_by: str | None = None) -> DataFrame:
        """``placed_by``: the rows are dealt by that column of the key's date (``dealt_by_date``)."""
        key = list(self.version_key) + [c for c in [placed_by] if c and c not in self.version_key]
        return merge_version_states(states, key, self.clocks, list(self.measures()), placed_by is not None)

    def table_of_state(self, state: DataFrame) -> DataFrame:
        """``aggregate`` of the rows behind ``state`` (one row a version key)."""
        return self.rollup(newest_of_state(state, self.version_key, self.clocks, list(self.measures())))

    def full(self, *inputs: DataFrame, run: RunInfo = RunInfo()) -> DataFrame:
        return with_audit(self.aggregate(self.rows(*inputs)), run, first_load=True)

    def incremental(self, *inputs: DataFrame, target: DataFrame, run: RunInfo = RunInfo(),
                    mode: str = "recompute", on_duplicate: str = "error", buckets: int | None = None) -> DataFrame:
        """The whole new target after one incremental run (lazy); ``buckets`` as in ``merge_upsert``."""
        if mode not in MODES:
            raise ValueError(f"mode must be one of {MODES}")
        rows = self.rows(*inputs)
        if mode == "recompute" and self.pieces and len(self.clocks) == 1:
            return self._recompute_in_pieces(rows, target, run)
        return self.incremental_from(rows, self.changed(rows, target), target=target, run=run, mode=mode,
                                     on_duplicate=on_duplicate, buckets=buckets)

    def incremental_from(self, rows: DataFrame, changed: DataFrame, target: DataFrame, run: RunInfo = RunInfo(),
                         mode: str = "recompute", on_duplicate: str = "error", buckets: int | None = None) -> DataFrame:
        """As ``incremental`` with the changed rows given (e.g. a stream's new files)."""
        if mode not in MODES:
            raise ValueError(f"mode must be one of {MODES}")
        if mode == "delta":
            per_key = on_duplicate == "combine"
            src = with_audit(self.aggregate(changed, per_key=per_key), run, first_load=False)
            return merge_upsert(target, src, self.keys, self.update_cols,
                                on_duplicate=on_duplicate, combine=(lambda s: s) if per_key else None, buckets=buckets)
        return self._recompute(rows, changed, target, run)

    def touched_partitions(self, *inputs: DataFrame, target: DataFrame) -> DataFrame:
        """Distinct values of ``partition_col`` holding a key changed by this run."""
        if self.partition_col is None:
            raise ValueError(f"{self.name} is not partitioned")
        rows = self.rows(*inputs)
        expr = self.key_exprs()[self.partition_col]
        return self.changed(rows, target).select(expr.alias(self.partition_col)).distinct()

    def _recompute(self, rows: DataFrame, changed: DataFrame, target: DataFrame, run: RunInfo) -> DataFrame:
        exprs = self.key_exprs()
        tmp = {k: f"_mk_{k}" for k in exprs}
        keyed = rows.select("*", *[e.alias(tmp[k]) for k, e in exprs.items()])
        touched = changed.select(*[e.alias(k) for k, e in exprs.items()]).distinct()
        probe = touched.select(*[F.col(k).alias(f"_t_{k}") for k in exprs])
        cond = reduce(lambda a, b: a & b, [keyed[tmp[k]].eqNullSafe(probe[f"_t_{k}"]) for k in exprs])
        affected = keyed.join(probe, cond, "left_semi").drop(*tmp.values())
        rebuilt = with_audit(self.aggregate(affected), run, first_load=True)
        return replace_keys(target, rebuilt, touched, list(exprs))

    def _recompute_in_pieces(self, rows: DataFrame, target: DataFrame, run: RunInfo) -> DataFrame:
        """``_recompute`` where the dealt rows lie: they move once, a target stored in the same parts not at all.

        For one clock: a touched key holds a row with a clock, so its rebuilt rows tell that it
        was touched. With two clocks the newest ones may never have met in a row.
        """
        is_new = F.coalesce(self.delivery_clock().cast("timestamp_ntz") > self.mark(target), F.lit(False))
        touched = F.max(is_new).over(Window.partitionBy(*self.key_exprs().values()))
        affected = self.dealt(rows).withColumn("_touched", touched).filter("_touched").drop("_touched")
        latest = newest_version_sums(affected, self.version_key, self.clocks, self.measures())
        rebuilt = with_audit(self.rollup(latest), run, first_load=True).select(*target.columns)
        both = target.withColumn("_rebuilt", F.lit(False)).unionByName(rebuilt.withColumn("_rebuilt", F.lit(True)))
        replaced = F.max("_rebuilt").over(Window.partitionBy(*self.keys))
        return both.withColumn("_replaced", replaced).filter("_rebuilt or not _replaced").select(*target.columns)

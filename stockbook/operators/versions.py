"""Keep the newest delivered version of a key.

``newest_row``
    One row per key, the one with the latest clock (``ROW_NUMBER() ... = 1``).
    A window with ``rn = 1`` lets Catalyst insert a partial
    ``WindowGroupLimit`` before the shuffle, so only the top row per key and
    map task is shuffled.

``newest_version_sums``
    Sums over all rows of the newest version (ties kept): the pattern
    ``MAX(clock) OVER (PARTITION BY key)`` then ``clock = max_clock`` then
    ``SUM``, with one or several independent clocks, as two aggregations over
    one scan. A window would send every row of a key to one task.

``version_state`` / ``merge_version_states`` / ``newest_of_state``
    The same in steps, for a state that later deliveries are merged into: one
    row per key that a row of a later delivery can be added to without the
    earlier rows.

``newest_version_rows``
    The rows themselves, for callers that need them: the maxima per key come
    from an aggregation and the rows are kept by a left semi join, so the
    input is read twice.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockbook.functions.exact import limb_sums, limb_total, on_grid, split_units

# Three sums a measure: beyond this many measures the generated aggregation
# outgrows what the JIT compiles, and plain decimal sums are faster (same totals).
_LIMBS_UP_TO = 8


def newest_row(df: DataFrame, key: Sequence[str], clock: str, tie_break: Sequence[str] = ()) -> DataFrame:
    """One row per ``key`` with the latest ``clock``; NULL clocks rank first.

    ``ORDER BY clock DESC`` in the source dialect puts NULLs first, so a key
    whose only dated version competes with an undated one keeps the undated
    one. ``tie_break`` columns make equal clocks resolve the same way on
    every run.
    """
    order = [F.col(clock).desc_nulls_first()] + [F.col(c).asc_nulls_first() for c in tie_break]
    w = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def newest_version_sums(df: DataFrame, key: Sequence[str], clocks: Sequence[str], sums: dict[str, Column]) -> DataFrame:
    """Sums over the rows of the newest version per ``key``: key, clocks, sums.

    The values are taken as DOUBLE, the sums are exact ones on the grid of
    ``functions.exact``, whatever the order of the rows.

    One pass over the input. Rows are first summed per key and clocks (a hot
    key costs a row per clock value and map task), then the lexicographically
    largest clocks of each key are picked and kept if every clock is at its
    own maximum. NULL keys group together; rows with a NULL clock never
    qualify, but their other clocks count in the maxima.
    """
    key, clocks, names = list(key), list(clocks), list(sums)
    best, at_max = _newest_parts(_version_parts(df, key, clocks, sums), key, clocks, names)
    return best.filter(at_max).select(*key, *clocks, *names)


def _version_parts(df: DataFrame, key: list[str], clocks: list[str], sums: dict[str, Column],
                   others: Sequence[Column] = ()) -> DataFrame:
    """Sums per key and clocks; ``others`` are further aggregates of the same groups."""
    if len(clocks) > 2:
        raise ValueError("one or two clocks")
    names = list(sums)
    doubles = df.select(*key, *clocks, *[c.cast("double").alias(f"_x_{n}") for n, c in sums.items()],
                        *[c for c in df.columns if others and c == SEEN])
    extra = [SEEN, ROWS] if others else []
    if len(names) <= _LIMBS_UP_TO:
        split = doubles.select("*", *[split_units(F.col(f"_x_{n}")).alias(f"_u_{n}") for n in names])
        parts = split.groupBy(*key, *clocks).agg(
            *[c for n in names for c in limb_sums(n, f"_x_{n}", f"_u_{n}")], *others)
        return parts.select(*key, *clocks, *[limb_total(n).alias(n) for n in names], *extra)
    return doubles.groupBy(*key, *clocks).agg(*[F.sum(on_grid(f"_x_{n}")).alias(n) for n in names], *others)


def _newest_parts(parts: DataFrame, key: list[str], clocks: list[str], names: list[str],
                  others: Sequence[Column] = ()) -> tuple[DataFrame, Column]:
    """Per key the part with the lexicographically largest clocks, and whether each of them is a maximum."""
    order = F.col(clocks[0]) if len(clocks) == 1 else (_order(clocks[0]) * F.lit(10**18).cast("decimal(19,0)") * 10).cast("decimal(38,0)") + _order(clocks[1])
    # fixed-width buffers only, so the picks stay hash aggregations
    best = parts.withColumn("_order", order).groupBy(*key).agg(
        *[F.max(c).alias(f"_max_{c}") for c in clocks], *[F.max_by(c, "_order").alias(c) for c in [*clocks, *names]], *others)
    return best, reduce(lambda a, b: a & b, [F.col(c) == F.col(f"_max_{c}") for c in clocks])


# ---------------------------------------------------------------- state

# Columns of a state beside key, clocks and sums: the latest delivery clock seen
# (microseconds) and the number of rows in the sums.
SEEN, ROWS = "_seen", "_rows"


def version_state(df: DataFrame, key: Sequence[str], clocks: Sequence[str], sums: dict[str, Column],
                  delivered: Column) -> DataFrame:
    """One row per ``key`` that holds all a later delivery can change: key, clocks, sums, SEEN, ROWS.

    The clocks are each at their maximum over the key's rows; the sums cover
    the ROWS rows that have all of these clocks (none: 0 rows, NULL sums, as
    where the newest header and the newest line never met). Two states of
    disjoint rows merge by the larger maxima: rows at a clock that was passed
    can never count again, and rows at the maxima of both lie in the sums of
    those states that have reached them. Keys whose rows have no clock at all
    are left out. SEEN is the maximum of ``delivered``, the clock that decides
    whether a row is new.
    """
    key, clocks, names = list(key), list(clocks), list(sums)
    parts = _version_parts(df.withColumn(SEEN, _micros(delivered)), key, clocks, sums,
                           [F.max(SEEN).alias(SEEN), F.count(F.lit(1)).alias(ROWS)])
    return _at_maxima(parts, key, clocks, names)


def merge_version_states(states: DataFrame, key: Sequence[str], clocks: Sequence[str], names: Sequence[str],
                         placed: bool = False) -> DataFrame:
    """The state of all rows behind the rows of several states (any order, any grouping: the same).

    A key has a row a state, so the one shuffle by key serves both aggregations;
    ``placed``: the rows already lie so that no key is in two tasks.
    """
    key, clocks, names = list(key), list(clocks), list(names)
    parts = (states if placed else states.repartition(*key)).groupBy(*key, *clocks).agg(
        *[F.sum(n).alias(n) for n in names], F.max(SEEN).alias(SEEN), F.sum(ROWS).alias(ROWS))
    return _at_maxima(parts, key, clocks, names)


def _at_maxima(parts: DataFrame, key: list[str], clocks: list[str], names: list[str]) -> DataFrame:
    best, at_max = _newest_parts(parts, key, clocks, [*names, ROWS], [F.max(SEEN).alias(f"_max{SEEN}")])
    whole = F.coalesce(at_max, F.lit(False))
    some_clock = reduce(lambda a, b: a | b, [F.col(f"_max_{c}").isNotNull() for c in clocks])
    return best.filter(some_clock).select(
        *key, *[F.col(f"_max_{c}").alias(c) for c in clocks], *[F.when(whole, F.col(n)).alias(n) for n in names],
        F.col(f"_max{SEEN}").alias(SEEN), F.when(whole, F.col(ROWS)).otherwise(F.lit(0)).cast("long").alias(ROWS))


def newest_of_state(state: DataFrame, key: Sequence[str], clocks: Sequence[str], names: Sequence[str]) -> DataFrame:
    """What ``newest_version_sums`` gives for the rows behind ``state``."""
    return state.filter(F.col(ROWS) > 0).select(*key, *clocks, *names)


def _order(clock: str) -> Column:
    """A timestamp as a positive number of at most 19 digits, NULL as 0."""
    return F.coalesce(_micros(F.col(clock)).cast("decimal(38,0)") + F.lit(10**18).cast("decimal(19,0)"), F.lit(0).cast("decimal(38,0)")).cast("decimal(19,0)")


def _micros(clock: Column) -> Column:
    """A zone-less timestamp as microseconds from 1970 on."""
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), clock.cast("timestamp_ntz"))


def newest_version_rows(df: DataFrame, key: Sequence[str], clocks: Sequence[str],
                        never_null: Sequence[str] = ()) -> DataFrame:
    """Rows of the newest version per ``key``: every clock at its maximum.

    NULL keys group together (as in a window partition); a row with a NULL
    clock never qualifies, but its other clocks still count in the maxima.
    Key columns listed in ``never_null`` (e.g. the key of an inner join just
    before) are compared with plain ``=``; that keeps the join on the same
    columns as the input's partitioning, so it can be reused without a shuffle.
    """
    key, clocks = list(key), list(clocks)
    maxima = (df.groupBy(*key).agg(*[F.max(c).alias(f"_max_{c}") for c in clocks])
              .select(*[F.col(k).alias(f"_key_{k}") for k in key], *[f"_max_{c}" for c in clocks]))
    cond = [(df[k] == maxima[f"_key_{k}"]) if k in never_null else df[k].eqNullSafe(maxima[f"_key_{k}"])
            for k in key]
    cond += [df[c] == maxima[f"_max_{c}"] for c in clocks]
    return df.join(maxima, reduce(lambda a, b: a & b, cond), "left_semi")

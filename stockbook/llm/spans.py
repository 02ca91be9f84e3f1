"""Spans of pattern matches as Spark expressions, in time near linear in text and matches.

Positions are code points, end exclusive. Arrays are never appended to in a fold
(each step would copy what is there): running values are taken in two levels, over
blocks of about the square root of the length.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value`` taken once: an expression named in a lambda would be taken for each element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running(values: Column, zero: Column, merge: Callable[[Column, Column], Column]) -> Column:
    """For each element the merge of all before it (``zero`` for the first); ``merge`` is associative."""
    def blocks(v: Column) -> Column:
        width = F.greatest(F.ceil(F.sqrt(F.size(v).cast("double"))).cast("int"), F.lit(16))
        starts = F.sequence(F.lit(0), F.floor((F.greatest(F.size(v), F.lit(1)) - 1) / width).cast("int"))
        return F.transform(starts, lambda b: F.slice(v, b * width + 1, width))

    def total(part: Column) -> Column:
        return F.aggregate(part, zero, merge)

    def walk(parts: Column) -> Column:
        def block(totals: Column) -> Column:
            def inside(part: Column, b: Column) -> Column:
                return let(total(F.slice(totals, 1, b)), lambda base: F.transform(
                    part, lambda x, i: merge(base, total(F.slice(part, 1, i)))))
            return F.flatten(F.transform(parts, inside))
        return let(F.transform(parts, total), block)

    return let(values, lambda v: let(blocks(v), walk))


def hits(text: Column, pattern: str, group: int = 0, left: int = 0, right: int = 0, given: Column | None = None) -> Column:
    """Leftmost, non-overlapping matches: array<struct<start, end, hit, value, left, right>>.

    ``value`` is the group's text; ``left`` and ``right`` are up to so many characters
    beside the match, not beyond the neighbouring matches. ``given`` is a cheap test that
    every text with a match passes.
    """
    kind = "array<struct<start:int,end:int,hit:string,value:string,left:string,right:string>>"

    def found(pieces: Column) -> Column:
        steps = F.transform(pieces, lambda p: F.length(p["gap"]) + F.coalesce(F.length(p["hit"]), F.lit(0)))
        beside = F.transform(pieces, lambda p: F.substring(p["gap"], 1, right) if right else F.lit(""))

        def rows(starts: Column, beside: Column) -> Column:
            def row(p: Column, i: Column) -> Column:
                at = F.get(starts, i) + F.length(p["gap"])
                return F.struct(
                    at.alias("start"), (at + F.length(p["hit"])).alias("end"), p["hit"].alias("hit"), p["value"].alias("value"),
                    (F.substring(p["gap"], -left, left) if left else F.lit("")).alias("left"),
                    F.get(beside, i + 1).alias("right"))
            return F.filter(F.transform(pieces, row), lambda r: r["hit"].isNotNull())

        return let(beside, lambda b: let(running(steps, F.lit(0), lambda x, y: x + y), lambda s: rows(s, b)))

    columns = [F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hit")]
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else columns[1]
    pieces = F.arrays_zip(*columns, value.alias("value"))
    some = text.rlike(pattern) if given is None else given & text.rlike(pattern)
    return F.when(some, let(pieces, found)).otherwise(F.array()).cast(kind)


def meeting(items: Column, wanted: Callable[[Column], Column], tag: str, far: int = 1 << 30) -> Column:
    """For items sorted by start: tags of the ``wanted`` items before and after each that overlap it.

    Of those before, the one that reaches farthest; of those after, the one that starts
    first. array<struct<before, after>> with -1 for none, in the items' order.
    """
    none = F.lit(-1)
    ends = F.transform(items, lambda s: F.when(wanted(s), F.struct(s["end"].alias("at"), s[tag].alias("tag"))).otherwise(
        F.struct(none.alias("at"), none.alias("tag"))))
    starts = F.transform(F.reverse(items), lambda s: F.when(wanted(s), F.struct(s["start"].alias("at"), s[tag].alias("tag"))).otherwise(
        F.struct(F.lit(far).alias("at"), none.alias("tag"))))
    before = running(ends, F.struct(none.alias("at"), none.alias("tag")), lambda a, b: F.greatest(a, b))
    after = running(starts, F.struct(F.lit(far).alias("at"), none.alias("tag")), lambda a, b: F.least(a, b))
    pairs = F.arrays_zip(items.alias("item"), before.alias("b"), F.reverse(after).alias("a"))
    return F.transform(pairs, lambda p: F.struct(
        F.when(p["b"]["at"] > p["item"]["start"], p["b"]["tag"]).otherwise(none).alias("before"),
        F.when(p["a"]["at"] < p["item"]["end"], p["a"]["tag"]).otherwise(none).alias("after")))

"""Mixing sources to target weights by temperature.

A source's weight is its token share to the power of an exponent, normalised.
The exponent is bisected to the flattest mixture whose most repeated source
stays within a repetition limit, or to the steepest that reaches a target
entropy. The weights are then realised on a token budget: whole passes over a
source, and for the rest a permutation of its documents, cut at the budget.

The permutation is the order of md5(doc_id). It is cut in two steps so that no
task sorts a whole source: leading hex digits make blocks (about the square
root of the documents each), running sums over the blocks' totals find the
block where the budget ends, and only that block's documents are ordered.

Each bisection pass is one aggregate over the sources that tests 31 exponents,
five halvings at once; nothing but its one row reaches the driver.

Defined cases: tokens are words; null text has none; a null source is a source;
sources without tokens have weight 0 and keep every document once; a null
doc_id counts as an empty string; rows with equal ids are in or out together;
other columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stockbook.llm.common import fresh, small, stored

PASSES = 6
INNER = 31


def n_words(text: Column) -> Column:
    """Words of a text, natively: pieces between blanks that are not empty."""
    return F.coalesce(F.size(F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")), F.lit(0)).cast("long")


def rank_key(doc_id: Column) -> Column:
    return F.md5(F.coalesce(doc_id.cast("string"), F.lit("")))


def bisect_exponent(shares: DataFrame, enough: Callable[[float, float, float, float], bool], from_above: bool) -> float:
    """Halve [0, 1] 30 times towards the exponent where ``enough`` changes.

    ``enough(a, z, e, r)`` judges exponent ``a`` from the sum of powers, the sum
    of powers times log share, and the largest power over its share.
    ``from_above``: the larger exponents are enough, else the smaller ones.
    """
    lo, hi = 0.0, 1.0
    for _ in range(PASSES):
        grid = [lo + (hi - lo) * (k + 1) / (INNER + 1) for k in range(INNER)]
        aggs = []
        for k, a in enumerate(grid):
            p = F.pow("share", F.lit(a))
            aggs += [F.sum(p).alias(f"z{k}"), F.sum(p * F.log("share")).alias(f"e{k}"), F.max(p / F.col("share")).alias(f"r{k}")]
        row = shares.agg(*aggs).first()
        ok = [enough(a, row[f"z{k}"], row[f"e{k}"], row[f"r{k}"]) for k, a in enumerate(grid)]
        k = next((k for k, x in enumerate(ok) if x == from_above), INNER)  # the first past the change
        lo, hi = (grid[k - 1] if k else lo), (grid[k] if k < INNER else hi)
    return hi if from_above else lo


def plan_mixture(docs: DataFrame, repeat_limit: float | None = 4.0, target_entropy: float | None = None,
                 budget: int | None = None, cover: bool = False) -> DataFrame:
    """One row a source: source, tokens, weight, passes, cutoff (the rank key up to which one more copy is drawn).

    ``budget``: tokens to draw, by default as many as there are. ``cover``:
    instead, the least budget that draws every document of every source.
    """
    counted = stored(docs.select(F.col("source").cast("string").alias("source"), rank_key(docs["doc_id"]).alias("rank"),
                                 n_words(docs["text"]).alias("n")))
    per = stored(counted.groupBy("source").agg(F.sum("n").alias("tokens"), F.count(F.lit(1)).alias("docs")))
    total, most = per.agg(F.sum("tokens"), F.max("tokens")).first()
    total = total or 1
    top = (most or 1) / total
    shares = stored(per.filter("tokens > 0").withColumn("share", F.col("tokens") / F.lit(total)))

    def drawn(a: float, z: float) -> float:
        return total * z * top ** (1 - a) if cover else float(budget or total)

    exponent = 1.0
    if most and target_entropy is not None:
        exponent = bisect_exponent(shares, lambda a, z, e, r: math.log(z) - a * e / z >= target_entropy, from_above=False)
    elif most and repeat_limit is not None:
        exponent = bisect_exponent(shares, lambda a, z, e, r: r / z * drawn(a, z) / total <= repeat_limit, from_above=True)
    z = shares.agg(F.sum(F.pow("share", F.lit(exponent)))).first()[0] or 1.0
    weight = F.round(F.pow("share", F.lit(exponent)) / F.lit(z), 9)
    wanted = F.floor(weight * F.lit(float(drawn(exponent, z))) + F.lit(0.5))
    if cover:
        wanted = F.greatest(wanted, F.col("tokens"))
    targets = per.join(shares.select(F.col("source").alias("s"), weight.alias("weight"), wanted.alias("wanted")),
                       F.col("source").eqNullSafe(F.col("s")), "left").select(
        "source", "tokens", "docs", F.coalesce("weight", F.lit(0.0)).alias("weight"), F.coalesce("wanted", F.lit(0)).alias("wanted"))
    targets = stored(targets.select(
        "source", "tokens", "docs", "weight",
        F.when(F.col("tokens") == 0, 1).otherwise(F.floor(F.col("wanted") / F.greatest("tokens", F.lit(1)))).cast("long").alias("passes"),
        F.when(F.col("tokens") == 0, 0).otherwise(F.col("wanted") % F.greatest("tokens", F.lit(1))).cast("long").alias("rest")))
    return _with_cutoffs(counted, targets)


def _with_cutoffs(counted: DataFrame, targets: DataFrame) -> DataFrame:
    digits = F.ceil(F.log2(F.greatest("docs", F.lit(1))) / 8).cast("int")
    wide = counted.join(small(targets.select(F.col("source").alias("s"), "rest", digits.alias("digits")).filter("rest > 0")),
                        F.col("source").eqNullSafe(F.col("s"))).select("source", "rest", "rank", "n", F.expr("substring(rank, 1, digits)").alias("block"))
    blocks = stored(wide.groupBy("source", "rest", "block").agg(F.sum("n").alias("n")))
    run = W.partitionBy("source").orderBy("block")
    summed = blocks.withColumn("upto", F.sum("n").over(run.rowsBetween(W.unboundedPreceding, 0)))
    ends = stored(summed.filter("upto >= rest").groupBy("source", "rest").agg(F.min(F.struct("block", (F.col("upto") - F.col("n")).alias("before"))).alias("b")).select(
        F.col("source").alias("s"), F.col("b.block").alias("end_block"), F.col("b.before").alias("before")))
    inside = wide.join(small(ends), F.col("source").eqNullSafe(F.col("s")) & (F.col("block") == F.col("end_block")))
    running = inside.withColumn("upto", F.col("before") + F.sum("n").over(W.partitionBy("source").orderBy("rank")))
    # whole blocks before the last one are in; of the last, the ranks whose running sum fits
    cut = running.groupBy("source", "end_block").agg(F.max(F.when(F.col("upto") <= F.col("rest"), F.col("rank"))).alias("rank")).select(
        F.col("source").alias("s"), F.coalesce("rank", "end_block").alias("cutoff"))
    return targets.join(cut, F.col("source").eqNullSafe(F.col("s")), "left").select(
        "source", "tokens", "weight", "passes", F.coalesce("cutoff", F.lit("")).alias("cutoff"))


def with_copies(docs: DataFrame, plan: DataFrame, name: str, weight: str | None = None) -> DataFrame:
    """``docs`` and how often each row is drawn, in column ``name``; no row or column is lost."""
    p = small(plan.select(F.col("source").alias("key"), "weight", "passes", "cutoff")).alias("p")
    copies = F.col("p.passes") + (rank_key(F.col("d.doc_id")) <= F.col("p.cutoff")).cast("long")
    return docs.alias("d").join(p, F.col("d.source").cast("string").eqNullSafe(F.col("p.key"))).select(
        *[F.col(f"d.`{c}`") for c in docs.columns], copies.alias(name), *([F.col("p.weight").alias(weight)] if weight else []))


def mix(docs: DataFrame, **how) -> DataFrame:
    """The mixture: every row of ``docs`` as often as it is drawn."""
    name = fresh(docs, "copies")
    drawn = with_copies(docs, stored(plan_mixture(docs, **how)), name)
    return drawn.withColumn(name, F.explode(F.when(F.col(name) > 0, F.sequence(F.lit(1).cast("long"), F.col(name))))).drop(name)


def mixing_report(docs: DataFrame, **how) -> DataFrame:
    """doc_id, source, n_tokens, weight, copies for every row of ``docs``."""
    made = with_copies(docs.select("doc_id", "source", "text"), stored(plan_mixture(docs, **how)), "copies", "weight")
    return made.select("doc_id", "source", n_words(F.col("text")).alias("n_tokens"), "weight", "copies")

"""Line deduplication over line-ID sequences, with Spark expressions only.

A document is the sequence of the IDs of its lines that hold a word. Prefix
doubling names the runs of 1, 2, 4, ... lines that start at each line: the name
of a run of 2n is made from the names of its two halves. Names are pairs of 64-bit
hashes of different seeds, so equal runs get equal names in all documents without a
global ranking between rounds. Any run's name is made from the two overlapping doubled runs
that cover it; the places of one name are the suffixes whose common prefix is
at least that long, an interval of the suffix array.

A line's size is its number of words, or a sixth of its characters where that is more
(scripts without spaces). A run of size ``min_size`` or more that also occurs
earlier (smaller doc_id, or same document, earlier line) is deleted; a single line of one
or two words and under 18 characters is left, as it may recur by chance, and goes only
with its neighbours. Every such run is covered by its *shortest* runs of that size,
those reaching forward from a line and those reaching back, each a repeat itself; as
every line has a word these have at most ``min_size`` lines. So one grouped minimum over the names of the
shortest runs finds all maximal repeated runs, and hot names combine map-side.

Defined cases: null and empty texts have no lines; lines without a word are
never deleted and part no run; the line break is ``\\n``; a null doc_id sorts
first; documents with equal ids are ordered by a hash of their text, and rows
with equal id and text share one result; other columns are carried along.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockbook.llm.common import BLANKS, fresh, null_id, stored

MIN_SIZE = 3
#: Characters that count as one word.
WORD_CHARS = 6
SEED = 77  # of the second hash of a line


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _words(line: Column) -> Column:
    return F.size(F.filter(F.split(line, r"[\x20\x09-\x0D]+"), lambda w: w != ""))


def _size(line: Column) -> Column:
    """Words, or a sixth of the characters if that is more; 0 without a word."""
    return F.greatest(_words(line), F.floor(F.length(F.translate(line, BLANKS, "")) / WORD_CHARS).cast("int"))


def sequences(docs: DataFrame) -> DataFrame:
    """id, h (hash of the text), lines: array<struct<no, id, id2, n>> of the lines with a word."""
    def of(line: Column, no: Column) -> Column:
        return F.struct(no.alias("no"), F.xxhash64(line).alias("id"), F.xxhash64(F.lit(SEED), line).alias("id2"), _size(line).alias("n"))
    return docs.select(null_id().alias("id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"),
                       F.filter(F.transform(_lines(F.col("text")), of), lambda x: x["n"] > 0).alias("lines")).filter(F.size("lines") > 0)


def _double(names: Column, half: int) -> Column:
    """Names of the runs of ``2 * half`` lines from those of ``half``; null where the document ends."""
    return _let(names, lambda a: F.transform(a, lambda x, i: F.when(
        x.isNotNull() & F.get(a, i + half).isNotNull(), F.xxhash64(x, F.get(a, i + half)))))


def _shortest(words: Column, i: Column, min_size: int, step: int) -> Column:
    """Lines from line ``i`` (forward 1, back -1) until ``min_size`` words are reached; null if never."""
    reach = F.when(F.lit(step > 0), F.slice(words, i + 1, F.lit(min_size))).otherwise(
        F.reverse(F.slice(words, F.greatest(i + 2 - min_size, F.lit(1)), F.least(i + 1, F.lit(min_size)))))
    walked = F.aggregate(reach, F.struct(F.lit(0).alias("sum"), F.lit(0).alias("k")), lambda a, n: F.when(
        a["sum"] >= min_size, a).otherwise(F.struct((a["sum"] + n).alias("sum"), (a["k"] + 1).alias("k"))))
    return F.when(walked["sum"] >= min_size, walked["k"])


def runs(seq: DataFrame, min_size: int) -> DataFrame:
    """The shortest runs: id, h, start, size (in lines with a word), name and name2."""
    levels = 0
    while 2 ** (levels + 1) <= min_size:
        levels += 1
    cols = seq.select("id", "h", F.transform("lines", lambda x: x["n"]).alias("words"),
                      F.transform("lines", lambda x: x["id"]).alias("n0"), F.transform("lines", lambda x: x["id2"]).alias("m0"))
    for k in range(levels):
        for c in "nm":
            cols = cols.withColumn(f"{c}{k + 1}", _double(F.col(f"{c}{k}"), 2**k))
    packed = cols.select("id", "h", F.struct("words", *[f"{c}{k}" for k in range(levels + 1) for c in "nm"]).alias("d"))

    def places(d: Column) -> Column:
        size = F.size(d["words"])
        def named(start: Column, n: Column) -> Column:
            names = []
            for c in "nm":
                name = F.lit(None).cast("long")
                for k in range(levels + 1):
                    name = F.when(n >= 2**k, F.xxhash64(F.get(d[f"{c}{k}"], start), F.get(d[f"{c}{k}"], start + n - 2**k), n)).otherwise(name)
                names.append(name)
            return F.struct(start.alias("start"), n.alias("size"), names[0].alias("name"), names[1].alias("name2"))
        def at(i: Column) -> Column:
            ahead = _let(_shortest(d["words"], i, min_size, 1), lambda n: F.when(n.isNotNull(), named(i, n)))
            back = _let(_shortest(d["words"], i, min_size, -1), lambda n: F.when(n.isNotNull(), named(i - n + 1, n)))
            return F.array(ahead, back)
        return F.array_distinct(F.filter(F.flatten(F.transform(F.sequence(F.lit(0), size - 1), at)), lambda x: x.isNotNull()))

    return packed.select("id", "h", F.explode(_let(F.col("d"), places)).alias("r")).select("id", "h", "r.start", "r.size", "r.name", "r.name2")


def repeated_lines(docs: DataFrame, min_size: int = MIN_SIZE) -> DataFrame:
    """id, h, cut: sorted distinct line numbers to delete, n_runs: maximal deleted runs; documents with any."""
    seq = stored(sequences(docs))
    found = stored(runs(seq, min_size).distinct())
    first = found.groupBy("name", "name2").agg(F.min(F.struct("id", "h", "start")).alias("first"), F.count(F.lit(1)).alias("places")).filter("places > 1")
    later = found.join(first.select("name", "name2", "first"), ["name", "name2"]).filter(F.struct("id", "h", "start") > F.col("first"))
    marked = later.groupBy("id", "h").agg(F.collect_set(F.struct("start", "size")).alias("found"))
    at = F.array_sort(F.array_distinct(F.flatten(F.transform("found", lambda r: F.sequence(r["start"], r["start"] + r["size"] - 1)))))
    joined = marked.select("id", "h", at.alias("at")).join(seq.dropDuplicates(["id", "h"]), ["id", "h"])
    n_runs = F.size(F.array_except("at", F.transform("at", lambda x: x + 1)))  # places not preceded by a deleted one
    return joined.select("id", "h", n_runs.alias("n_runs"),
                         _let(F.struct("lines", "at"), lambda d: F.transform(d["at"], lambda k: F.get(d["lines"], k)["no"])).alias("cut"))


def cut_lines(docs: DataFrame, names: tuple[str, str, str, str], min_size: int = MIN_SIZE) -> DataFrame:
    """``docs`` and four more columns: the kept text, lines before, lines cut, and the runs they form."""
    cuts = repeated_lines(docs, min_size).alias("c")
    on = (F.coalesce(F.col("d.doc_id"), F.lit(-(2**63))) == F.col("c.id")) & (F.xxhash64(F.coalesce("d.text", F.lit(""))) == F.col("c.h"))
    def keep(x: Column) -> Column:
        left = F.array_except(F.sequence(F.lit(0), F.size(x["lines"]) - 1), x["cut"])
        return F.array_join(F.transform(left, lambda i: F.get(x["lines"], i)), "\n")
    kept = _let(F.struct(_lines(F.col("d.text")).alias("lines"), F.col("c.cut").alias("cut")), keep)
    values = (F.when(F.col("c.cut").isNull(), F.col("d.text")).otherwise(kept), F.size(_lines(F.col("d.text"))).cast("long"),
              F.coalesce(F.size("c.cut"), F.lit(0)).cast("long"), F.coalesce("c.n_runs", F.lit(0)).cast("long"))
    return docs.alias("d").join(cuts, on, "left").select(
        *[F.col(f"d.`{c}`") for c in docs.columns], *[v.alias(n) for v, n in zip(values, names, strict=True)])


def line_report(docs: DataFrame, min_size: int = MIN_SIZE) -> DataFrame:
    """doc_id, n_lines, n_removed, n_runs, kept_sha256 for every row of ``docs``."""
    made = cut_lines(docs.select("doc_id", "text"), ("kept", "n_lines", "n_removed", "n_runs"), min_size)
    return made.select("doc_id", "n_lines", "n_removed", "n_runs", F.sha2(F.coalesce("kept", F.lit("")), 256).alias("kept_sha256"))


def drop_repeated_lines(docs: DataFrame, min_size: int = MIN_SIZE) -> DataFrame:
    """``docs`` without the later copies; documents that were nothing else go, ``n_chars`` follows the text."""
    names = tuple(fresh(docs, x) for x in ("kept", "lines", "cut", "runs"))
    made = cut_lines(docs, names, min_size).filter((F.col(names[2]) == 0) | F.col(names[0]).rlike(r"[^\x20\x09-\x0D]"))
    new = {"text": F.col(names[0])} | ({"n_chars": F.when(F.col(names[2]) == 0, F.col("n_chars")).otherwise(
        F.length(names[0])).cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {})
    return made.select(*[(new[c].alias(c) if c in new else F.col(f"`{c}`")) for c in docs.columns])

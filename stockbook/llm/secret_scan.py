"""Secret scans with Spark expressions only.

Base spans come from three patterns. The method adds spans of kind
``entropy``: over candidate strings (long runs of key characters holding a
digit and a letter) a window slides whose Shannon entropy is kept by counts: the
accumulator holds the count of each character, five bits each, and the entering and
the leaving character change one count and one term each of ``sum(c * log2(c))``.
Runs of windows above the threshold of the candidate's character class become
spans, unless an allow-list pattern covers the candidate or the span meets a base
span. Long candidates are folded in stretches of ``STRETCH`` windows, whose runs are
joined at the borders, so that time is linear in their length.

Positions are code points, end exclusive. Defined cases: null and empty text
have no spans; each row is scanned by itself, so repeated rows, ties and other
columns change nothing; long texts are scanned whole.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockbook.llm.spans import hits, let, meeting

KINDS = ("assign", "access", "hex", "entropy")
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"  # maximal runs, so the same as + and a length test
HEX = r"[0-9a-f]{32,}"
WINDOW = 20
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
#: Bits a character that a window needs, by character class.
THRESHOLDS = {"hex": 3.0, "base64": 3.7}
#: Candidates that look random but are public: UUIDs, digits with separators, alphabets, named samples.
ALLOW = (
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    r"^[0-9_/=+-]+$",
    r"(?i)abcdefghijklmnop|0123456789|example|sample|placeholder|test_?key",
    # possessive: no stack frame a repetition
    r"^/?(?:[A-Za-z]++[0-9]{0,4}+[-_/=+]++){2,}+[A-Za-z]*+[0-9]{0,4}+$",
)

_SPANS = "array<struct<start:int,kind:int,end:int>>"


def _none() -> Column:
    return F.array().cast(_SPANS)


def _span(kind: int, start: Column, end: Column) -> Column:
    return F.struct(start.cast("int").alias("start"), F.lit(kind).alias("kind"), end.cast("int").alias("end"))


#: The characters of candidates; a character's place is that of its count.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
STRETCH = 512
_BITS, _EACH = 5, 12  # counts of up to 31 in five bits, twelve to a long
_UNIT = 1 << 40  # terms are whole multiples of 2^-40, so sums do not drift


def entropy_runs(candidate: Column, threshold: Column, window: int = WINDOW) -> Column:
    """Maximal stretches of ``candidate`` whose windows all reach ``threshold``: array<struct<start, end>>.

    ``window`` is 31 at most.
    """
    terms = F.array(*[F.lit(round(n * math.log2(n) * _UNIT) if n else 0) for n in range(window + 2)])
    highest = F.floor((F.lit(math.log2(window)) - threshold) * window * _UNIT)
    empty = F.array().cast("array<struct<start:int,end:int>>")

    def one(place: Column) -> Column:
        return F.call_function("shiftleft", F.lit(1).cast("long"), (place % _EACH * _BITS).cast("int"))

    def folded(part: Column, base: Column, limit: Column) -> Column:
        """Runs of high windows of one stretch of places, as window numbers from ``base`` on."""
        def step(acc: Column, enter: Column) -> Column:
            i = acc["i"]
            full = i >= window
            leave = F.when(full, F.get(part, i - window)).otherwise(F.lit(-1))

            def count(place: Column) -> Column:
                word = F.get(acc["counts"], (place / _EACH).cast("int"))
                return F.call_function("shiftright", word, (place % _EACH * _BITS).cast("int")).bitwiseAND(F.lit((1 << _BITS) - 1).cast("long")).cast("int")

            def next_step(c: Column) -> Column:
                s = acc["s"] + F.get(terms, c["enter"] + 1) - F.get(terms, c["enter"])
                s = F.when(full, s + F.get(terms, c["leave"] - 1) - F.get(terms, c["leave"])).otherwise(s)

                def decide(s: Column) -> Column:
                    at = base + i - (window - 1)
                    high = (i >= window - 1) & (s <= limit)
                    counts = F.transform(acc["counts"], lambda w, j: w
                                         + F.when(j == (enter / _EACH).cast("int"), one(enter)).otherwise(F.lit(0).cast("long"))
                                         - F.when(full & (j == (leave / _EACH).cast("int")), one(leave)).otherwise(F.lit(0).cast("long")))
                    done = F.when(~high & (acc["open"] >= 0), F.array_append(
                        acc["done"], F.struct(acc["open"].alias("start"), at.alias("end")))).otherwise(acc["done"])
                    return F.struct((i + 1).alias("i"), counts.alias("counts"), s.alias("s"), F.when(high, F.when(
                        acc["open"] < 0, at).otherwise(acc["open"])).otherwise(F.lit(-1)).alias("open"), done.alias("done"))
                return let(s, decide)

            entering = count(enter)
            leaving = F.when(full, count(leave) + (leave == enter).cast("int")).otherwise(F.lit(1))
            return let(F.struct(entering.alias("enter"), leaving.alias("leave")), next_step)

        zero = F.struct(F.lit(0).alias("i"), F.array(*[F.lit(0).cast("long") for _ in range(-(-len(ALPHABET) // _EACH))]).alias("counts"),
                        F.lit(0).cast("long").alias("s"), F.lit(-1).alias("open"), empty.alias("done"))
        return F.aggregate(part, zero, step, lambda acc: F.when(acc["open"] >= 0, F.array_append(
            acc["done"], F.struct(acc["open"].alias("start"), (base + acc["i"] - (window - 1)).alias("end")))).otherwise(acc["done"]))

    def run(places: Column, limit: Column) -> Column:
        blocks = F.sequence(F.lit(0), F.greatest(F.floor((F.size(places) - window) / STRETCH), F.lit(0)).cast("int"))
        parts = F.transform(blocks, lambda b: let(
            F.slice(places, b * STRETCH + 1, STRETCH + window - 1), lambda part: folded(part, b * STRETCH, limit)))

        def joined(runs: Column) -> Column:
            # a run that ends where the next one starts goes on over a border
            starts, ends = F.transform(runs, lambda r: r["start"]), F.transform(runs, lambda r: r["end"])
            pairs = F.arrays_zip(F.array_except(starts, ends).alias("s"), F.array_except(ends, starts).alias("e"))
            return F.transform(pairs, lambda p: F.struct(p["s"].alias("start"), (p["e"] + (window - 1)).alias("end")))
        return let(F.flatten(parts), joined)

    places = F.transform(F.split(candidate, ""), lambda c: F.call_function("instr", F.lit(ALPHABET), c) - 1)
    return F.when(F.length(candidate) < window, empty).otherwise(
        let(highest, lambda limit: let(places, lambda p: run(p, limit))))


def _entropy_spans(text: Column) -> Column:
    def of(hit: Column) -> Column:
        word = hit["hit"]
        wanted = word.rlike("[0-9]") & word.rlike("[A-Za-z]")
        for pattern in ALLOW:
            wanted = wanted & ~word.rlike(pattern)
        limit = F.when(word.rlike("^[0-9a-fA-F]+$"), THRESHOLDS["hex"]).otherwise(THRESHOLDS["base64"])
        return F.when(wanted, F.transform(entropy_runs(word, limit), lambda r: _span(
            3, hit["start"] + r["start"], hit["start"] + r["end"]))).otherwise(_none())
    return F.flatten(F.transform(hits(text, CANDIDATE), of))


def _apart(base: Column, added: Column) -> Column:
    """The added spans that meet no base span."""
    def kept(items: Column) -> Column:
        pairs = F.arrays_zip(items.alias("s"), meeting(items, lambda s: s["kind"] < 3, "kind").alias("m"))
        return F.transform(F.filter(pairs, lambda p: (p["s"]["kind"] == 3) & (p["m"]["before"] < 0) & (p["m"]["after"] < 0)), lambda p: p["s"])
    return F.when((F.size(base) == 0) | (F.size(added) == 0), added).otherwise(let(F.sort_array(F.concat(base, added)), kept))


def scan_secrets(docs: DataFrame) -> DataFrame:
    """doc_id, base and added: arrays of (start, kind, end) sorted by start, kind an index into KINDS."""
    text = F.coalesce(F.col("text"), F.lit(""))
    assign = F.transform(F.filter(hits(text, ASSIGN, 2), lambda h: F.length(h["value"]) >= 8), lambda h: _span(0, h["start"], h["end"]))
    access = F.transform(hits(text, ACCESS), lambda h: _span(1, h["start"], h["end"]))
    hexes = F.transform(hits(text, HEX), lambda h: _span(2, h["start"], h["end"]))
    both = F.struct(F.sort_array(F.concat(assign, access, hexes)).alias("base"), _entropy_spans(text).alias("added"))
    return docs.select("doc_id", let(both, lambda x: F.struct(
        x["base"].alias("base"), _apart(x["base"], x["added"]).cast(_SPANS).alias("added"))).alias("found")).select("doc_id", "found.*")


def span_text(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def secret_digest(found: DataFrame) -> DataFrame:
    def n(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select("doc_id", n(0).alias("n_assign"), n(1).alias("n_access"), n(2).alias("n_hex"),
                        F.sha2(span_text(F.col("base")), 256).alias("base_sha256"),
                        span_text(F.sort_array(F.concat("base", "added"))).alias("spans"))

"""Personal data with Spark expressions only: candidates, boosted trees, calibrated thresholds.

Base spans come from four patterns with their checks. The method adds spans where
those fail, for they take the leftmost match and never retry: a card number after
another number, a phone number before an address, an obfuscated e-mail address.

* Generators of high recall propose spans, which may overlap each other.
* Every candidate gets format features (digits, separators, check digit, parts) and
  context features (neighbouring characters, words before it).
* Weak labels: matches of the base patterns by whether their checks pass; candidates
  of another kind over a base span, bare digits as a phone number and an
  @ without a dotted name after it are negative; all others have no label.
* Trees of two levels are boosted on the logistic loss. A split needs the sums of
  gradients by (node, feature, value): one grouped sum over the distinct feature
  patterns of all labelled candidates, of which a few hundred rows reach the
  driver. Gradients are whole multiples of 2^-20, so trees do not depend on the order of rows.
* A quarter of the candidates, told by a hash of their text, is held out: isotonic
  regression of the labels on the score gives the smallest score from which precision reaches
  ``PRECISION``, by kind. Unlabelled candidates above it are selected, unless they
  meet a base span or lie in a selected longer one.

Positions are code points, end exclusive. Defined cases: null and empty texts have no
spans; each row is scanned by itself (repeated rows count in training as often); ties
go to the longer, then the likelier span; without labelled candidates, as in an
empty table, nothing is added; texts are scanned whole; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockbook.llm.common import stored, stored_table
from stockbook.llm.spans import hits, let, meeting, running

KINDS = ("email", "ip", "card", "phone")
# Possessive forms of the contract's patterns: the same matches, without a stack frame a repetition,
# and without trying each start inside a run of the first class.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
BASE = (EMAIL, IP, CARD, PHONE)
IP_PARTS = r"^0*+(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})?(?:\.0*+(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})?){3}$"

#: Generators: what may be personal data by its shape, wherever it stands.
PROPOSE = (
    r"(?i)(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+\x20?(?:@|\(at\)|\[at\]|\{at\})\x20?[A-Za-z0-9-]{1,63}+"
    r"(?:(?:\.|\x20?(?:\(dot\)|\[dot\]|\{dot\})\x20?)[A-Za-z0-9-]{1,63}+){0,8}",
    r"(?<![0-9])[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}(?![0-9])",
    r"(?<![0-9])(?:[0-9]{4}([\x20-])[0-9]{4}\1[0-9]{4}\1[0-9]{4}|[0-9]{12,19})(?![0-9])",
    r"(?=[0-9+(])(?<![0-9+])\+?(?:[0-9]{1,3}[\x20.-]?)?(?:\([0-9]{2,4}\)|[0-9]{2,4})[\x20.-]?[0-9]{3,4}[\x20.-]?[0-9]{3,4}(?![0-9])",
)
#: Words before a candidate that speak for a kind, and such that speak against all.
SPEAKS_FOR = (r"(?i)mail|contact|write", r"(?i)\bip\b|host|server|addr", r"(?i)card|visa|credit|amex", r"(?i)phone|tel|call|mobile|fax")
SPEAKS_AGAINST = r"(?i)version|isbn|order|invoice|serial|\bid\b|\bsku\b"
LEFT, RIGHT = 32, 2

# What a text with a match of a pattern holds, told faster than by the pattern.
_AT, _DOTTED, _NUMBER = r"(?i)@|[(\[{]at[)\]}]", r"[0-9]\.[0-9]", r"[0-9]{2}"


def _given(text: Column, kind: int, base: bool) -> Column:
    if kind == 0:
        return text.contains("@") if base else text.rlike(_AT)
    if kind == 3 and base:
        return text.contains("+")
    return text.rlike(_DOTTED if kind == 1 else _NUMBER if kind == 3 else "[0-9]")


FEATURES = ("kind", "digits", "separators", "checked", "parts", "distinct", "plus", "parens", "dots", "letters",
            "before", "after", "word", "against", "left_digits")
ROUNDS, RATE, RIDGE = 12, 0.5, 1.0
UNIT = float(1 << 20)
BINS = 50
PRECISION = 0.95

_SPANS = "array<struct<start:int,kind:int,end:int>>"
_CANDIDATES = "array<struct<start:int,kind:int,end:int,label:int,held:boolean,f:array<int>>>"


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]++", "")


def _n(text: Column, pattern: str, most: int) -> Column:
    """How many characters of ``text`` the class ``pattern`` holds, ``most`` at most."""
    return F.least(F.length(F.regexp_replace(text, f"[^{pattern}]++", "")), F.lit(most))


def passes(kind: int, hit: Column) -> Column:
    """Does a match of the base pattern pass the check of its kind?"""
    if kind == 0:
        return F.lit(True)
    if kind == 1:
        return hit.rlike(IP_PARTS)
    n = F.length(_digits(hit))
    if kind == 3:
        return (n >= 9) & (n <= 15)
    return F.when((n >= 12) & (n <= 19), F.call_function("luhn_check", _digits(hit))).otherwise(False)


def _side(c: Column) -> Column:
    """Class of a neighbouring character: none, blank, letter, digit, punctuation, other."""
    return (F.when(c == "", 0).when(c.rlike(r"^\s"), 1).when(c.rlike(r"^\p{L}"), 2).when(c.rlike("^[0-9]"), 3)
            .when(c.rlike(r"^\p{Punct}"), 4).otherwise(5))


def features(kind: int, h: Column) -> Column:
    """The small integers that the trees see, in the order of FEATURES."""
    hit, left, right = h["hit"], h["left"], h["right"]
    n = F.length(_digits(hit))
    word = F.lit(0)
    for k, pattern in enumerate(SPEAKS_FOR):
        word = F.when(left.rlike(pattern), 2 if k == kind else 1).otherwise(word)
    values = (
        F.lit(kind), F.least(n, F.lit(20)), _n(hit, r"\x20-", 8),
        F.when((n >= 12) & (n <= 19), F.call_function("luhn_check", _digits(hit)).cast("int")).otherwise(0),
        F.when(hit.rlike(IP_PARTS), 1).when(hit.rlike(r"^[0-9]++(?:\.[0-9]++){3}$"), 2).otherwise(0),
        F.size(F.array_distinct(F.split(F.substring(_digits(hit), 1, 20), ""))), _n(hit, "+", 2), _n(hit, "()", 4), _n(hit, ".", 6),
        _n(hit, "A-Za-z", 20), _side(F.substring(left, -1, 1)), _side(right), word, left.rlike(SPEAKS_AGAINST).cast("int"),
        _n(F.substring(left, -8, 8), "0-9", 8))
    return F.array(*[v.cast("int") for v in values])


def _candidate(kind: int, h: Column, label: Column) -> Column:
    held = F.pmod(F.xxhash64(h["hit"], F.lit(12)), F.lit(4)) == 3
    return F.struct(h["start"].alias("start"), F.lit(kind).alias("kind"), h["end"].alias("end"), label.cast("int").alias("label"),
                    held.alias("held"), features(kind, h).alias("f"))


def _shape(kind: int, h: Column) -> Column:
    """Label that a proposed candidate has by its shape alone: 0, or -1 for none."""
    if kind == 0:
        return F.when(h["hit"].contains("@") & ~h["hit"].contains(".") & ~h["hit"].contains("dot"), 0).otherwise(-1)
    if kind == 3:
        return F.when(h["hit"].rlike("^[0-9]++$"), 0).otherwise(-1)
    return F.lit(-1)


def _proposed(base: Column, proposed: Column) -> Column:
    """Proposals that meet no base span of their own kind; those that meet another's are negative."""
    tagged = F.concat(
        F.transform(base, lambda s: F.struct(s["start"].alias("start"), F.lit(0).alias("own"), s["end"].alias("end"), s["kind"].alias("kind"),
                                             F.lit(-1).alias("label"), F.lit(False).alias("held"), F.array().cast("array<int>").alias("f"))),
        F.transform(proposed, lambda c: F.struct(c["start"], F.lit(1).alias("own"), c["end"], c["kind"], c["label"], c["held"], c["f"])))

    def judged(items: Column) -> Column:
        pairs = F.arrays_zip(items.alias("c"), meeting(items, lambda s: s["own"] == 0, "kind").alias("m"))

        def label(p: Column) -> Column:
            c, m = p["c"], p["m"]
            same = (m["before"] == c["kind"]) | (m["after"] == c["kind"])
            other = (m["before"] >= 0) | (m["after"] >= 0)
            return F.struct(c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end"),
                            F.when(same, -2).when(other, 0).otherwise(c["label"]).alias("label"), c["held"].alias("held"), c["f"].alias("f"))
        return F.filter(F.transform(F.filter(pairs, lambda p: p["c"]["own"] == 1), label), lambda c: c["label"] > -2)
    return let(F.sort_array(tagged), judged)


def find_candidates(docs: DataFrame) -> DataFrame:
    """doc_id, base (start, kind, end) and candidates with label (1, 0, -1 none) and features."""
    text = F.coalesce(F.col("text"), F.lit(""))
    def matched(k: int) -> Column:
        return F.transform(hits(text, BASE[k], 0, LEFT, RIGHT, _given(text, k, True)), lambda h: _candidate(k, h, passes(k, h["hit"]).cast("int")))

    def suggested(k: int) -> Column:
        return F.transform(hits(text, PROPOSE[k], 0, LEFT, RIGHT, _given(text, k, False)), lambda h: _candidate(k, h, _shape(k, h)))

    labelled, proposed = (F.concat(*[of(k) for k in range(len(KINDS))]) for of in (matched, suggested))

    def found(both: Column) -> Column:
        base = F.transform(F.filter(both["labelled"], lambda c: c["label"] == 1), lambda c: F.struct(c["start"], c["kind"], c["end"]))
        return let(base, lambda b: F.struct(
            F.sort_array(b).cast(_SPANS).alias("base"),
            F.concat(both["labelled"], _proposed(b, both["proposed"])).cast(_CANDIDATES).alias("candidates")))

    both = F.struct(labelled.cast(_CANDIDATES).alias("labelled"), proposed.cast(_CANDIDATES).alias("proposed"))
    return docs.select("doc_id", let(both, found).alias("found")).select("doc_id", "found.base", "found.candidates")


# ------------------------------------------------------------ boosting


@dataclass
class Split:
    """``f[feature] <= value`` goes left; a leaf has only ``weight``."""

    weight: float = 0.0
    feature: int = -1
    value: int = 0
    left: Split | None = None
    right: Split | None = None

    def score(self, f: Column) -> Column:
        if self.left is None or self.right is None:
            return F.lit(self.weight)
        return F.when(F.get(f, F.lit(self.feature)) <= self.value, self.left.score(f)).otherwise(self.right.score(f))

    def leaves(self) -> list[Split]:
        return [self] if self.left is None or self.right is None else [*self.left.leaves(), *self.right.leaves()]

    def number(self, f: Column, of: dict[int, int]) -> Column:
        """The number of the leaf that a pattern falls into."""
        if self.left is None or self.right is None:
            return F.lit(of[id(self)])
        return F.when(F.get(f, F.lit(self.feature)) <= self.value, self.left.number(f, of)).otherwise(self.right.number(f, of))


@dataclass
class Model:
    start: float
    trees: list[Split]
    least: dict[int, float]  # smallest score selected, by kind

    def score(self, f: Column) -> Column:
        margin = F.lit(self.start)
        for t in self.trees:
            margin = margin + t.score(f)
        return 1 / (1 + F.exp(-margin))

    def selects(self, kind: Column, p: Column) -> Column:
        out = F.lit(False)
        for k, least in self.least.items():
            out = out | ((kind == k) & (p >= least))
        return out


def _weight(g: float, h: float) -> float:
    return RATE * g / (h + RIDGE)


def _best_splits(sums: dict[tuple[int, int], dict[int, tuple[float, float]]], leaves: list[Split]) -> bool:
    """Split each leaf where it gains most; did any?"""
    any_split = False
    for k, leaf in enumerate(leaves):
        best = (1e-6, -1, 0, 0.0, 0.0, 0.0, 0.0)
        for f in range(len(FEATURES)):
            by = sums.get((k, f), {})
            g_all, h_all = sum(g for g, _ in by.values()), sum(h for _, h in by.values())
            g = h = 0.0
            for v in sorted(by)[:-1]:
                g, h = g + by[v][0], h + by[v][1]
                gain = g * g / (h + RIDGE) + (g_all - g) ** 2 / (h_all - h + RIDGE) - g_all**2 / (h_all + RIDGE)
                if gain > best[0] + 1e-9:
                    best = (gain, f, v, g, h, g_all - g, h_all - h)
        if best[1] >= 0:
            any_split = True
            leaf.feature, leaf.value = best[1], best[2]
            leaf.left, leaf.right = Split(_weight(best[3], best[4])), Split(_weight(best[5], best[6]))
    return any_split


def fit_trees(patterns: DataFrame, rounds: int = ROUNDS) -> Model:
    """Boosted trees on the training patterns (f, held, pos, neg), thresholds from the held-out ones."""
    import math

    train = patterns.filter("not held")
    pos, neg = (float(x or 0) for x in train.agg(F.sum("pos"), F.sum("neg")).first())
    model = Model(math.log((pos + 1) / (neg + 1)), [], {})
    for _ in range(rounds if pos and neg else 0):
        p = model.score(F.col("f"))
        graded = train.select("f", "pos", "neg", F.floor(p * UNIT).cast("long").alias("p"))
        whole = int(UNIT)
        g = F.col("pos") * (whole - F.col("p")) - F.col("neg") * F.col("p")
        h = (F.col("pos") + F.col("neg")) * F.floor(F.col("p") * (whole - F.col("p")) / UNIT).cast("long")
        tree = Split()
        for _level in range(2):
            leaves = tree.leaves()
            node = tree.number(F.col("f"), {id(x): k for k, x in enumerate(leaves)})
            rows = graded.select(node.alias("node"), g.alias("g"), h.alias("h"), F.posexplode("f").alias("feature", "value")).groupBy(
                "node", "feature", "value").agg(F.sum("g").alias("g"), F.sum("h").alias("h")).collect()
            sums: dict = {}
            for r in rows:
                sums.setdefault((r.node, r.feature), {})[r.value] = (r.g / UNIT, r.h / UNIT)
            if not _best_splits(sums, leaves):
                break
        if tree.left is None:
            break
        model.trees.append(tree)
    bins = patterns.select(F.get("f", F.lit(0)).alias("kind"), "held", "pos", "neg", F.least(
        F.floor(model.score(F.col("f")) * BINS).cast("int"), F.lit(BINS - 1)).alias("bin")).groupBy(
        "kind", "bin", "held").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")).collect()
    for kind in range(len(KINDS)):
        held = [r for r in bins if r.kind == kind and r.held]
        if sum(r.pos for r in held) < 20:  # too few to hold out: all of the kind
            held = [r for r in bins if r.kind == kind]
        least = threshold([(b, sum(r.pos for r in held if r.bin == b), sum(r.neg for r in held if r.bin == b)) for b in sorted({r.bin for r in held})])
        if least is not None:
            model.least[kind] = least / BINS
    return model


def threshold(bins: list[tuple[int, int, int]], precision: float = PRECISION) -> int | None:
    """Smallest bin whose isotonic precision reaches ``precision``; bins are (number, positive, negative), ascending."""
    pooled: list[list[float]] = []  # first bin, positives, all
    for b, pos, neg in bins:
        pooled.append([b, pos, pos + neg])
        while len(pooled) > 1 and pooled[-2][1] * pooled[-1][2] >= pooled[-1][1] * pooled[-2][2]:
            last = pooled.pop()
            pooled[-1][1] += last[1]
            pooled[-1][2] += last[2]
    return next((int(b) for b, pos, n in pooled if pos >= precision * n and pos > 0), None)


def feature_patterns(found: DataFrame) -> DataFrame:
    """f, held, pos, neg: distinct feature patterns of the labelled candidates."""
    rows = found.select(F.explode(F.filter("candidates", lambda c: c["label"] >= 0)).alias("c"))
    return rows.groupBy("c.f", "c.held").agg(F.sum("c.label").alias("pos"), F.sum(1 - F.col("c.label")).alias("neg"))


def select_spans(found: DataFrame, model: Model) -> DataFrame:
    """doc_id, base, added: arrays of (start, kind, end) sorted by start."""
    def scored(c: Column) -> Column:
        return F.struct(c["start"].alias("start"), (-c["end"]).alias("low"), (-model.score(c["f"])).alias("p"), c["kind"].alias("kind"))

    def outer(items: Column) -> Column:
        reach = running(F.transform(items, lambda c: -c["low"]), F.lit(-1), lambda a, b: F.greatest(a, b))
        pairs = F.arrays_zip(items.alias("c"), reach.alias("r"))
        return F.transform(F.filter(pairs, lambda x: x["r"] < -x["c"]["low"]), lambda x: F.struct(
            x["c"]["start"].alias("start"), x["c"]["kind"].alias("kind"), (-x["c"]["low"]).alias("end")))

    free = F.transform(F.filter("candidates", lambda c: c["label"] == -1), scored)
    chosen = F.filter(free, lambda c: model.selects(c["kind"], -c["p"]))
    return found.select("doc_id", "base", F.sort_array(let(F.sort_array(chosen), outer)).cast(_SPANS).alias("added"))


def scan_pii(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, base and added spans: (start, kind, end), kind an index into KINDS."""
    found = stored_table(find_candidates(docs))
    return select_spans(found, fit_trees(stored(feature_patterns(found)), rounds))


def span_text(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def pii_digest(found: DataFrame) -> DataFrame:
    def n(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{KINDS[kind]}")
    return found.select("doc_id", *[n(k) for k in range(len(KINDS))], F.sha2(span_text(F.col("base")), 256).alias("base_sha256"),
                        span_text(F.sort_array(F.concat("base", "added"))).alias("spans"))


def redacted(text: Column, spans: Column) -> Column:
    """``text`` with each span replaced by its kind in brackets; of overlapping spans the first."""
    def cut(both: Column) -> Column:
        chars, items = both["chars"], both["items"]
        reach = running(F.transform(items, lambda s: s["end"]), F.lit(0), lambda a, b: F.greatest(a, b))
        names = F.array(*[F.lit(f"[{k}]") for k in KINDS])
        pairs = F.arrays_zip(items.alias("s"), reach.alias("r"))
        parts = F.transform(pairs, lambda p: F.concat(
            F.array_join(F.slice(chars, p["r"] + 1, F.greatest(p["s"]["start"] - p["r"], F.lit(0))), ""),
            F.when(p["s"]["start"] >= p["r"], F.get(names, p["s"]["kind"])).otherwise("")))
        end = F.coalesce(F.array_max(F.transform(items, lambda s: s["end"])), F.lit(0))
        return F.concat(F.array_join(parts, ""), F.array_join(F.slice(chars, end + 1, F.size(chars)), ""))
    return F.when(F.size(spans) == 0, text).otherwise(
        let(F.struct(F.split(text, "").alias("chars"), F.sort_array(spans).alias("items")), cut))

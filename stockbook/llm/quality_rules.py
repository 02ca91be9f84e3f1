"""Quality rules by weak supervision.

Each rule votes good (1), bad (-1) or abstains (0) on a document. The true
quality is hidden; expectation-maximisation estimates, for every rule, how
often its vote is right on good and on bad documents, from nothing but the
counts of vote patterns. There are at most ``3 ** len(RULES)`` patterns, so
what reaches the driver is bounded by the number of rules, not by the data.
A document's posterior probability of being good then decides, in place of a
filter that every rule must pass.

Defined cases: null text counts as no words; rows are judged one by one, so
repeated rows get equal verdicts; other columns are not looked at; an empty
table leaves the estimates at their priors.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockbook.llm.common import BLANKS, fresh, small_batches, stored

SYMBOLS = "[#*$%&|<>]"
TRIM = ".,;:!?\"'()[]-"
FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
            "n_lines", "n_letters", "n_upper", "n_plain_words", "n_bangs", "top_word")
_SCHEMA = "struct<" + ",".join(f"{c}:bigint" for c in FEATURES) + ">"


def repeat_words(words: list[bytes]) -> int:
    """Words inside 3-word windows that the text holds twice or more."""
    if len(words) < 4:
        return 0
    ids: dict[bytes, int] = {}
    code = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
    pair = code[:-1] * len(ids) + code[1:]
    _, pair = np.unique(pair, return_inverse=True)
    _, where, counts = np.unique(pair[:-1] * len(ids) + code[2:], return_inverse=True, return_counts=True)
    at = np.flatnonzero(counts[where] > 1)
    hit = np.zeros(len(words), bool)
    for k in range(3):
        hit[at + k] = True
    return int(hit.sum())


def features_of(text: str | None) -> tuple[int, ...]:
    text = text or ""
    words = text.encode("utf-8", "surrogatepass").split()
    counts = Counter(words)
    lines = [x for x in text.split("\n") if x.strip(BLANKS)]
    plain = sum(n for w, n in counts.items() if w.decode("utf-8", "replace").strip(TRIM).isalpha())
    letters = upper = 0
    for ch, n in Counter(text).items():
        if ch.isalpha():
            letters += n
            upper += n * ch.isupper()
    return (len(words), len(text) - sum(map(text.count, BLANKS)), sum(map(text.count, SYMBOLS[1:-1])),
            len(lines) - len(set(lines)), repeat_words(words), len(lines), letters, upper, plain,
            text.count("!"), max(counts.values(), default=0))


def features(text: Column) -> Column:
    @F.pandas_udf(_SCHEMA)
    def run(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([features_of(t) for t in texts], columns=list(FEATURES), dtype="int64")

    return run(text)


def _vote(good: Column, bad: Column, has: Column) -> Column:
    return F.when(~has, 0).when(bad, -1).when(good, 1).otherwise(0)


def votes(f: Column) -> list[Column]:
    """One vote a rule; thresholds leave a middle ground where the rule abstains."""
    x = {c: f[c] for c in FEATURES}
    words, lines, letters = x["n_words"], x["n_lines"], x["n_letters"]
    has = words > 0
    return [
        _vote(words >= 50, words < 50, F.lit(True)),
        _vote(x["word_chars"].between(words * 3, words * 10), (x["word_chars"] < words * 2) | (x["word_chars"] > words * 14), has),
        _vote(x["n_symbols"] * 50 <= words, x["n_symbols"] * 5 > words, has),
        _vote(x["n_dup_lines"] * 20 <= lines, x["n_dup_lines"] * 3 > lines, lines >= 4),
        _vote(x["n_repeat_words"] * 5 <= words, x["n_repeat_words"] * 2 > words, has),
        _vote(x["n_upper"] * 8 <= letters, x["n_upper"] * 3 > letters, letters >= 20),
        _vote(x["n_plain_words"] * 10 >= words * 9, x["n_plain_words"] * 4 < words * 3, has),
        _vote(x["n_bangs"] * 50 <= words, x["n_bangs"] * 5 > words, has),
        _vote(x["top_word"] * 6 <= words, x["top_word"] * 4 > words, words >= 20),
    ]


N_RULES = 9


def fit(patterns: list[tuple[tuple[int, ...], int]], rounds: int = 200, tol: float = 1e-9) -> tuple[float, np.ndarray]:
    """EM over vote patterns with their counts.

    Returns the log odds of good before any vote, and for each rule the log
    odds that a vote of (bad, abstain, good) adds. Beta priors keep a rule's
    estimate inside (0, 1) and tie "good" to documents that the rules accept.
    """
    n_rules = len(patterns[0][0]) if patterns else N_RULES
    v = np.array([p for p, _ in patterns], dtype=np.int64).reshape(-1, n_rules)
    n = np.array([c for _, c in patterns], dtype=float)
    prior, right_good, right_bad = 0.8, np.full(n_rules, 0.95), np.full(n_rules, 0.4)

    def weights() -> tuple[float, np.ndarray]:
        w = np.zeros((n_rules, 3))
        w[:, 2] = np.log(right_good / (1 - right_bad))
        w[:, 0] = np.log((1 - right_good) / right_bad)
        return math.log(prior / (1 - prior)), w

    for _ in range(rounds if len(v) else 0):
        base, w = weights()
        odds = base + w[np.arange(n_rules), v + 1].sum(axis=1)
        good = 1 / (1 + np.exp(-np.clip(odds, -500, 500)))
        a, b = n * good, n * (1 - good)
        old = np.concatenate([[prior], right_good, right_bad])
        prior = (a.sum() + 8) / (n.sum() + 10)
        right_good = (a @ (v == 1) + 19) / (a @ (v != 0) + 20)
        right_bad = (b @ (v == -1) + 4) / (b @ (v != 0) + 10)
        # a vote of "good" never speaks against a document, nor "bad" for it
        right_bad = np.maximum(right_bad, 1 - right_good)
        if np.abs(np.concatenate([[prior], right_good, right_bad]) - old).max() < tol:
            break
    return weights()


def fit_rules(scored: DataFrame, vote_columns: list[str]) -> tuple[float, np.ndarray]:
    counted = scored.groupBy(*vote_columns).count().collect()  # at most 3 ** rules rows
    return fit(sorted((tuple(r[:-1]), r[-1]) for r in counted))


def posterior(vote_columns: list[Column], model: tuple[float, np.ndarray]) -> Column:
    base, w = model
    odds = F.lit(float(base))
    for col, (bad, mid, good) in zip(vote_columns, w.tolist(), strict=True):
        odds = odds + F.when(col == -1, bad).when(col == 1, good).otherwise(mid)
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-odds))


def _base_failed(f: Column) -> Column:
    return (f["n_words"] < 50) | (f["n_repeat_words"] * 100 > f["n_words"] * 50)


def score_quality(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """doc_id, the base counts, base_failed, kept, the posterior and every vote."""
    f = F.col("f")
    counted = stored(small_batches(docs).select("doc_id", features(F.col("text")).alias("f")))
    names = [f"vote_{i}" for i in range(N_RULES)]
    scored = counted.select("doc_id", "f", *[c.alias(n) for c, n in zip(votes(f), names, strict=True)])
    p = posterior([F.col(n) for n in names], fit_rules(scored, names))
    return scored.select(
        "doc_id", *[f[c].alias(c) for c in FEATURES[:5]], _base_failed(f).alias("base_failed"),
        (~_base_failed(f) & (p >= threshold)).alias("kept"), p.alias("p_good"), *names)


def filter_quality(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that pass, all columns kept.

    The first scan gathers the pattern counts, the second applies the
    verdicts in place: nothing is joined, so ids may repeat or be null.
    """
    names = [f"vote_{i}" for i in range(N_RULES)]
    f = F.col("f")
    model = fit_rules(small_batches(docs).select(features(F.col("text")).alias("f")).select(
        *[c.alias(n) for c, n in zip(votes(f), names, strict=True)]), names)
    name = fresh(docs, "features")
    g = F.col(name)
    p = posterior(votes(g), model)
    return docs.withColumn(name, features(docs["text"])).filter(~_base_failed(g) & (p >= threshold)).drop(name)

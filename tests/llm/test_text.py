"""Quality rules, chat formatting, secrets and language ID."""

import hashlib
import math
import random
import re
import time
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from conftest import SF_MID
from helpers import docs_of, prose, words
from stockbook.llm import chat_format, language_id, quality_rules, secret_scan


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


# ------------------------------------------------------------ quality


def _base(text):
    text = text or ""
    w = words(text)
    tri = Counter(zip(w, w[1:], w[2:], strict=False))
    hit = {k + j for k, x in enumerate(zip(w, w[1:], w[2:], strict=False)) if tri[x] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if words(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit)


def test_base_counts_match_brute_force(spark):
    rng = random.Random(2)
    rows = [(k, "\n".join(prose(rng, rng.randrange(9), rng.choice([3, 300])) for _ in range(rng.randrange(20)))) for k in range(80)]
    rows += [(200, None), (201, ""), (202, "a b \x1f c\x85d"), (203, "a b c a b c"), (204, "a a a a"), (205, "é# 💡|x " * 60), (205, "é# 💡|x " * 60)]
    got = quality_rules.score_quality(docs_of(spark, rows).selectExpr("*", "1 AS f", "2 AS vote_0")).collect()
    assert len(got) == len(rows)
    for r in got:
        want = _base(dict(rows)[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r.base_failed and r.kept) and 0 <= r.p_good <= 1


def test_rules_tell_the_labelled_documents_apart(spark):
    docs, labels = (spark.read.parquet(f"{SF_MID}/{t}.parquet") for t in ("documents", "labels"))
    got = quality_rules.score_quality(docs).join(labels, "doc_id").filter("not base_failed")
    wrong = got.filter((F.col("quality") == 1) != F.col("kept")).count()
    assert wrong <= 0.01 * got.count()
    kept = {r.doc_id for r in quality_rules.score_quality(docs).filter("kept").select("doc_id").collect()}
    stage = quality_rules.filter_quality(docs)
    assert stage.columns == docs.columns
    assert {r.doc_id for r in stage.select("doc_id").collect()} == kept


def test_em_matches_a_plain_version_and_empty_input(spark):
    patterns = [((1, 1, 0), 60), ((-1, 1, 1), 5), ((-1, -1, 0), 20), ((1, -1, -1), 3)]
    base, w = quality_rules.fit(patterns, rounds=3, tol=0)
    prior, good, bad = 0.8, [0.95] * 3, [0.4] * 3
    for _ in range(3):
        post = []
        for v, _n in patterns:
            a, b = prior, 1 - prior
            for x, g, d in zip(v, good, bad, strict=True):
                a *= {1: g, -1: 1 - g, 0: 1}[x]
                b *= {1: 1 - d, -1: d, 0: 1}[x]
            post.append(a / (a + b))
        n = [c for _, c in patterns]
        prior = (sum(c * p for c, p in zip(n, post, strict=True)) + 8) / (sum(n) + 10)
        for j in range(3):
            voted = [(c * p, c * (1 - p), v[j]) for (v, c), p in zip(patterns, post, strict=True) if v[j]]
            good[j] = (sum(a for a, _, x in voted if x == 1) + 19) / (sum(a for a, _, _ in voted) + 20)
            bad[j] = max((sum(b for _, b, x in voted if x == -1) + 4) / (sum(b for _, b, _ in voted) + 10), 1 - good[j])
    assert math.isclose(base, math.log(prior / (1 - prior)))
    assert np.allclose(w[:, 2], np.log(np.array(good) / (1 - np.array(bad))))
    assert quality_rules.score_quality(docs_of(spark, [])).count() == 0
    assert quality_rules.filter_quality(docs_of(spark, [])).count() == 0


# ------------------------------------------------------------ chats


def test_chats_round_trip_with_control_strings(spark):
    rng = random.Random(7)
    bits = ["<|start|>", "<|end|>\n", "<|turn|>", "\\s", "\\l", "\\", "<", "|", "\n", "", "assistant", "é💡", "\\### Assistant: </turn> ok", "<|"]
    rows = [(c, rng.choice([None, t, t, t]), rng.choice(["user", "assistant", "assistant", None, "a\nb", "<|end|>"]),
             rng.choice([None, *["".join(rng.choices(bits, k=rng.randrange(5))) for _ in range(6)]])) for c in [*range(40), None] for t in range(rng.randrange(1, 7))]
    rows += [(-1, k, "assistant", f"t{k}") for k in range(3000)]  # one long run
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS turns", "2 AS segments")
    formatted = chat_format.format_chats(df)
    got = {r.conv_id: r for r in chat_format.chat_digest(formatted).collect()}
    back = {r.conv_id: r for r in formatted.withColumn("blocks", chat_format.parse_chat(F.col("formatted"))).collect()}
    for c in {r[0] for r in rows}:
        own = sorted(((t is not None, t or 0, r or "", x or "") for cc, t, r, x in rows if cc == c))
        loss = "".join(x for *_, r, x in own if r == "assistant")
        assert got[c].n_turns == len(own) and got[c].turns_sha256 == sha("".join(f"{r}\n{x}\n" for *_, r, x in own))
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(loss), sha(loss))
        assert got[c].formatted_chars == len(back[c].formatted) and "".join(s.text for s in back[c].segments) == back[c].formatted
        assert all(a.role != b.role for a, b in zip(back[c].blocks, back[c].blocks[1:], strict=False))
    assert chat_format.chat_digest(chat_format.format_chats(df.limit(0))).count() == 0


# ------------------------------------------------------------ secrets

ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def _spans(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 32]
    found.sort()
    base = list(found)
    for m in re.finditer(secret_scan.CANDIDATE, text):
        c = m[0]
        if not (re.search("[0-9]", c) and re.search("[A-Za-z]", c)) or any(re.search(p, c) for p in secret_scan.ALLOW):
            continue
        limit = secret_scan.THRESHOLDS["hex" if re.fullmatch("[0-9a-fA-F]+", c) else "base64"]
        high = []
        for k in range(len(c) - 19):
            n = Counter(c[k:k + 20]).values()
            high.append(-sum(x / 20 * math.log2(x / 20) for x in n) >= limit - 1e-9)
        k = 0
        while k < len(high):
            if high[k]:
                e = k
                while e + 1 < len(high) and high[e + 1]:
                    e += 1
                s = (m.start() + k, 3, m.start() + e + 20)
                if not any(b[0] < s[2] and s[0] < b[2] for b in base):
                    found.append(s)
                k = e
            k += 1
    text_of = lambda x: ",".join(f"{secret_scan.KINDS[k]}:{a}:{b}" for a, k, b in x)
    return sha(text_of(base)), text_of(sorted(found)), [sum(s[1] == k for s in base) for k in range(3)]


def test_secrets_match_brute_force(spark):
    rng = random.Random(11)
    b64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    key = lambda n, a=b64: "".join(rng.choices(a, k=n))
    rows = [(k, " ".join([prose(rng, 5), key(rng.randrange(18, 90)), rng.choice(["API_KEY = '", "token:", "Secret=", "PassWord  ="]) + key(rng.randrange(5, 20)),
                          "💡é", key(40, "0123456789abcdef"), "AKIA" + key(rng.randrange(9, 20), "ABCDEFGH234567")])) for k in range(40)]
    rows += [(100, None), (101, ""), (102, "token=token=abcdefgh token=api_key: abcdefgh123"), (103, "f" * 31 + " " + "f" * 33),
             (104, "123e4567-e89b-12d3-a456-426614174000 https://a.b/some/long/path/to/page1"), (105, "a1" * 4000), (106, "AKIA" * 9 + "a"),
             (107, "x1" + key(3000)), (108, "TOKEN='" + "a" * 8)]
    got = secret_scan.secret_digest(secret_scan.scan_secrets(docs_of(spark, rows).selectExpr("*", "1 AS base", "2 AS added"))).collect()
    assert len(got) == len(rows)
    for r in got:
        base, spans, n = _spans(dict(rows)[r.doc_id])
        assert (r.base_sha256, r.spans, [r.n_assign, r.n_access, r.n_hex]) == (base, spans, n), r.doc_id
    assert secret_scan.scan_secrets(docs_of(spark, [])).count() == 0
    assert any("entropy" in r.spans for r in got)


def test_allow_list_keeps_its_verdicts_in_possessive_form():
    rng = random.Random(3)
    greedy = re.compile(r"^/?([A-Za-z]+[0-9]{0,4}[-_/=+]+){2,}[A-Za-z]*[0-9]{0,4}$")
    for _ in range(200_000):
        word = "".join(rng.choices(["a", "Zb", "1", "22", "-", "/", "_+", "12345"], k=rng.randrange(1, 9)))
        assert bool(greedy.search(word)) == bool(re.search(secret_scan.ALLOW[3], word)), word


def test_secrets_in_very_long_texts_and_strings(spark):
    rng = random.Random(12)
    n = 1_000_000
    key = "".join(rng.choices(secret_scan.ALPHABET, k=20_000))
    rows = [(k, t) for k, t in enumerate([
        "a1-" * (n // 3) + "b", "/" + "ab/" * (n // 3), "-" * n, "a" * n, "1" * n, "a1" * (n // 2), " " * n, "f" * n, "AKIA" * (n // 4), "secret" * (n // 6),
        "token" + " " * n + "=", "token=" * (n // 6), "A1+/_=-z" * (n // 8), "x1" + key, " ".join(key[k:k + 24] for k in range(20_000 - 24)),
        "token: abcdefgh " * (n // 16), "".join(rng.choices(secret_scan.ALPHABET, k=n))])]
    start = time.time()
    found = {r.doc_id: r for r in secret_scan.secret_digest(secret_scan.scan_secrets(docs_of(spark, rows))).collect()}
    assert time.time() - start < 180
    assert found[13].spans == _spans("x1" + key)[1]
    assert found[14].spans == _spans(rows[14][1])[1]
    assert found[7].n_hex == 1 and found[8].n_access == 1 and found[15].n_assign == n // 16 and found[0].spans == ""


# ------------------------------------------------------------ languages


def test_forward_sums_all_segmentations():
    pieces = language_id.Pieces(language_id.vocabulary_path())
    rng = np.random.default_rng(1)
    probs = rng.random((pieces.size, 2))
    probs /= probs.sum(axis=0)

    def piece(s):
        h = np.zeros(1, np.uint64)
        for c in language_id._codes([s])[0]:
            h = language_id._grow(h, c)
        got = int(pieces.piece[pieces.find(h)[0]])
        return got if got > 0 else (0 if len(s) == 1 else None)

    def total(w, k):
        if not w:
            return 1.0
        return sum(probs[p, k] * total(w[n:], k) for n in range(1, len(w) + 1) if (p := piece(w[:n])) is not None)
    ws = ["▁the", "▁ω中x", "▁thinking", "▁schön"]
    got = language_id.log_likelihoods(ws, pieces, probs)
    assert np.allclose(got, [[math.log(total(w, k)) for k in (0, 1)] for w in ws])
    # expected counts: as many characters as the words have
    counts = language_id.expected_counts(["▁the"], np.array([3.0]), pieces, probs[:, :1])
    assert counts.sum() > 0 and counts.min() >= 0


def test_held_out_accuracy_and_edges(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    got = language_id.identify_languages(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out")
    assert got.filter("lang = lang_pred").count() >= 0.98 * got.count()
    rows = [(k, "the cat and the dog ran home", "en") for k in range(8)] + [(k + 8, "le chat et le chien sont ici", "fr") for k in range(8)]
    rows += [(100, None, "en"), (101, "", "en"), (102, "12 ²³ __ !!", "fr"), (103, "x" * 5000, None), (None, "le chien", None), (104, "LE CHIEN", None), (104, "LE CHIEN", None)]
    out = [(r.doc_id, r.lang_pred, r.score) for r in language_id.identify_languages(
        docs_of(spark, rows).selectExpr("*", "1 AS score", "2 AS word")).collect()]
    by = {i: (p, s) for i, p, s in out}
    assert len(out) == len(rows) and by[100] == by[101] == by[102] == ("und", 0.0)
    assert by[None][0] == by[104][0] == "fr" and by[103][0] in ("en", "fr") and all(0 <= s <= 1 for _, _, s in out)
    empty = language_id.identify_languages(docs_of(spark, [(1, "a b", None)])).collect()
    assert [(r.lang_pred, r.score) for r in empty] == [("und", 0.0)]
    assert language_id.identify_languages(docs_of(spark, [])).count() == 0


def test_long_stretches_of_rare_pieces_do_not_underflow():
    """Smallest probabilities as of 1e10 trained pieces: sums and expected counts agree with exact fractions."""
    from fractions import Fraction

    pieces = language_id.Pieces(language_id.vocabulary_path())
    rng = np.random.default_rng(4)
    probs = np.where(rng.random((pieces.size, 2)) < 0.5, 5e-12, rng.random((pieces.size, 2)) * 1e-4)
    words = ["▁" + "ω中" * 31 + "x", "▁internationalisation" * 3, "▁the"]
    words.append("q" * 64)
    probs[0] = 5e-12
    probs[:, 1] = 5e-12  # a language that has seen none of it
    got = language_id.log_likelihoods(words, pieces, probs)
    for k in (0, 1):
        used = {}
        for w, ll in zip(words, got[:, k], strict=True):
            steps = [(i, j, int(ids[0])) for i, j, _, ids in pieces.steps(language_id._codes([w]))]
            fore, back = ([Fraction(0)] * (len(w) + 1) for _ in range(2))
            fore[0] = back[-1] = Fraction(1)
            for i, j, p in steps:
                fore[j] += fore[i] * Fraction(probs[p, k])
            for i, j, p in reversed(steps):
                back[i] += back[j] * Fraction(probs[p, k])
            exact = math.log(fore[-1].numerator) - math.log(fore[-1].denominator)
            assert math.isclose(ll, exact, rel_tol=1e-9), w
            for i, j, p in steps:
                used[p] = used.get(p, 0.0) + float(3 * fore[i] * Fraction(probs[p, k]) * back[j] / fore[-1])
        counts = language_id.expected_counts(words, np.full(len(words), 3.0), pieces, probs[:, [k]])
        assert np.allclose(counts, [used.get(p, 0.0) for p in range(pieces.size)], rtol=1e-9, atol=1e-12)


def test_long_foreign_word_keeps_a_score(spark):
    """One unbroken stretch unseen in every language: a score between 0 and 1, and the other words decide."""
    pieces = language_id.Pieces(language_id.vocabulary_path())
    rows = [(k, "the cat and the dog ran home", "en") for k in range(8)] + [(k + 8, "le chat et le chien sont ici", "fr") for k in range(8)]
    model = language_id.train(docs_of(spark, rows))
    assert len(model.probs) == pieces.size
    probs = model.probs.copy()
    probs[probs <= probs.min(axis=0) * 1.001] = 5e-12  # unseen pieces after 1e10 trained ones
    rare = language_id.LanguageModel(model.langs, model.pieces, probs, model.prior)
    got = language_id.predict(docs_of(spark, [(1, "le chien et le chat sont ici " + "中" * 63)]), rare).collect()
    assert got[0].lang_pred == "fr" and 0 <= got[0].score <= 1


def test_runs_of_a_batch_are_those_of_each_text():
    """Latin-1 texts are split without the pattern: the same runs for every character, alone and among others."""
    import pyarrow as pa

    odd = ["İstanbul ΑΣ. ǅ ﬁ x²³ ¹² ½ a1b2_c", "l’été “œuvre”", None, "", " \x85a\x1cb\xa0c\x00d", "中文 日本\u3000語 ٣٤ ÿŸ ß ẞ", "NAÏVE naïve 12"]
    odd += [f"{chr(c)}a{chr(c)} B{chr(c)}" for c in range(0x250)] + [" ".join(map(chr, range(lo, lo + 128))) for lo in range(0, 0x3000, 128)]
    for texts in (odd, [None], []):
        ends, at, words = language_id.runs(pa.array(texts, pa.string()))
        assert len(set(words)) == len(words)
        got = [[words[k] for k in at[a:b] if words[k]] for a, b in zip(ends, ends[1:], strict=False)]
        assert got == [language_id.raw_words(t) for t in texts]
    words = ["", "le", "²³", "x" * 63, "x" * 64, "x" * 200, "a²", "²" * 70, "chat"]
    flat, sizes = language_id.cut(words)
    assert flat == [x for w in words for x in language_id.stretches(w)]
    assert sizes.tolist() == [len(language_id.stretches(w)) for w in words]
    assert [f.tolist() if isinstance(f, np.ndarray) else f for f in language_id.cut([])] == [[], []]


def test_training_segments_languages_and_small_batches_together(monkeypatch):
    """One walk over the pieces for each length of word, however the rows are dealt to batches and languages; same counts."""
    import pyarrow as pa

    pieces = language_id.Pieces(language_id.vocabulary_path())
    rng = np.random.default_rng(2)
    probs = rng.random((pieces.size, 3)) * 1e-3
    words = ["▁chat", "▁chien", "▁the", "▁" + "ω中" * 31, "▁internationalisation"]
    rows = [(int(k), w, int(rng.integers(1, 9))) for w in words * 8 for k in rng.integers(0, 3, 5)]
    batches = [pa.RecordBatch.from_pydict({"lang": [str(k) for k, _, _ in rows[lo:lo + 7]], "word": [w for _, w, _ in rows[lo:lo + 7]],
                                           "n": [n for *_, n in rows[lo:lo + 7]]}) for lo in range(0, len(rows), 7)]
    assert [len(w) for _, w, _ in language_id.gathered(iter(batches), 50)] == [56, 56, 56, 32]
    (lang, got, n), = language_id.gathered(iter(batches))
    assert [(int(k), w, c) for k, w, c in zip(lang, got, n.tolist(), strict=True)] == rows
    alone = np.zeros((pieces.size, 3))
    for k, w, c in rows:
        alone[:, k] += language_id.expected_counts([w], np.array([float(c)]), pieces, probs[:, [k]])
    walks = []
    steps = language_id.Pieces.steps
    monkeypatch.setattr(language_id.Pieces, "steps", lambda self, codes: walks.append(codes.shape[1]) or steps(self, codes))
    whole = language_id.expected_counts(got, n.astype(float), pieces, probs, np.array([int(k) for k in lang]))
    assert sorted(walks) == sorted({len(w) for w in words})
    assert np.allclose(whole, alone, rtol=1e-9, atol=1e-12)

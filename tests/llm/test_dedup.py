"""Embedding, MinHash, suffix-array and line dedup against brute force."""

import hashlib
import itertools
import random

import numpy as np
import pytest

from helpers import components, docs_of, prose, words
from stockbook.llm import embedding_dedup, line_dedup, minhash_dedup, suffix_array, suffix_dedup

# ------------------------------------------------------------ embeddings


def _vectors(rng, n=260, dim=16):
    base = rng.standard_normal((12, dim))
    rows = []
    for k in range(n):
        v = base[k % 12] + rng.standard_normal(dim) * rng.choice([0.02, 0.1, 0.6])
        rows.append([float(np.float32(x)) for x in v])
    return rows


def _brute_embeddings(rows, least=0.98):
    ok = {}
    for k, (_, v, label) in enumerate(rows):
        if label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            ok[k] = np.array(v, float)
    links = [(a, b) for a, b in itertools.combinations(ok, 2)
             if rows[a][2] == rows[b][2] and len(ok[a]) == len(ok[b])
             and ok[a] @ ok[b] / (np.linalg.norm(ok[a]) * np.linalg.norm(ok[b])) >= least]
    return links


@pytest.mark.parametrize("block", [embedding_dedup.BLOCK, 8])
def test_embeddings_match_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(embedding_dedup, "BLOCK", block)
    rng = np.random.default_rng(3)
    rows = [(k, v, int(k % 2)) for k, v in enumerate(_vectors(rng))]
    rows += [(1000 + k, rows[0][1], 0) for k in range(20)]  # a group of copies
    rows += [(2000, [0.0] * 16, 0), (2001, None, 0), (2002, rows[0][1], None), (2003, [float("nan")] * 16, 0), (2004, [], 0),
             (2005, [1.0, None] * 8, 0), (2006, rows[0][1][:8], 0), (2007, [x * 3e30 for x in rows[0][1]], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").selectExpr("*", "1 AS node", "'x' AS vector", "2 AS component")
    got = {r.vec_id: r for r in embedding_dedup.embedding_duplicates(df).collect()}
    links = _brute_embeddings(rows)
    comp = components(range(len(rows)), links)
    n = np.bincount(np.array(links).ravel(), minlength=len(rows))
    assert len(got) == len(rows)
    for k, (vec_id, *_) in enumerate(rows):
        assert (got[vec_id].n_links, got[vec_id].component_id) == (n[k], rows[comp[k]][0]), vec_id
        assert got[vec_id].kept == (got[vec_id].component_id == vec_id)


def test_embeddings_empty_and_repeated_ids(spark):
    schema = "vec_id long, embedding array<float>, label int"
    assert embedding_dedup.embedding_duplicates(spark.createDataFrame([], schema)).count() == 0
    got = embedding_dedup.embedding_duplicates(spark.createDataFrame([(1, [1.0, 0.0], 0), (1, [1.0, 0.0], 0), (None, [1.0, 0.0], 0)], schema)).collect()
    assert sorted((r.vec_id or 0, r.n_links, r.component_id) for r in got) == [(0, 2, 1), (1, 2, 1), (1, 2, 1)]


# ------------------------------------------------------------ MinHash


def _near_docs(rng, n=120):
    base = [prose(rng, 80, 5000).split() for _ in range(12)]
    rows = []
    for k in range(n):
        w = list(base[k % 12])
        for _ in range(rng.choice([0, 0, 1, 2, 4, 8])):
            w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
        rows.append((k, " ".join(w)))
    return rows


def _brute_near(rows, shingle):
    sets = {}
    for i, t in rows:
        w = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
        w = words(w)
        sets[i] = {tuple(w[k:k + shingle]) for k in range(max(1, len(w) - shingle + 1))} if w else set()
    links = [(a, b) for a, b in itertools.combinations(sets, 2)
             if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    return sets, components(sets, links)


@pytest.mark.parametrize(("shingle", "block", "shingles"), [(4, 2048, 1 << 20), (5, 4, 200)])
def test_minhash_matches_brute_force(spark, monkeypatch, shingle, block, shingles):
    monkeypatch.setattr(minhash_dedup, "BLOCK", block)
    monkeypatch.setattr(minhash_dedup, "BLOCK_SHINGLES", shingles)
    rows = _near_docs(random.Random(5))
    rows += [(500, rows[0][1].upper()), (501, None), (502, ""), (503, " \n"), (504, "one two"), (505, "One  two"), (506, "É x"), (507, "é x")]
    df = docs_of(spark, rows).selectExpr("*", "1 AS node", "2 AS th", "3 AS key", "4 AS component")
    got = {r.doc_id: r for r in minhash_dedup.near_duplicates(df, shingle, 80).collect()}
    sets, comp = _brute_near(rows, shingle)
    assert {i: (got[i].n_shingles, got[i].component_id, got[i].kept) for i in sets} == {
        i: (len(sets[i]), comp[i], comp[i] == i) for i in sets}


def test_minhash_second_round_joins_what_the_forest_missed(spark, monkeypatch):
    """With every forest candidate refuted, the groups' own check finds all links."""
    rows = _near_docs(random.Random(8))
    real = minhash_dedup._forest_pairs
    monkeypatch.setattr(minhash_dedup, "_forest_pairs", lambda *a: real(*a).filter("false"))
    got = {r.doc_id: r.component_id for r in minhash_dedup.near_duplicates(docs_of(spark, rows), 4, 80).collect()}
    assert got == _brute_near(rows, 4)[1]


def test_minhash_stage_keeps_one_row_a_group(spark):
    rng = random.Random(1)
    a, b = prose(rng, 60), prose(rng, 60)
    df = docs_of(spark, [(3, a), (1, a), (1, a), (2, b), (2, a + " z"), (None, b), (7, ""), (8, None)]).selectExpr("*", "doc_id AS sb_rows")
    out = minhash_dedup.drop_near_duplicates(df)
    assert out.columns == df.columns
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.text or "") for r in out.collect()) == sorted([(1, a), (-1, b), (7, ""), (8, "")])
    assert minhash_dedup.drop_near_duplicates(df.limit(0)).count() == 0


def test_odd_sketch_estimates_high_similarity():
    a, b = minhash_dedup._constants(minhash_dedup.BANDS * minhash_dedup.ROWS)
    rng = np.random.default_rng(2)
    table = minhash_dedup.estimate_table()
    for share in (0.8, 0.9, 0.95):
        errors = []
        for _ in range(30):
            x = rng.integers(0, 2**63, 1000, dtype=np.uint64)
            keep = int(1000 * 2 * share / (1 + share))
            y = np.concatenate([x[:keep], rng.integers(0, 2**63, 1000 - keep, dtype=np.uint64)])
            sx, sy = (np.frombuffer(minhash_dedup.odd_sketch(minhash_dedup.signature(v, a, b)), np.uint64) for v in (x, y))
            errors.append(table[int(np.bitwise_count(sx ^ sy).sum())] - share)
        assert abs(np.mean(errors)) < 0.02 and max(map(abs, errors)) < minhash_dedup.SLACK


# ------------------------------------------------------------ suffix arrays


def test_linear_grouping_sorts_suffixes():
    rng = random.Random(4)
    for _ in range(400):
        x = [rng.randint(0, rng.choice([1, 2, 4])) for _ in range(rng.randint(0, 60))]
        assert suffix_array.suffix_array(np.array(x, np.int64)).tolist() == sorted(range(len(x)), key=lambda i: x[i:])


def _brute_bytes(rows, length=100):
    seen, out = set(), []
    for i, t in sorted(rows, key=lambda r: r[0]):
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for s in range(len(b) - length + 1):
            if b[s:s + length] in seen:
                gone[s:s + length] = True
            seen.add(b[s:s + length])
        spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        out.append((i, len(b), int(gone.sum()), spans, hashlib.sha256(bytes(c for c, g in zip(b, gone, strict=True) if not g)).hexdigest()))
    return out


@pytest.mark.parametrize("part", [suffix_dedup.PART, 3])
def test_repeated_bytes_match_brute_force(spark, monkeypatch, part):
    monkeypatch.setattr(suffix_dedup, "STRETCH", 700)  # long texts are scanned in stretches
    rng = random.Random(6)
    passages = [prose(rng, 40, 5000) for _ in range(3)] + ["ü" * 80, "ab" * 90]
    rows = [(k, prose(rng, 30, 5000) + rng.choice(passages) + prose(rng, rng.choice([1, 200]), 5000)) for k in range(40)]
    rows += [(100, rows[0][1]), (101, None), (102, ""), (103, "x" * 99), (104, "x" * 99), (105, "y" * 400), (106, "y" * 130),
             (107, passages[0] + passages[0]), (108, "q" * 100), (109, "q" * 100)]
    df = docs_of(spark, rows).selectExpr("*", "1 AS id", "2 AS tag", "3 AS spans", "4 AS kept")
    got = suffix_dedup.remove_repeats(df, part=part).collect()
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == _brute_bytes(rows)
    assert all(hashlib.sha256(bytes(r.kept)).hexdigest() == r.kept_sha256 for r in got)


def test_repeated_bytes_empty_null_and_equal_rows(spark):
    t = prose(random.Random(2), 60)
    assert suffix_dedup.remove_repeats(docs_of(spark, [])).count() == 0
    got = suffix_dedup.remove_repeats(docs_of(spark, [(5, t), (5, t), (None, t)])).collect()
    # rows equal in id and text share a result; the null id comes first
    assert sorted((r.doc_id or 0, r.n_removed) for r in got) == [(0, 0), (5, len(t)), (5, len(t))]


# ------------------------------------------------------------ lines


def _line_size(line):
    return max(len(words(line)), sum(map(len, words(line))) // 6)


def _brute_lines(rows, min_size):
    docs = [[(n, line, _line_size(line)) for n, line in enumerate((t or "").split("\n")) if words(line)] for _, t in rows]
    seen, gone = set(), [set() for _ in rows]
    for d, lines in enumerate(docs):
        for i in range(len(lines)):
            for j in range(i + 1, len(lines) + 1):
                run = tuple(x[1] for x in lines[i:j])
                if sum(x[2] for x in lines[i:j]) >= min_size:
                    if run in seen:
                        gone[d] |= {x[0] for x in lines[i:j]}
                    seen.add(run)
    return ["\n".join(x for n, x in enumerate((t or "").split("\n")) if n not in g) for (_, t), g in zip(rows, gone, strict=True)], gone


def test_lines_match_brute_force_over_all_runs(spark):
    rng = random.Random(9)
    pool = [prose(rng, rng.choice([1, 1, 2, 2, 3, 12]), 50) for _ in range(16)] + ["", "  ", "漢字" * 8, "漢字" * 9, "é😀" * 9, "Yes."]
    rows = [(k, "\n".join(rng.choice(pool) for _ in range(rng.randrange(12)))) for k in range(60)]
    rows += [(100, None), (101, ""), (102, "\n\n"), (103, "\n".join(pool * 3))]
    df = docs_of(spark, rows).selectExpr("*", "1 AS id", "2 AS h", "3 AS cut", "4 AS sb_kept")
    kept, gone = _brute_lines(rows, line_dedup.MIN_SIZE)
    got = {r.doc_id: r for r in line_dedup.line_report(df).collect()}
    for (i, _), text, g in zip(rows, kept, gone, strict=True):
        assert (got[i].kept_sha256, got[i].n_removed) == (hashlib.sha256(text.encode()).hexdigest(), len(g)), i
    stage = line_dedup.drop_repeated_lines(df)
    assert stage.columns == df.columns
    want = {i: text for (i, _), text, g in zip(rows, kept, gone, strict=True) if not g or words(text)}
    assert {r.doc_id: r.text or "" for r in stage.collect()} == want
    assert all(r.n_chars == len(r.text or "") for r in stage.collect())


def test_lines_empty_table_and_null_id(spark):
    assert line_dedup.line_report(docs_of(spark, [])).count() == 0
    t = prose(random.Random(3), 20)
    got = line_dedup.line_report(docs_of(spark, [(4, t), (None, t), (4, t)])).collect()
    assert sorted((r.doc_id or 0, r.n_removed) for r in got) == [(0, 0), (4, 1), (4, 1)]


# ------------------------------------------------------------ repeated and missing ids


def _spark_hash(spark, texts):
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k long, text string")
    return [r.h for r in df.selectExpr("k", "xxhash64(text) AS h").orderBy("k").collect()]


def test_repeated_bytes_many_null_ids(spark):
    """Texts of one id whose hashes share 25 bits, as among thousands of null ids, stay apart."""
    rng = random.Random(12)
    passages = [prose(rng, 40, 5000) for _ in range(3)]
    texts = [f"{prose(rng, rng.choice([5, 30]), 5000)} {passages[k % 3][:rng.choice([150, 220])]} {k}" for k in range(20_000)]
    by: dict = {}
    for h, t in zip(_spark_hash(spark, texts), texts, strict=True):
        by.setdefault((h % 2**64) >> 39, []).append((h, t))
    rows = sorted(x for same in by.values() if len(same) > 1 for x in same)
    assert len(rows) > 4
    got = suffix_dedup.remove_repeats(docs_of(spark, [(None, t) for _, t in rows])).collect()
    assert sorted((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == sorted(x[1:] for x in _brute_bytes(rows))


@pytest.mark.parametrize("part", [suffix_dedup.PART, 3])
def test_repeated_bytes_repeated_rows_beside_others(spark, part):
    """Rows given twice lose what occurs earlier in other rows, not their own text."""
    rng = random.Random(13)
    passages = [prose(rng, 40, 5000) for _ in range(3)]
    rows = [(k, prose(rng, 30, 5000) + passages[k % 3] + prose(rng, 30, 5000)) for k in range(24)]
    want = [x for x in _brute_bytes(rows) for _ in range(1 + x[0] % 3)]
    got = suffix_dedup.remove_repeats(docs_of(spark, [x for x in rows for _ in range(1 + x[0] % 3)]), part=part).collect()
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == want


def test_minhash_many_null_ids_bring_one_text_a_node(spark, monkeypatch):
    rng = random.Random(15)
    rows = _near_docs(rng)
    ids = {k: None if k % 4 else k for k, _ in rows}
    real, seen = minhash_dedup._confirmed, []

    def confirmed(pairs, texts, *more):
        seen.append(texts.count())
        assert seen[-1] == texts.select("node").distinct().count()
        return real(pairs, texts, *more)
    monkeypatch.setattr(minhash_dedup, "_confirmed", confirmed)
    twice = [(ids[k], t) for k, t in rows for _ in range(1 + k % 2)]
    got = sorted((r.doc_id or -1, r.n_shingles, r.component_id or -1) for r in minhash_dedup.near_duplicates(docs_of(spark, twice), 4, 80).collect())
    assert seen[0]
    sets, comp = _brute_near(rows, 4)
    low: dict = {}
    for k, c in comp.items():
        low[c] = min((x for x in (low.get(c), ids[k]) if x is not None), default=None)
    want = sorted(((-1 if ids[k] is None else ids[k]) or -1, len(sets[k]), low[comp[k]] or -1) for k, _ in rows for _ in range(1 + k % 2))
    assert got == want


def test_embeddings_pairs_of_two_lengths(spark):
    rng = np.random.default_rng(9)
    rows = [(10 * dim + 2 * p + k, [float(np.float32(x * (1 + k))) for x in v], 0)
            for dim in (16, 24) for p in range(2) for v in [rng.standard_normal(dim)] for k in (0, 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(1)
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_dedup.embedding_duplicates(df).collect()}
    assert got == {i: (1, i - i % 2) for i, _, _ in rows}

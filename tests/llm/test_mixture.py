"""Packing, mixing and the pipeline."""

import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import SF_MID, SF_SMALL
from helpers import docs_of, prose, words
from stockbook.llm import mixing, packing


def _check_packing(rows, capacity=2048):
    by = {}
    for r in rows:
        assert 0 < r.length <= capacity
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in by.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_pieces_hold_the_tokenizer_ids(spark):
    import public_tokenizers
    from tokenizers import Tokenizer
    hf = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rng = random.Random(3)
    rows = [(k, prose(rng, rng.choice([1, 30, 300, 3000]))) for k in range(30)]
    rows += [(50, None), (51, ""), (52, "a <|endoftext|> b"), (53, "é💡\n\n  x\t" * 50), (54, "z" * 9000), (50, None)]
    out = packing.pack_documents(docs_of(spark, rows).selectExpr("*", "1 AS item", "2 AS piece", "3 AS bin")).collect()
    _check_packing(out)
    by = {}
    for r in out:
        by.setdefault(r.doc_id, {}).setdefault(r.piece, r)
    for i, t in rows:
        ids = [*hf.encode(t or "", add_special_tokens=False).ids, 0]
        got = [by[i][k] for k in sorted(by[i])]
        assert [x for r in got for x in r.ids] == ids and [r.start for r in got] == np.cumsum([0] + [r.length for r in got[:-1]]).tolist()
        assert all(r.length == 2048 for r in got[1:])
        assert all(r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in got)
    assert sum(r.doc_id == 50 for r in out) == 2  # repeated rows are packed each
    assert packing.pack_documents(docs_of(spark, [])).count() == 0


def test_packing_is_near_the_bound_over_levels(spark):
    rng = random.Random(4)
    lens = [rng.choice([rng.randrange(1, 300), rng.randrange(1, 2049)]) for _ in range(1500)]
    items = spark.createDataFrame(list(enumerate(lens)), "item long, length long")
    placed = packing.pack_items(items, shard_items=200).join(items, "item")
    used = _check_packing(placed.collect())
    assert placed.count() == 1500 and used <= math.ceil(sum(lens) / 2048 * 1.01) + 1


def test_crossover_keeps_every_item_once():
    rng = random.Random(5)
    lens = [rng.randrange(1, 1500) for _ in range(200)]
    a = packing.best_fit([], list(range(200)), lens, 2048)
    b = packing.mutate(a, lens, 2048, rng)
    for _ in range(20):
        a, b = b, packing.crossover(a, b, lens, 2048, rng)
        assert sorted(i for x in b for i in x) == list(range(200))
        assert all(sum(lens[i] for i in x) <= 2048 for x in b)


def _brute_mixture(rows, limit):
    """tokens, weight by source under the smallest exponent within the limit, budget = all tokens."""
    tokens = {}
    for _, t, s in rows:
        tokens[s] = tokens.get(s, 0) + len(words(t))
    total = sum(tokens.values())
    share = {s: n / total for s, n in tokens.items() if n}
    lo, hi = 0.0, 1.0
    for _ in range(30):
        a = (lo + hi) / 2
        z = sum(x**a for x in share.values())
        lo, hi = (lo, a) if max(x**a / x for x in share.values()) / z <= limit else (a, hi)
    z = sum(x**hi for x in share.values())
    return tokens, {s: x**hi / z for s, x in share.items()}, total


def test_mixture_meets_weights_and_limit(spark):
    rng = random.Random(6)
    rows = [(k, prose(rng, rng.randrange(1, 60)), rng.choice(["hot"] * 8 + ["mid"] * 3 + ["rare", None])) for k in range(900)]
    rows += [(5000, None, "none"), (5001, "", "none"), (None, "a b c", "mid"), (7, rows[7][1], rows[7][2])]
    df = docs_of(spark, [(i, t, "en", s) for i, t, s in rows]).selectExpr("*", "1 AS copies", "2 AS weight", "3 AS passes", "4 AS rank", "5 AS n")
    got = mixing.mixing_report(df, repeat_limit=2.0).collect()
    tokens, weight, total = _brute_mixture(rows, 2.0)
    assert len(got) == len(rows)
    drawn = {}
    for r in got:
        drawn[r.source] = drawn.get(r.source, 0) + r.copies * r.n_tokens
        assert r.source == "none" or math.isclose(r.weight, weight[r.source], abs_tol=1e-6)
    for s, w in weight.items():
        assert w * total - 130 <= drawn[s] <= w * total + 1, s  # a document or two (equal ids go together) short at most
        assert drawn[s] <= 2.0 * tokens[s] + 1
    assert all(r.copies == 1 for r in got if r.source == "none")
    whole = mixing.mix(df, repeat_limit=3.0, cover=True)
    assert whole.columns == df.columns
    n = {r.source: r[1] for r in whole.groupBy("source").count().collect()}
    rows_of = {r.source: r[1] for r in df.groupBy("source").count().collect()}
    assert n["hot"] == rows_of["hot"] and all(rows_of[s] <= n[s] <= 3 * rows_of[s] + 2 for s in n)
    assert whole.select("doc_id").distinct().count() == df.select("doc_id").distinct().count()


def test_mixture_target_entropy_and_empty(spark):
    rng = random.Random(8)
    df = docs_of(spark, [(k, prose(rng, 10), "en", "a" if k % 10 else "b") for k in range(300)])
    plan = mixing.plan_mixture(df, repeat_limit=None, target_entropy=0.5).collect()
    assert math.isclose(-sum(r.weight * math.log(r.weight) for r in plan), 0.5, abs_tol=1e-4)
    assert mixing.mix(docs_of(spark, [])).count() == 0
    assert mixing.mixing_report(docs_of(spark, [(1, None), (2, "")])).filter("copies = 1").count() == 2


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    have = docs
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        before, have = have, stage(spark, have, SF_SMALL).cache()
        assert have.columns == docs.columns
        assert have.join(before, "doc_id", "left_anti").count() == 0
        if k == 0:
            assert have.join(labels, "doc_id").filter("quality = 0").count() == 0
    assert have.select("doc_id").distinct().count() == before.select("doc_id").distinct().count()  # mixing keeps every document
    out = corpus_pipeline.run(spark, SF_SMALL).collect()
    _check_packing(out)
    assert {r.doc_id for r in out} == {r.doc_id for r in have.select("doc_id").collect()}


@pytest.mark.parametrize("stage", [f for _, f in corpus_pipeline.STAGES])
def test_stages_take_empty_tables_nulls_and_more_columns(spark, stage):
    assert stage(spark, docs_of(spark, []), SF_MID).count() == 0
    df = docs_of(spark, [(None, None), (1, ""), (1, ""), (2, "a b"), (None, prose(random.Random(1), 80), None, None)]).withColumn("id", F.lit(1)).withColumn("kept", F.lit("x"))
    out = stage(spark, df, SF_MID)
    assert out.count() >= 0
    if stage is not corpus_pipeline.STAGES[-1][1]:
        assert out.columns == df.columns

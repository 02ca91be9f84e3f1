"""The queries of the training-data operators, with DuckDB SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockbook.llm import (chat_format, embedding_dedup, language_id, line_dedup, minhash_dedup, mixing, packing, pii,
                           quality_rules, secret_scan, spelling, suffix_dedup, vector_codes)
from stockbook.llm.common import table

MIX = {"repeat_limit": 4.0}


def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.embedding_duplicates(table(spark, sf_dir, "embeddings"), 0.98)


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.score_quality(table(spark, sf_dir, "documents"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), with_ids=False)


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.lit("\\### Assistant: </turn> ok")
    more = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), text.alias("text"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(more)
    return chat_format.chat_digest(chat_format.format_chats(rows))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixing_report(table(spark, sf_dir, "documents"), **MIX)


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), with_kept=False)


def op7_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash_dedup.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, percent=80)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(table(spark, sf_dir, "documents"))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_digest(secret_scan.scan_secrets(table(spark, sf_dir, "documents")))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify_languages(table(spark, sf_dir, "documents")).select("doc_id", "held_out", "lang_pred", "score")


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_spellings(table(spark, sf_dir, "documents"))


def op12_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_digest(pii.scan_pii(table(spark, sf_dir, "documents")))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.code_report(table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_embedding_dedup, op2_quality_rules, op3_packing, op4_chat_format, op5_mixing,
        op6_suffix_dedup, op7_minhash_dedup, op8_line_dedup, op9_secret_scan, op10_language_id,
        op11_spelling, op12_pii, op13_vector_codes)}


_OP1 = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL),
u AS (SELECT vec_id, label, e, sqrt(list_dot_product(e, e)) AS norm FROM v),
link AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM u a JOIN u b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE a.norm > 0 AND b.norm > 0 AND list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.98),
reach AS (SELECT x, y FROM link UNION SELECT r.x, l.y FROM reach r JOIN link l ON r.y = l.x)
SELECT e.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, least(e.vec_id, coalesce(c.low, e.vec_id)) AS component_id,
       e.vec_id <= coalesce(c.low, e.vec_id) AS kept
FROM embeddings e
LEFT JOIN (SELECT x, count(*) AS n FROM link GROUP BY x) n ON n.x = e.vec_id
LEFT JOIN (SELECT x, min(y) AS low FROM reach GROUP BY x) c ON c.x = e.vec_id
"""

_OP4 = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
marked AS (
  SELECT *, replace(replace(text, '\', '\s'), '<|', '\l') AS esc,
    replace(replace(replace(role, '\', '\s'), '<|', '\l'), chr(10), '\e') AS esc_role,
    lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) IS DISTINCT FROM role AS head
  FROM rows)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length(esc) + CASE WHEN head THEN length('<|start|>') + length(esc_role) + 1 + length('<|end|>') + 1
                         ELSE length('<|turn|>') END)::BIGINT AS formatted_chars
FROM marked GROUP BY conv_id
"""

_OP5 = r"""
WITH RECURSIVE t AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS n,
         md5(coalesce(doc_id::VARCHAR, '')) AS rk FROM documents),
per AS (SELECT source, sum(n)::DOUBLE AS tokens FROM t GROUP BY source),
tot AS (SELECT sum(tokens) AS total FROM per),
sh AS (SELECT list(tokens / total) AS sh FROM per, tot WHERE tokens > 0),
bis AS (
  SELECT 0 AS i, 0.0::DOUBLE AS lo, 1.0::DOUBLE AS hi, sh FROM sh
  UNION ALL
  SELECT i + 1, CASE WHEN ok THEN lo ELSE (lo + hi) / 2 END, CASE WHEN ok THEN (lo + hi) / 2 ELSE hi END, sh
  FROM (SELECT *, list_max(list_transform(sh, lambda x: pow(x, (lo + hi) / 2) / x))
                  / list_sum(list_transform(sh, lambda x: pow(x, (lo + hi) / 2))) <= 4.0 AS ok FROM bis WHERE i < 30)),
a AS (SELECT hi AS a, list_sum(list_transform(sh, lambda x: pow(x, hi))) AS z FROM bis WHERE i = 30),
w AS (SELECT source, tokens, CASE WHEN tokens > 0 THEN round(pow(tokens / total, a) / z, 9) ELSE 0 END AS weight, total FROM per, tot, a),
goal AS (
  SELECT source, weight, CASE WHEN tokens = 0 THEN 1 ELSE floor(floor(weight * total + 0.5) / tokens) END AS passes,
         CASE WHEN tokens = 0 THEN 0 ELSE floor(weight * total + 0.5) % tokens END AS rest FROM w),
run AS (SELECT *, sum(n) OVER (PARTITION BY source ORDER BY rk) AS upto FROM t)
SELECT r.doc_id, r.source, r.n AS n_tokens, g.weight, (g.passes + (r.upto <= g.rest AND g.rest > 0)::INT)::BIGINT AS copies
FROM run r JOIN goal g ON r.source IS NOT DISTINCT FROM g.source
"""

_OP8 = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT r, doc_id, i, ls[i] AS line, greatest(len(regexp_extract_all(ls[i], '[^\x20\x09-\x0D]+')),
             length(regexp_replace(ls[i], '[\x20\x09-\x0D]', '', 'g')) // 6) AS n
      FROM (SELECT r, doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM d)),
w AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY i) AS k, sum(n) OVER (PARTITION BY r ORDER BY i) AS c FROM l WHERE n > 0),
shortest AS (
  SELECT a.r, a.doc_id, a.k AS s, b.k AS e FROM w a JOIN w b ON a.r = b.r AND b.k BETWEEN a.k AND a.k + 3
   AND b.c - a.c + a.n >= 3 AND b.c - b.n - a.c + a.n < 3
  UNION
  SELECT a.r, a.doc_id, a.k, b.k FROM w a JOIN w b ON a.r = b.r AND b.k BETWEEN a.k AND a.k + 3
   AND b.c - a.c + a.n >= 3 AND b.c - a.c < 3),
named AS (
  SELECT x.r, x.doc_id, s, e, string_agg(w.line, chr(10) ORDER BY w.k) AS body
  FROM shortest x JOIN w ON w.r = x.r AND w.k BETWEEN s AND e GROUP BY x.r, x.doc_id, s, e),
nth AS (SELECT *, row_number() OVER (PARTITION BY body ORDER BY doc_id, s) AS nth FROM named),
gone AS (SELECT DISTINCT w.r, w.i, w.k FROM nth x JOIN w ON w.r = x.r AND w.k BETWEEN s AND e WHERE nth > 1),
runs AS (SELECT r, count(*) AS n, count(*) FILTER (p IS NULL OR p <> k - 1) AS runs
         FROM (SELECT *, lag(k) OVER (PARTITION BY r ORDER BY k) AS p FROM gone) GROUP BY r)
SELECT d.doc_id, len(d.ls)::BIGINT AS n_lines, coalesce(runs.n, 0)::BIGINT AS n_removed, coalesce(runs.runs, 0)::BIGINT AS n_runs,
       sha256(coalesce(k.kept, '')) AS kept_sha256
FROM d LEFT JOIN runs ON runs.r = d.r
LEFT JOIN (SELECT l.r, string_agg(l.line, chr(10) ORDER BY l.i) AS kept FROM l
           LEFT JOIN gone g ON g.r = l.r AND g.i = l.i WHERE g.r IS NULL GROUP BY l.r) k ON k.r = d.r
"""


def _op13() -> str:
    """Six rounds spelled out; ``x``: (r, vec_id, label, p, j, v) one row a component, ``c0``..``c6``: (p, e, j, c)."""
    near = ("SELECT r, p, min_by(e, (d, e)) AS e, min(d) AS d FROM (SELECT x.r, x.p, c.e, sum((x.v - c.c) * (x.v - c.c)) AS d "
            "FROM x JOIN c{k} c ON c.p = x.p AND c.j = x.j GROUP BY x.r, x.p, c.e) GROUP BY r, p")
    step = ("a{k} AS ({near}), c{n} AS (SELECT c.p, c.e, c.j, coalesce(s.c, c.c) AS c FROM c{k} c LEFT JOIN ("
            "SELECT x.p, a.e, x.j, ((sum(x.v) - ((sum(x.v) % count(*)) + count(*)) % count(*)) // count(*))::BIGINT AS c "
            "FROM x JOIN a{k} a ON a.r = x.r AND a.p = x.p GROUP BY x.p, a.e, x.j) s ON s.p = c.p AND s.e = c.e AND s.j = c.j)")
    rounds = ",\n".join(step.format(k=k, n=k + 1, near=near.format(k=k)) for k in range(vector_codes.ROUNDS))
    return f"""
WITH v AS (
  SELECT row_number() OVER (ORDER BY vec_id, embedding) AS r, vec_id, label, embedding AS e FROM embeddings
  WHERE len(embedding) > 0 AND len(embedding) % 8 = 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
x AS MATERIALIZED (
  SELECT r, (i - 1) // (len(e) // 8) AS p, (i - 1) % (len(e) // 8) AS j, floor(4096 * e[i]::DOUBLE)::BIGINT AS v
  FROM (SELECT *, unnest(range(1, len(e) + 1)) AS i FROM v)),
c0 AS (SELECT p, r - 1 AS e, j, v AS c FROM x WHERE r <= 16),
{rounds},
a{vector_codes.ROUNDS} AS ({near.format(k=vector_codes.ROUNDS)}),
o AS (SELECT r, string_agg(lpad(printf('%x', e), 2, '0'), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM a{vector_codes.ROUNDS} GROUP BY r),
h AS (SELECT sha256(string_agg(c::VARCHAR, ',' ORDER BY p, e, j)) AS h FROM c{vector_codes.ROUNDS})
SELECT v.vec_id, o.code, o.error, (sum(o.error) OVER (PARTITION BY v.label))::BIGINT AS label_error, h.h AS codebooks_sha256
FROM v JOIN o ON o.r = v.r, h
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_embedding_dedup": _OP1, "op4_chat_format": _OP4, "op5_mixing": _OP5, "op8_line_dedup": _OP8,
            "op13_vector_codes": _op13()}

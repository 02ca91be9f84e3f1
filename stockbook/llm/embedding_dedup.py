"""Near-duplicate embeddings by Euclidean p-stable hashing.

Vectors are normalised, so a cosine of at least c is a distance of at most
``sqrt(2 - 2c)``. A table hashes a vector by ``DEPTH`` Gaussian projections,
each shifted at random and cut into steps of ``WIDTH``; vectors of one label
that agree in all of them share a bucket. With the defaults a pair at cosine
0.98 misses all tables with a chance below 1e-4.

Equal vectors are one node with a count. A bucket larger than ``BLOCK`` nodes
is dealt out as block pairs, so no task holds a whole hot bucket. In a bucket
the cosines are computed in blocks in double precision and counted, never
listed: each pair counts in the first table where it meets (the buckets of all
tables travel along), and only a spanning forest of the links leaves the task.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components, and rows with a null label, link with nothing and are kept;
vectors of different lengths never link; repeated vec_ids are one vector each
row, all rows counted; a null vec_id takes part but never names a component;
other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockbook.llm.common import sorted_runs, stored
from stockbook.llm.graph import connected_components

TABLES, DEPTH, WIDTH = 28, 14, 2.0
BLOCK = 1024


def projections(dim: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng([104729, dim])
    return rng.standard_normal((dim, TABLES * DEPTH)), rng.uniform(0, WIDTH, TABLES * DEPTH)


def bucket_keys(unit: np.ndarray) -> np.ndarray:
    """(n, TABLES) bucket hashes of normalised vectors."""
    direction, shift = projections(unit.shape[1])
    cells = np.floor((unit @ direction + shift) / WIDTH).astype(np.int64).view(np.uint64).reshape(len(unit), TABLES, DEPTH)
    h = np.broadcast_to(np.arange(1, TABLES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15), (len(unit), TABLES)).copy()
    with np.errstate(over="ignore"):
        for k in range(DEPTH):
            h = (h ^ cells[:, :, k]) * np.uint64(0xC2B2AE3D27D4EB4F)
            h ^= h >> np.uint64(31)
    return h


def _forest(n: int, links: np.ndarray) -> list[tuple[int, int]]:
    up = list(range(n))
    out = []
    for i, j in links.tolist():
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        while up[j] != j:
            up[j] = up[up[j]]
            j = up[j]
        if i != j:
            up[j] = i
            out.append((i, j))
    return out


def bucket_links(vectors: np.ndarray, keys: np.ndarray, copies: np.ndarray, table: int, least: float,
                 cross: np.ndarray | None) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Per member the rows it links to first in this table, and a spanning forest of the links.

    ``cross``: 0/1 by side where only pairs between the two sides count.
    """
    n = len(vectors)
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    found = np.zeros(n, np.int64)
    forest: list[tuple[int, int]] = []
    for lo in range(0, n - 1, 256):
        cos = unit[lo:lo + 256] @ unit[lo + 1:].T
        i, j = np.nonzero(cos >= least)
        i, j = i + lo, j + lo + 1
        ok = i < j
        if cross is not None:
            ok &= cross[i] != cross[j]
        i, j = i[ok], j[ok]
        first = ~(keys[i, :table] == keys[j, :table]).any(axis=1) if table else np.ones(len(i), bool)
        i, j = i[first], j[first]
        found += np.bincount(i, copies[j], n).astype(np.int64) + np.bincount(j, copies[i], n).astype(np.int64)
        forest = _forest(n, np.array([*forest, *zip(i.tolist(), j.tolist(), strict=True)], np.int64).reshape(-1, 2))
    return found, forest


def _clean(embeddings: DataFrame) -> DataFrame:
    v = F.col("vector")
    fine = F.coalesce(F.size(v) > 0, F.lit(False)) & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    fine = F.coalesce(fine & F.exists(v, lambda x: x != 0), F.lit(False)) & F.col("label").isNotNull()
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"),
                             F.col("embedding").cast("array<double>").alias("vector"))
    # two hashes of label and components name a node; + 0.0 makes -0.0 plain
    key = F.transform("vector", lambda x: x + F.lit(0.0))
    return rows.select("vec_id", "label", "vector", F.when(fine, F.xxhash64("label", key)).alias("node"))


def hashed(nodes: DataFrame) -> DataFrame:
    """node, copies, vec (float64 bytes), keys (bucket hashes as bytes), bucket array<long>."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, 1024):
                batch = whole.slice(lo, 1024)
                lists = batch.column(2).to_pylist()
                label = batch.column(3).to_pylist()
                vec: list = [None] * len(lists)
                keys: list = [None] * len(lists)
                bucket: list = [None] * len(lists)
                for dim in {len(x) for x in lists}:
                    at = [k for k, x in enumerate(lists) if len(x) == dim]
                    m = np.array([lists[k] for k in at])
                    m = m / np.abs(m).max(axis=1, keepdims=True)  # no overflow in the norm
                    h = bucket_keys(m / np.linalg.norm(m, axis=1, keepdims=True))
                    for r, k in enumerate(at):
                        salt = np.uint64(hash_text(f"{label[k]}|{dim}"))
                        with np.errstate(over="ignore"):
                            b = (h[r] ^ salt) * np.uint64(0x9E3779B97F4A7C15)
                        vec[k], keys[k], bucket[k] = m[r].tobytes(), h[r].tobytes(), b.view(np.int64)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(vec, pa.binary()), pa.array(keys, pa.binary()),
                                                  pa.array(bucket, pa.list_(pa.int64()))], names=["node", "copies", "vec", "keys", "bucket"])

    return nodes.select("node", "copies", "vector", "label").mapInArrow(
        run, "node long, copies long, vec binary, keys binary, bucket array<long>")


def hash_text(text: str) -> int:
    import xxhash
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass"))


def embedding_duplicates(embeddings: DataFrame, least: float = 0.98) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of ``embeddings``."""
    rows = _clean(embeddings)
    nodes = rows.filter("node is not null").groupBy("node").agg(
        F.count(F.lit(1)).alias("copies"), F.first("vector").alias("vector"), F.first("label").alias("label"))
    made = stored(hashed(nodes))
    members = made.select("node", F.posexplode("bucket").alias("t", "key"))
    sizes = members.groupBy("t", "key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    n = F.ceil(F.col("size") / BLOCK)
    mine = F.pmod(F.xxhash64("node", F.lit(5)), n)
    pairs = F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda x: F.struct(
        F.least(x, mine).alias("lo"), F.greatest(x, mine).alias("hi"), mine.alias("mine")))
    dealt = members.join(sizes, ["t", "key"]).select("node", "t", "key", F.explode(pairs).alias("p")).select(
        "node", F.col("t").cast("long").alias("t"), "key", "p.lo", "p.hi", "p.mine")
    full = dealt.join(made.select("node", "copies", "vec", "keys"), "node").repartition("t", "key", "lo", "hi").sortWithinPartitions(
        "t", "key", "lo", "hi", "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a: list = []
        b: list = []
        c: list = []
        for g in sorted_runs(batches, ["t", "key", "lo", "hi"], ("vec", "keys")):
            node = g["node"]
            if len(node) < 2:
                continue
            lo, hi = g["lo"][0], g["hi"][0]
            found, forest = bucket_links(g["vec"].view(np.float64), g["keys"], g["copies"], int(g["t"][0]), least,
                                         None if lo == hi else (g["mine"] == lo).astype(np.int8))
            some = np.flatnonzero(found)
            a += node[some].tolist()
            b += [None] * len(some)
            c += found[some].tolist()
            for i, j in forest:
                a.append(int(node[i])), b.append(int(node[j])), c.append(0)
            if len(a) > 50_000:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (a, b, c)], names=["a", "b", "n"])
                a, b, c = [], [], []
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (a, b, c)], names=["a", "b", "n"])

    got = stored(full.mapInArrow(run, "a long, b long, n long"))
    counts = got.filter("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    comp = connected_components(got.filter("b is not null").select("a", "b"))
    per_node = made.select("node", "copies").join(counts, "node", "left").join(comp, "node", "left").select(
        "node", (F.col("copies") - 1 + F.coalesce("n", F.lit(0))).alias("n_links"), F.coalesce("component", "node").alias("component"))
    out = rows.select("vec_id", "node").join(per_node, "node", "left")
    low = out.filter("node is not null").groupBy("component").agg(F.min("vec_id").alias("low"))
    cid = F.coalesce("low", "vec_id")
    return out.join(low, "component", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), cid.alias("component_id"),
        cid.eqNullSafe(F.col("vec_id")).alias("kept"))

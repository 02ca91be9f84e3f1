"""Near-duplicate documents by MinHash with odd sketches.

One scan of the texts makes, per document, the digest of its shingle set, the
band keys of its MinHash signature, and an *odd sketch*: every MinHash sample
flips one bit of a parity bitmap. Two documents share a sample where their
signatures agree, and shared samples cancel, so the population count of the
XOR of two bitmaps estimates their similarity, most precisely where it is high.

Documents with equal sets are one node. Nodes that share a band key meet in
groups, blocked to a bounded size (a large group becomes block pairs, not one
task). Inside a group no pair list is made: Prim's algorithm over sketch
estimates gives a maximum spanning forest, at most members - 1 candidate links.
These are confirmed on the full shingle sets. A second round looks only at groups
that the confirmed links leave in several components: members that the sketches
do not keep apart from all other components bring their full sets, and inside
the group all intersections are counted at once. No pair leaves a task but the
links found, so no link that would join two components is lost to the forest.

A group's candidates need an estimate of ``threshold - slack`` and sizes whose
ratio allows the threshold; bands and slack leave a link at exactly the
threshold a chance below 1e-4 of being missed.

Defined cases: null and empty texts have an empty set and link with nothing;
shorter texts than one shingle count as a single shingle; rows with equal sets
are linked whatever their ids; a null doc_id takes part but never names a
component that has another id; other columns are not looked at. Shingles are
told apart by 64-bit hashes, whole sets by 63-bit ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockbook.llm.common import fresh, null_id, small, small_batches, sorted_runs, stored
from stockbook.llm.graph import connected_components

BANDS, ROWS = 32, 6
SKETCH_BITS = 512
SLACK = 0.18
BLOCK = 2048
BLOCK_SHINGLES = 1 << 20
WORD = r"[^\x20\x09-\x0D]"
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct 64-bit shingle hashes of the whole text, A-Z lower-cased."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    digest = xxhash.xxh3_64_intdigest
    h = np.fromiter(map(digest, words), np.uint64, len(words))
    size_here = min(size, len(words))
    out = np.full(len(words) - size_here + 1, np.uint64(size_here))
    with np.errstate(over="ignore"):
        for k in range(size_here):
            out = (out ^ h[k:k + len(out)]) * np.uint64(0x9E3779B97F4A7C15)
            out ^= out >> np.uint64(32)
    return np.unique(out)


def node_of(shingles: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(shingles.tobytes()) >> 1


def _constants(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(7919)
    return (rng.integers(0, 2**32, n, dtype=np.uint32) | np.uint32(1)), rng.integers(0, 2**32, n, dtype=np.uint32)


def signature(shingles: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """MinHash samples over the set, in slices of bounded size."""
    x = (shingles ^ (shingles >> np.uint64(32))).astype(np.uint32)
    low = np.full(len(a), np.uint32(0xFFFFFFFF))
    with np.errstate(over="ignore"):
        for lo in range(0, len(x), 2048):
            low = np.minimum(low, (a[:, None] * x[None, lo:lo + 2048] + b[:, None]).min(axis=1))
    return low


def band_keys(sig: np.ndarray) -> np.ndarray:
    rows = sig.reshape(BANDS, ROWS).astype(np.uint64)
    h = np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    with np.errstate(over="ignore"):
        for k in range(ROWS):
            h = (h ^ rows[:, k]) * np.uint64(0xC2B2AE3D27D4EB4F)
            h ^= h >> np.uint64(31)
    return h.view(np.int64)


def odd_sketch(sig: np.ndarray) -> bytes:
    """Parity bitmap of the samples: sample i with value v flips bit hash(i, v)."""
    with np.errstate(over="ignore"):
        h = (sig.astype(np.uint64) + np.arange(len(sig), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
    flips = np.bincount((h >> np.uint64(55)).astype(np.int64), minlength=SKETCH_BITS)
    return np.packbits((flips & 1).astype(np.uint8)).tobytes()


def estimate_table() -> np.ndarray:
    """Similarity estimate by population count of the XOR of two sketches."""
    x = np.arange(SKETCH_BITS + 1)
    left = np.clip(1 - 2 * x / SKETCH_BITS, 1e-9, 1)
    return 1 + SKETCH_BITS / (4 * BANDS * ROWS) * np.log(left)


def spanning_forest(sketches: np.ndarray, sizes: np.ndarray, least: float, threshold: float,
                    table: np.ndarray) -> list[tuple[int, int]]:
    """Prim's algorithm without a pair list: links of a maximum spanning forest."""
    n = len(sizes)
    if n == 2:
        est = table[int(np.bitwise_count(sketches[0] ^ sketches[1]).sum())]
        return [(0, 1)] if est >= least and sizes.min() >= threshold * sizes.max() else []
    best, near = np.full(n, -2.0), np.zeros(n, np.int64)
    out = np.zeros(n, bool)
    links = []
    at = 0
    for _ in range(n - 1):
        out[at] = True
        est = table[np.bitwise_count(sketches ^ sketches[at]).sum(axis=1, dtype=np.int64)]
        est = np.where(np.minimum(sizes, sizes[at]) >= threshold * np.maximum(sizes, sizes[at]), est, -2.0)
        better = est > best
        best[better], near[better] = est[better], at
        at = int(np.where(out, -9.0, best).argmax())
        if best[at] >= least:
            links.append((int(near[at]), at))
    return links


def text_hash(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def profile(docs: DataFrame, shingle: int) -> DataFrame:
    """One row a document: doc_id, th (hash of its text), n_shingles, node (null: empty set), keys (also as bytes), sketch."""
    a, b = _constants(BANDS * ROWS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, 512):
                batch = whole.slice(lo, 512)
                n, node, keys, packed, sketch = [], [], [], [], []
                for t in batch.column(1):
                    s = shingle_set(t.as_py(), shingle)
                    n.append(len(s))
                    if not len(s):
                        node.append(None), keys.append(None), packed.append(None), sketch.append(None)
                        continue
                    node.append(node_of(s))
                    sig = signature(s, a, b)
                    keys.append(band_keys(sig))
                    packed.append(keys[-1].tobytes())
                    sketch.append(odd_sketch(sig))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(2), pa.array(n, pa.int64()), pa.array(node, pa.int64()),
                     pa.array(keys, pa.list_(pa.int64())), pa.array(packed, pa.binary()), pa.array(sketch, pa.binary())],
                    names=["doc_id", "th", "n_shingles", "node", "keys", "packed", "sketch"])

    return small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text", text_hash(F.col("text")).alias("th")).mapInArrow(
        run, "doc_id long, th long, n_shingles long, node long, keys array<long>, packed binary, sketch binary")


def _blocked(members: DataFrame, sizes: DataFrame, block: int) -> DataFrame:
    """Give each member of a large group to every block pair its block is in."""
    joined = members.join(sizes, "key")
    n = F.ceil(F.col("size") / block)
    mine = F.pmod(F.xxhash64("node", F.lit(11)), n)
    pairs = F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda x: F.least(x, mine) * n + F.greatest(x, mine))
    return joined.select("key", "node", F.explode(pairs).alias("part"))


def _runs_of(groups: DataFrame, facts: DataFrame) -> DataFrame:
    full = groups.join(facts, "node").repartition("key", "part")
    return full.sortWithinPartitions("key", "part", "node")


def _forest_pairs(groups: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """Distinct candidate pairs (a < b): a spanning forest of each group by estimate."""
    table, least = estimate_table(), threshold - SLACK

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a: list[int] = []
        b: list[int] = []
        for g in sorted_runs(batches, ["key", "part"], ("sketch",)):
            node = g["node"]
            if len(node) > 1:
                for i, j in spanning_forest(g["sketch"], g["n_shingles"], least, threshold, table):
                    a.append(min(node[i], node[j])), b.append(max(node[i], node[j]))
            if len(a) > 50_000:
                yield _pairs(a, b)
                a, b = [], []
        yield _pairs(a, b)

    return _runs_of(groups, nodes).mapInArrow(run, "a long, b long").distinct()


def _pairs(a: list[int], b: list[int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _open_members(groups: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """Members (key, part, node) whose sketch rules in some member of another component."""
    table, least = estimate_table(), threshold - SLACK

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in sorted_runs(batches, ["key", "part"], ("sketch",)):
            node, size, sk, comp = g["node"], g["n_shingles"], g["sketch"], g["component"]
            hit = np.zeros(len(node), bool)
            for i in range(len(node) - 1):
                est = table[np.bitwise_count(sk[i + 1:] ^ sk[i]).sum(axis=1, dtype=np.int64)]
                lo, hi = np.minimum(size[i + 1:], size[i]), np.maximum(size[i + 1:], size[i])
                near = (est >= least) & (comp[i + 1:] != comp[i]) & (lo >= threshold * hi)
                hit[i] |= near.any()
                hit[i + 1:] |= near
            if hit.any():
                yield pa.RecordBatch.from_arrays([pa.array(g[c][hit]) for c in ("key", "part", "node")], names=["key", "part", "node"])

    return _runs_of(groups, nodes).mapInArrow(run, "key long, part long, node long")


def links_across(sets: list[np.ndarray], keys: np.ndarray, key: int, comp: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between components, by exact intersections of all sets at once.

    A pair that shares an earlier band key than ``key`` is left to that band's group.
    """
    _, flat = np.unique(np.concatenate(sets), return_inverse=True)
    sizes = np.array([len(x) for x in sets])
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    mark = np.zeros(int(flat.max()) + 1, bool)
    band = int(np.flatnonzero(keys[0] == key)[0])
    comp = comp.copy()
    links = []
    for i in range(len(sets) - 1):
        own = flat[starts[i]:starts[i] + sizes[i]]
        mark[own] = True
        both = np.add.reduceat(mark[flat[starts[i + 1]:]], starts[i + 1:] - starts[i + 1], dtype=np.int64)
        mark[own] = False
        linked = (100 * both >= percent * (sizes[i + 1:] + sizes[i] - both)) & (comp[i + 1:] != comp[i])
        if band:
            linked &= ~(keys[i + 1:, :band] == keys[i, :band]).any(axis=1)
        for j in (np.flatnonzero(linked) + i + 1).tolist():
            if comp[j] != comp[i]:
                links.append((i, j))
                comp[comp == comp[j]] = comp[i]
    return links


def _links_between(members: DataFrame, facts: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between components among the groups' members; facts: node, n_shingles, component, set, keys."""
    size = members.join(facts.select("node", "n_shingles"), "node").groupBy("key", "part").agg(
        F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("shingles"))
    n = F.greatest(F.ceil(F.col("n") / BLOCK), F.ceil(F.col("shingles") / BLOCK_SHINGLES))
    mine = F.pmod(F.xxhash64("node", F.lit(13)), n)
    blocks = F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda x: F.least(x, mine) * n + F.greatest(x, mine))
    dealt = members.join(size, ["key", "part"]).select("key", "part", "node", F.explode(blocks).alias("block"))
    full = dealt.join(facts, "node").select("key", "part", "block", "node", "component", "set", "keys")
    full = full.repartition("key", "part", "block").sortWithinPartitions("key", "part", "block", "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in sorted_runs(batches, ["key", "part", "block"], ("keys",)):
            node = g["node"]
            if len(node) > 1:
                sets = [np.frombuffer(x, np.uint64) for x in g["set"].tolist()]
                links = links_across(sets, g["keys"].view(np.int64), int(g["key"][0]), g["component"], percent)
                if links:
                    yield _pairs([int(min(node[i], node[j])) for i, j in links], [int(max(node[i], node[j])) for i, j in links])

    return full.mapInArrow(run, "a long, b long").distinct()


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """node, text of one document of each wanted node; wanted: node, rep_id, th (both name the document)."""
    named = docs.select(null_id().alias("rep_id"), text_hash(F.col("text")).alias("th"), "text")
    return named.join(small(wanted), ["rep_id", "th"]).select("node", "text").dropDuplicates(["node"])


def _sets(texts: DataFrame, shingle: int) -> DataFrame:
    """node, set (its shingles) of the nodes of ``texts``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, 512):
                batch = whole.slice(lo, 512)
                got = [(n, x) for n, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True)
                       if node_of(x := shingle_set(t.as_py(), shingle)) == n]
                yield pa.RecordBatch.from_arrays([pa.array([n for n, _ in got], pa.int64()), pa.array([x.tobytes() for _, x in got], pa.binary())],
                                                 names=["node", "set"])

    return texts.mapInArrow(run, "node long, set binary")


def _confirmed(pairs: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Pairs whose full sets have 100 * intersection >= percent * union."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for k, (a, b, s, t) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3), strict=True)):
                x, y = shingle_set(s.as_py(), shingle), shingle_set(t.as_py(), shingle)
                both = len(np.intersect1d(x, y, assume_unique=True))
                # texts were found by id and hash; the digests say that they are the nodes' own
                if 100 * both >= percent * (len(x) + len(y) - both) and node_of(x) == a and node_of(y) == b:
                    keep.append(k)
            yield pa.RecordBatch.from_arrays([c.take(pa.array(keep, pa.int64())) for c in batch.columns[:2]], names=["a", "b"])

    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, th, n_shingles, node, component_id, kept for every row of ``docs``."""
    threshold = percent / 100
    prof = stored(profile(docs, shingle))
    some = prof.filter(F.col("node").isNotNull())
    nodes = stored(some.groupBy("node").agg(
        F.min(F.struct(null_id().alias("rep_id"), "th")).alias("rep"), F.first("n_shingles").alias("n_shingles"),
        F.first("keys").alias("keys"), F.first("packed").alias("packed"), F.first("sketch").alias("sketch")))
    banded = nodes.select(F.explode("keys").alias("key"), "node")
    sizes = banded.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    groups = stored(_blocked(banded, sizes, BLOCK))
    facts = nodes.select("node", "n_shingles", "sketch")

    def confirm(pairs: DataFrame) -> DataFrame:
        involved = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
        reps = stored(involved.join(nodes.select("node", "rep.*"), "node"))
        return stored(_confirmed(pairs, _texts(docs, reps), shingle, percent))

    first = stored(_forest_pairs(groups, facts, threshold))
    links = confirm(first)
    comp = connected_components(links)
    labelled = facts.join(comp, "node", "left").withColumn("component", F.coalesce("component", "node"))
    split = groups.join(labelled.select("node", "component"), "node").groupBy("key", "part").agg(
        F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo < hi").select("key", "part")
    members = stored(_open_members(groups.join(split, ["key", "part"]), labelled, threshold))
    if not members.isEmpty():
        wanted = stored(members.select("node").distinct().join(nodes.select("node", "rep.*"), "node"))
        sets = _sets(_texts(docs, wanted), shingle)
        more = labelled.select("node", "n_shingles", "component").join(sets, "node").join(
            nodes.select("node", F.col("packed").alias("keys")), "node")
        comp = connected_components(links.union(_links_between(members, stored(more), percent)))
    label = prof.select("doc_id", "th", "n_shingles", "node").join(comp, "node", "left").withColumn(
        "component", F.coalesce("component", "node"))
    low = label.filter("node is not null").groupBy("component").agg(F.min("doc_id").alias("low"))
    out = label.join(low, "component", "left")
    cid = F.coalesce("low", "doc_id")
    return out.select("doc_id", "th", "n_shingles", "node", cid.alias("component_id"), cid.eqNullSafe(F.col("doc_id")).alias("kept"))


def drop_near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """One row of ``docs`` for each group, all columns kept; rows without a word stay.

    The row is the one that names the group (smallest doc_id); of rows equal in
    id and shingles, and of rows of one group that share that id, one stays.
    """
    found = near_duplicates(docs, shingle, percent).filter("node is not null")
    same = found.groupBy("component_id", "doc_id", "th").agg(F.count(F.lit(1)).alias("n"))
    best = same.groupBy("component_id").agg(F.min(F.struct(null_id().alias("id"), "th", "n")).alias("k"))
    keep = small(stored(best.select("k.id", "k.th", "k.n"))).alias("k")
    wordless = ~F.coalesce(F.col("text").rlike(WORD), F.lit(False))
    on = (F.coalesce(F.col("d.doc_id"), F.lit(-(2**63))) == F.col("k.id")) & (text_hash(F.col("d.text")) == F.col("k.th"))
    name = fresh(docs, "rows")
    picked = docs.filter(~wordless).alias("d").join(keep, on).select(*[F.col(f"d.`{c}`") for c in docs.columns], F.col("k.n").alias(name))
    # equal rows: one of them stays
    once = picked.filter(F.col(name) == 1)
    several = picked.filter(F.col(name) > 1).dropDuplicates(["doc_id", "text"])
    return docs.filter(wordless).unionByName(once.unionByName(several).drop(name))

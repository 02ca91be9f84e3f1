"""Best-fit packing by a grouping genetic algorithm on islands.

Documents become token ids and an end id; those longer than a sequence are cut
into full pieces, the first of which may be shorter. Full pieces are sequences
of their own. The others are dealt by hash into shards of bounded size; on
each shard several islands evolve packings. Crossover injects whole well-filled
bins of one parent into the other, removes the bins this duplicates and places
the displaced pieces best-fit; between epochs every island's elite migrates to
the next island of the shard. Bins that stay badly filled are opened again and
their pieces dealt into fewer shards, so no shard's remainder stays behind.

Only piece lengths move in all this; texts are read once.

Defined cases: null text is empty (one piece, the end id); repeated rows are
packed as rows of their own; a null doc_id stays null; equal lengths are
interchangeable; other columns are not looked at.
"""

from __future__ import annotations

import base64
import math
import random
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockbook.llm.common import small_batches, stored

CAPACITY = 2048
SHARD = 1500
ISLANDS, EPOCHS, GENERATIONS, POPULATION = 3, 2, 3, 4
#: A bin filled to this share is kept; others are packed again with those of other shards.
WELL_FILLED = 0.995
LEVELS = 4


def load_encoding(path: str | None = None):
    """The vocabulary as a byte-level encoder (same ids as the JSON file of the same name)."""
    import public_tokenizers
    import tiktoken

    with open(path or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("byte_bpe_50k", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                             special_tokens={"<|endoftext|>": 50256})


def cut(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces; only the first may be short."""
    first = (length - 1) % capacity + 1
    return [(0, first), *((s, capacity) for s in range(first, length, capacity))]


def tokenized(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, with_ids: bool = True) -> DataFrame:
    """One row a piece: doc_id, piece, start, length, ids_crc32 and, if wanted, its ids."""
    cols = ["doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = load_encoding(path)
        for whole in batches:
            for lo in range(0, whole.num_rows, 512):
                batch = whole.slice(lo, 512)
                out: dict[str, list] = {c: [] for c in cols}
                for doc, t in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    ids = np.array([*enc.encode(t.as_py() or "", allowed_special="all"), 0], dtype="<u4")
                    for k, (s, n) in enumerate(cut(len(ids), capacity)):
                        part = ids[s:s + n]
                        row = (doc, k, s, n, zlib.crc32(part.tobytes()), part.astype(np.int32))
                        for c, v in zip(cols, row, strict=False):
                            out[c].append(v)
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
                yield pa.RecordBatch.from_arrays([pa.array(out[c], k) for c, k in zip(cols, kinds, strict=False)], names=cols)

    return small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids)


# ------------------------------------------------------------ the genetic algorithm, on one shard

Packing = list[list[int]]


def best_fit(packing: Packing, items: list[int], lens: list[int], capacity: int) -> Packing:
    """Place ``items``, longest first, where they leave the least room."""
    room = [capacity - sum(lens[i] for i in b) for b in packing]
    free = sorted((r, k) for k, r in enumerate(room) if r)
    for i in sorted(items, key=lambda i: -lens[i]):
        at = bisect_left(free, (lens[i], -1))
        if at == len(free):
            packing.append([i])
            left, k = capacity - lens[i], len(packing) - 1
        else:
            r, k = free.pop(at)
            packing[k].append(i)
            left = r - lens[i]
        if left:
            insort(free, (left, k))
    return packing


def fitness(packing: Packing, lens: list[int], capacity: int) -> tuple[int, float]:
    """Fewer bins first, then fuller ones (the mean of squared fills)."""
    return -len(packing), sum((sum(lens[i] for i in b) / capacity) ** 2 for b in packing) / max(1, len(packing))


def crossover(a: Packing, b: Packing, lens: list[int], capacity: int, rng: random.Random) -> Packing:
    """Well-filled bins of ``b`` go whole into ``a``; what they duplicate goes, what that displaces is best-fitted."""
    ranked = sorted(b, key=lambda x: -sum(lens[i] for i in x))
    half = ranked[: max(1, len(ranked) // 2)]
    given = rng.sample(half, max(1, len(half) // 2))
    have = {i for x in given for i in x}
    kept, displaced = [list(x) for x in given], []
    for x in a:
        if have.isdisjoint(x):
            kept.append(list(x))
        else:
            displaced += [i for i in x if i not in have]
    return best_fit(kept, displaced, lens, capacity)


def mutate(a: Packing, lens: list[int], capacity: int, rng: random.Random) -> Packing:
    """Open the emptiest bins and a few others."""
    order = sorted(range(len(a)), key=lambda k: sum(lens[i] for i in a[k]))
    opened = set(order[:3]) | set(rng.sample(range(len(a)), min(len(a), 3 + len(a) // 50)))
    loose = [i for k in opened for i in a[k]]
    rng.shuffle(loose)
    return best_fit([list(x) for k, x in enumerate(a) if k not in opened], loose, lens, capacity)


def evolve(lens: list[int], capacity: int, seeds: list[Packing], rng: random.Random, generations: int, population: int) -> list[Packing]:
    """A few generations from ``seeds``; the population, best first."""
    bound = math.ceil(sum(lens) / capacity)
    score = lambda p: fitness(p, lens, capacity)
    pool = [[list(b) for b in p] for p in seeds]
    if not pool:
        pool.append(best_fit([], list(range(len(lens))), lens, capacity))
    while len(pool) < population and len(pool[0]) > bound:
        jitter = [i for _, i in sorted((-n * rng.uniform(0.8, 1), i) for i, n in enumerate(lens))]
        part = jitter[: len(jitter) // 2]
        first = best_fit([], part, lens, capacity)
        pool.append(best_fit(first, jitter[len(part):], lens, capacity))
    pool.sort(key=score, reverse=True)
    for _ in range(generations):
        if len(pool[0]) <= bound:
            break
        mother, father = pool[0], rng.choice(pool[1:])
        pool += [crossover(mother, father, lens, capacity, rng), crossover(father, mother, lens, capacity, rng),
                 mutate(mother, lens, capacity, rng)]
        pool = sorted(pool, key=score, reverse=True)[:population]
    return pool


def _flat(p: Packing, n: int) -> list[int]:
    out = [0] * n
    for k, b in enumerate(p):
        for i in b:
            out[i] = k
    return out


def _bins(flat: list[int]) -> Packing:
    out: Packing = [[] for _ in range(max(flat, default=-1) + 1)]
    for i, k in enumerate(flat):
        out[k].append(i)
    return [b for b in out if b]


def _epoch(islands: DataFrame, epoch: int, capacity: int, generations: int, population: int) -> DataFrame:
    """(shard, island, items, lens, elites) -> the same with new elites: array<array<int>>, best first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            new = []
            for r in batch.to_pylist():
                rng = random.Random(r["shard"] * 1009 + r["island"] * 31 + epoch)
                pool = evolve(r["lens"], capacity, [_bins(e) for e in r["elites"] or []], rng, generations, population)
                new.append([_flat(p, len(r["lens"])) for p in pool[:2]])
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(new, pa.list_(pa.list_(pa.int32())))], names=batch.schema.names)

    return islands.select("shard", "island", "items", "lens", "elites").mapInArrow(
        run, "shard long, island int, items array<long>, lens array<int>, elites array<array<int>>")


def _pack_shards(items: DataFrame, shards: int, level: int, capacity: int) -> DataFrame:
    """(item, length) -> (item, length, shard, bin, offset, fill), by islands on each shard."""
    shard = F.pmod(F.xxhash64("item", F.lit(level)), F.lit(shards)).alias("shard")
    grouped = items.select(shard, F.struct("length", "item").alias("x")).groupBy("shard").agg(F.sort_array(F.collect_list("x")).alias("x"))
    state = grouped.select("shard", F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("island"),
                           F.col("x.item").alias("items"), F.col("x.length").cast("array<int>").alias("lens"),
                           F.lit(None).cast("array<array<int>>").alias("elites")).repartition("shard", "island")
    for epoch in range(EPOCHS):
        done = stored(_epoch(state, epoch, capacity, GENERATIONS, POPULATION))
        # the elite of an island joins the next one's
        away = done.select("shard", ((F.col("island") + 1) % ISLANDS).alias("island"), F.slice("elites", 1, 1).alias("guest"))
        state = done.join(away, ["shard", "island"]).withColumn("elites", F.concat("elites", "guest"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                rows = []
                for k, b in enumerate(_bins(r["best"])):
                    at, fill = 0, sum(r["lens"][i] for i in b)
                    for i in b:
                        rows.append((r["items"][i], r["lens"][i], r["shard"], k, at, fill))
                        at += r["lens"][i]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)],
                                                 names=["item", "length", "shard", "bin", "offset", "fill"])

    n_bins = F.size(F.array_distinct(F.get("elites", F.lit(0))))
    best = done.groupBy("shard").agg(F.min_by(F.struct("items", "lens", F.get("elites", F.lit(0)).alias("best")),
                                              F.struct(n_bins, "island")).alias("b"))
    return best.select("shard", "b.items", "b.lens", "b.best").mapInArrow(
        place, "item long, length long, shard long, bin long, offset long, fill long")


def pack_items(items: DataFrame, capacity: int = CAPACITY, shard_items: int = SHARD) -> DataFrame:
    """(item, length) with unique items -> (item, sequence_id, offset)."""
    parts = []
    whole = items.filter(F.col("length") >= capacity)
    parts.append(whole.select("item", (-F.col("item") - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset")))
    rest = items.filter(F.col("length") < capacity).select("item", "length")
    count = rest.count()
    first_id = 0
    for level in range(LEVELS):
        if not count:
            break
        shards = math.ceil(count / shard_items)
        placed = stored(_pack_shards(rest, shards, level, capacity))
        last = shards == 1 or level == LEVELS - 1
        good = placed if last else placed.filter(F.col("fill") >= WELL_FILLED * capacity)
        parts.append(good.select("item", (F.lit(first_id) + F.col("shard") * (1 << 20) + F.col("bin")).alias("sequence_id"), "offset"))
        if last:
            break
        rest = placed.filter(F.col("fill") < WELL_FILLED * capacity).select("item", "length")
        count = rest.count()
        first_id += shards << 20
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def pack_documents(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, with_ids: bool = True) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, (ids,) sequence_id, offset: one row a piece."""
    pieces = stored(tokenized(docs, path, capacity, with_ids).withColumn("item", F.monotonically_increasing_id()))
    placed = pack_items(pieces.select("item", "length"), capacity)
    return pieces.join(placed, "item").drop("item")

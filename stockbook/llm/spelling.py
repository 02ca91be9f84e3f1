"""Spelling variant grouping: k-d trees over letter-count vectors.

Words are counted over whole texts (one run in 97, told by a checksum, loses a code
point, which plants misspellings). A word's letter counts are written in unary, a
bit for "at least k of this letter", in two 64-bit words, so that the L1 distance
of two count vectors is the number of differing bits, a plane ``count <= k`` of a k-d
tree is a bit, and the box of a node is the AND and the OR of its members. Letters
beyond the bits share or end their counts, which can only shrink a distance. One
edit changes the counts by one (insertion, deletion) or two (replacement), so the
near words of a word lie in its own length and the one below, within 2 and 1.

* Top tree: fitted for each length on a bounded sample of the words (``SAMPLE``), all
  words are indexed. Each leaf is a cell. A word is a point of one cell and a query
  of every cell whose box is within reach. Cells over ``CELL`` points and query sets
  over ``QUERIES`` are dealt as a grid of blocks by a hash, so that no task holds a
  larger block, however many words share their letters.
* In a block both sides get a k-d tree of their own; pairs of nodes whose boxes are
  too far apart are pruned level by level, what stays is compared vector by vector,
  and letter order decides. A block sends on one row a word: its number of near
  words and the most frequent one, not the pairs.

A word's form is its near word of largest count if that is at least twice its own.
Counts at least double along forms, so they end; roots come by pointer jumping.

Defined cases: null and empty texts have no words; a null doc_id counts as the
empty string in the checksum; repeated rows each count; ties go to the smallest word in
code-point order; words of 64 code points and more share one set of cells, weighed
by length; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockbook.llm.common import sorted_runs, stored

RUN = r"[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DAMAGE = 97
MIN_LENGTH, MIN_COUNT = 5, 3
#: Words of this length and more are one group of cells.
LONG = 64
#: Words that the top trees are fitted on, about, and how many of them a leaf may hold for each cell's points.
SAMPLE = 1 << 17
CELL = 1 << 14
QUERIES = 1 << 16
#: Vectors in a leaf of the trees inside a block.
LEAF = 16
PLAIN_BITS, OTHER_BITS = 4, 2  # 26 letters x 4 and 12 groups of the others x 2: 128 bits


def counted_words(docs: DataFrame) -> DataFrame:
    """word, n: the words of at least 5 code points and 3 occurrences."""
    low = F.translate(F.col("run"), UPPER, LOWER)
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(RUN), F.lit(0))).alias("run")).filter(
        F.length("run") >= MIN_LENGTH)
    h = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("low")).cast("binary"))
    named = runs.select("doc_id", low.alias("low")).withColumn("h", h)
    at = (F.col("h") % F.length("low")).cast("int")
    cut = F.concat(F.substring("low", F.lit(1), at), F.substring("low", at + 2, F.length("low")))
    word = F.when(F.col("h") % DAMAGE == 0, cut).otherwise(F.col("low"))
    return named.select(word.alias("word")).filter(F.length("word") >= MIN_LENGTH).groupBy("word").agg(
        F.count(F.lit(1)).alias("n")).filter(F.col("n") >= MIN_COUNT)


# ------------------------------------------------------------ vectors and trees


def letter_bits(words: list[str]) -> np.ndarray:
    """Letter counts in unary: (n, 2) uint64."""
    out = np.zeros((len(words), 2), np.uint64)
    if not words:
        return out
    raw = [w.encode("latin-1") for w in words]
    flat = np.frombuffer(b"".join(raw), np.uint8).astype(np.int64)
    row = np.repeat(np.arange(len(raw)), [len(r) for r in raw])
    plain = (flat >= 97) & (flat <= 122)
    letter = np.where(plain, flat - 97, 26 + flat % 12)
    counts = np.bincount(row * 38 + letter, minlength=38 * len(raw)).reshape(-1, 38)
    bit = 0
    for k in range(38):
        for least in range(1, (PLAIN_BITS if k < 26 else OTHER_BITS) + 1):
            out[:, bit // 64] |= (counts[:, k] >= least).astype(np.uint64) << np.uint64(bit % 64)
            bit += 1
    return out


def _set(bits: np.ndarray, bit: int) -> np.ndarray:
    return (bits[:, bit // 64] >> np.uint64(bit % 64)) & np.uint64(1) == 1


def _plane(bits: np.ndarray) -> int | None:
    """The bit that parts the vectors most evenly; None if all are equal."""
    n = len(bits)
    share = np.unpackbits(np.ascontiguousarray(bits).view(np.uint8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    best = int(np.argmin(np.abs(2 * share - n)))
    return best if 0 < share[best] < n else None


@dataclass
class TopTree:
    """Planes of one length group; leaves are numbered as made."""

    planes: list[tuple[int, int, int]] = field(default_factory=list)  # bit, child without, child with; leaf: -1, number, 0
    leaves: int = 0

    @classmethod
    def fit(cls, bits: np.ndarray, leaf: int) -> TopTree:
        tree = cls()

        def grow(part: np.ndarray) -> int:
            at = len(tree.planes)
            bit = _plane(part) if len(part) > leaf else None
            tree.planes.append((-1, tree.leaves, 0))
            if bit is None:
                tree.leaves += 1
                return at
            side = _set(part, bit)
            tree.planes[at] = (bit, grow(part[~side]), grow(part[side]))
            return at

        grow(bits)
        return tree

    def cells(self, bits: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) of every leaf whose box may lie within ``reach`` of the row's vector."""
        rows: list = []
        leaf: list = []
        todo = [(0, np.arange(len(bits)), np.zeros(len(bits), np.int8))]
        while todo:
            at, idx, far = todo.pop()
            if not len(idx):
                continue
            bit, without, with_ = self.planes[at]
            if bit < 0:
                rows.append(idx)
                leaf.append(np.full(len(idx), without))
                continue
            side = _set(bits[idx], bit)
            for child, off in ((without, side), (with_, ~side)):
                d = far + off
                near = d <= reach
                todo.append((child, idx[near], d[near]))
        return np.concatenate(rows or [np.zeros(0, np.int64)]), np.concatenate(leaf or [np.zeros(0, np.int64)])


@dataclass
class _Tree:
    """A k-d tree of a block: nodes in levels; ``lo``/``hi`` are the boxes."""

    order: np.ndarray
    start: np.ndarray
    stop: np.ndarray
    child: np.ndarray  # first of two children, -1 in a leaf
    lo: np.ndarray
    hi: np.ndarray

    @classmethod
    def build(cls, bits: np.ndarray) -> _Tree:
        order = np.arange(len(bits))
        start, stop, child = [0], [len(bits)], [-1]
        at = 0
        while at < len(start):
            a, b = start[at], stop[at]
            part = bits[order[a:b]]
            bit = _plane(part) if b - a > LEAF else None
            if bit is not None:
                side = _set(part, bit)
                order[a:b] = np.concatenate([order[a:b][~side], order[a:b][side]])
                cut = a + int((~side).sum())
                child[at] = len(start)
                start += [a, cut]
                stop += [cut, b]
                child += [-1, -1]
            at += 1
        s, e = np.array(start), np.array(stop)
        sorted_bits = bits[order]
        lo = np.stack([np.bitwise_and.reduce(sorted_bits[a:b], axis=0) for a, b in zip(s, e, strict=True)])
        hi = np.stack([np.bitwise_or.reduce(sorted_bits[a:b], axis=0) for a, b in zip(s, e, strict=True)])
        return cls(order, s, e, np.array(child), lo, hi)


def _ones(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x).sum(axis=-1, dtype=np.int64)


def _within(a: np.ndarray, b: np.ndarray, reach: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Chunks of (row of ``a``, row of ``b``) whose vectors differ in at most ``reach`` bits."""
    ta, tb = _Tree.build(a), _Tree.build(b)
    i, j = np.zeros(1, np.int64), np.zeros(1, np.int64)
    final: list = []
    while len(i):
        near = _ones(ta.lo[i] & ~tb.hi[j]) + _ones(tb.lo[j] & ~ta.hi[i]) <= reach
        i, j = i[near], j[near]
        la, lb = ta.child[i] < 0, tb.child[j] < 0
        final.append((i[la & lb], j[la & lb]))
        # open the larger node of a pair
        wide = ~la & (lb | (ta.stop[i] - ta.start[i] >= tb.stop[j] - tb.start[j]))
        tall = ~wide & ~lb
        i, j = (np.concatenate([ta.child[i[wide]], ta.child[i[wide]] + 1, i[tall], i[tall]]),
                np.concatenate([j[wide], j[wide], tb.child[j[tall]], tb.child[j[tall]] + 1]))
    i, j = (np.concatenate(x) for x in zip(*final, strict=True))
    na, nb = ta.stop[i] - ta.start[i], tb.stop[j] - tb.start[j]
    size = np.cumsum(na * nb)
    lo = 0
    while lo < len(i):
        hi = max(lo + 1, int(np.searchsorted(size, (size[lo - 1] if lo else 0) + 4_000_000, "right")))
        n, m = na[lo:hi], nb[lo:hi]
        pair = np.repeat(np.arange(hi - lo), n * m)
        k = np.arange(len(pair)) - np.repeat(np.cumsum(n * m) - n * m, n * m)
        x = ta.order[ta.start[i[lo:hi]][pair] + k // m[pair]]
        y = tb.order[tb.start[j[lo:hi]][pair] + k % m[pair]]
        near = _ones(a[x] ^ b[y]) <= reach
        yield x[near], y[near]
        lo = hi


def one_edit(a: str, b: str) -> bool:
    """Do the words differ by exactly one inserted, deleted or replaced code point?"""
    if len(a) < len(b):
        a, b = b, a
    if len(a) - len(b) > 1 or a == b:
        return False
    lo, hi = 0, len(b)  # common prefix, by halves
    while lo < hi:
        mid = (lo + hi + 1) // 2
        lo, hi = (mid, hi) if a[lo:mid] == b[lo:mid] else (lo, mid - 1)
    return a[lo + 1:] == b[lo + (len(a) == len(b)):]


def _edits(a: np.ndarray, b: np.ndarray, width: int, same: bool) -> np.ndarray:
    """Which rows of byte matrices (``a`` of ``width`` letters, ``b`` of as many or one less) are one edit apart."""
    if same:
        return (a[:, :width] != b[:, :width]).sum(axis=1) == 1
    head = a[:, :width - 1] == b[:, :width - 1]
    tail = a[:, 1:width] == b[:, :width - 1]
    prefix = np.logical_and.accumulate(head, axis=1).sum(axis=1)
    suffix = np.logical_and.accumulate(tail[:, ::-1], axis=1).sum(axis=1)
    return prefix + suffix >= width - 1


def near_words(points: list[str], queries: list[str], group: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Chunks of (query, point) one edit apart: points of the group; queries as long or one longer.

    Points one longer than a query are left to the run in which the roles are changed.
    """
    pb, qb = letter_bits(points), letter_bits(queries)
    lengths = np.array([len(q) for q in queries])
    if group >= LONG:
        for x, y in _within(qb, pb, 2):
            ok = np.array([len(queries[i]) >= len(points[j]) and one_edit(queries[i], points[j]) for i, j in zip(x, y, strict=True)], bool)
            yield x[ok], y[ok]
        # the longest plain words meet the shortest long ones in the plain group's run
        return
    pm = np.array([w.encode("latin-1") for w in points], f"S{group}").view(np.uint8).reshape(-1, group)
    for same in (True, False):
        some = np.flatnonzero(lengths == group + (not same))
        if not len(some) or not len(points):
            continue
        width = group + (not same)
        qm = np.array([queries[k].encode("latin-1") for k in some], f"S{width}").view(np.uint8).reshape(-1, width)
        for x, y in _within(qb[some], pb, 2 if same else 1):
            ok = _edits(qm[x], pm[y], width, same)
            yield some[x[ok]], y[ok]


def block_best(points: list[str], pn: np.ndarray, queries: list[str], qn: np.ndarray, group: int) -> list[tuple]:
    """(word, near words, count and word of the most frequent) of one block."""
    names = sorted({*points, *queries})
    rank = {w: k for k, w in enumerate(names)}
    pr, qr = (np.array([rank[w] for w in x], np.int64) for x in (points, queries))
    plen, qlen = (np.array([len(w) for w in x], np.int64) for x in (points, queries))
    found = np.zeros(len(names), np.int64)
    most = np.zeros(len(names), np.int64)
    best = np.full(len(names), -1, np.int64)

    def credit(word: np.ndarray, other: np.ndarray, n: np.ndarray) -> None:
        if not len(word):
            return
        np.add.at(found, word, 1)
        first = np.lexsort((other, -n, word))
        w, o, c = word[first], other[first], n[first]
        head = np.flatnonzero(np.r_[True, w[1:] != w[:-1]])
        w, o, c = w[head], o[head], c[head]
        better = (c > most[w]) | ((c == most[w]) & (o < best[w]))
        most[w[better]], best[w[better]] = c[better], o[better]

    for x, y in near_words(points, queries, group):
        credit(qr[x], pr[y], pn[y])
        cross = qlen[x] > plen[y]
        credit(pr[y[cross]], qr[x[cross]], qn[x[cross]])
    return [(names[k], int(found[k]), int(most[k]), names[best[k]]) for k in np.flatnonzero(found)]


# ------------------------------------------------------------ Spark side


@dataclass
class Plan:
    """Top trees by length group and, for each cell, into how many blocks points and queries are dealt."""

    trees: dict[int, TopTree]
    blocks: dict[tuple[int, int], tuple[int, int]] = field(default_factory=dict)

    def tree(self, group: int) -> TopTree:
        return self.trees.get(group) or TopTree([(-1, 0, 0)], 1)

    def routes(self, words: list[str]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(group, role, row, leaf); role 0: point, 1: query."""
        groups = np.array([min(len(w), LONG) for w in words])
        bits = letter_bits(words)
        lengths = np.array([len(w) for w in words])
        for g in np.unique(groups):
            own = np.flatnonzero(groups == g)
            tree = self.tree(int(g))
            for role, reach in ((0, 0), (1, 2)):
                row, leaf = tree.cells(bits[own], reach)
                yield int(g), role, own[row], leaf
            below = np.flatnonzero(lengths == g) if g <= LONG else own[:0]
            if g > MIN_LENGTH:
                row, leaf = self.tree(int(g) - 1).cells(bits[below], 1)
                yield int(g) - 1, 1, below[row], leaf


def _load(plan: Plan, words: DataFrame) -> DataFrame:
    """group, leaf, role -> weight of words that go there."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict = {}
        for batch in batches:
            names = batch.column(0).to_pylist()
            weight = np.array([1 + len(w) // LONG for w in names], np.int64)
            for g, role, row, leaf in plan.routes(names) if names else ():
                sums = np.bincount(leaf, weight[row])
                for k in np.flatnonzero(sums):
                    total[g, int(k), role] = total.get((g, int(k), role), 0) + int(sums[k])
        yield pa.RecordBatch.from_arrays(
            [*(pa.array([k[c] for k in total], pa.int64()) for c in range(3)), pa.array(list(total.values()), pa.int64())],
            names=["g", "leaf", "role", "weight"])

    return words.select("word").mapInArrow(run, "g long, leaf long, role long, weight long").groupBy("g", "leaf", "role").agg(
        F.sum("weight").alias("weight"))


def fit_plan(words: DataFrame, sample: int = SAMPLE, cell: int = CELL) -> Plan:
    """Top trees from about ``sample`` words; the loads of all words decide the blocks."""
    n = words.count()
    share = 1 << 30
    some = words if n <= sample else words.filter(F.pmod(F.xxhash64("word"), F.lit(share)) < share * sample // n)
    by: dict[int, list[str]] = {}
    for r in some.select("word").collect():
        by.setdefault(min(len(r.word), LONG), []).append(r.word)
    leaf = max(64, cell * min(n, sample) // (2 * max(n, 1)))
    plan = Plan({g: TopTree.fit(letter_bits(ws), leaf) for g, ws in by.items()})
    for r in _load(plan, words).collect():
        p, q = plan.blocks.get((r.g, r.leaf), (1, 1))
        plan.blocks[r.g, r.leaf] = (-(-r.weight // cell), q) if r.role == 0 else (p, -(-r.weight // (QUERIES * cell // CELL or 1)))
    return plan


def near_summary(words: DataFrame, plan: Plan) -> DataFrame:
    """word, n_near, best (struct<low, word>: minus the largest count, its smallest word) of words that have near words."""
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, 4096):
                batch = whole.slice(lo, 4096)
                names = batch.column(0).to_pylist()
                n = batch.column(1).to_numpy(zero_copy_only=False)
                h = batch.column(2).to_numpy(zero_copy_only=False)
                rows: list = []
                for g, role, row, leaf in plan.routes(names) if names else ():
                    p, q = np.array([plan.blocks.get((g, int(k)), (1, 1)) for k in leaf], np.int64).reshape(-1, 2).T
                    mine, copies = ((h[row] % p) * q, q) if role == 0 else (h[row] % q, p)
                    step = 1 if role == 0 else q
                    at = np.repeat(np.arange(len(row)), copies)
                    turn = np.arange(len(at)) - np.repeat(np.cumsum(copies) - copies, copies)
                    block = mine[at] + turn * (step if role == 0 else step[at])
                    rows.append((np.full(len(at), g), leaf[at], block, np.full(len(at), role), row[at]))
                if not rows:
                    continue
                g, leaf, block, role, row = (np.concatenate(x).astype(np.int64) for x in zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(x) for x in (g, leaf, block, role)), batch.column(0).take(pa.array(row)), pa.array(n[row])],
                    names=["g", "leaf", "block", "role", "word", "n"])

    keys = ["g", "leaf", "block"]
    dealt = words.select("word", "n", F.pmod(F.xxhash64("word"), F.lit(1 << 40)).alias("h")).mapInArrow(
        deal, "g long, leaf long, block long, role long, word string, n long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in sorted_runs(batches, keys):
            side = r["role"] == 1
            out = block_best(r["word"][~side].tolist(), r["n"][~side], r["word"][side].tolist(), r["n"][side], int(r["g"][0]))
            cols = list(zip(*out, strict=True)) if out else [(), (), (), ()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.string())],
                names=["word", "n_near", "n", "best"])

    got = dealt.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, "word string, n_near long, n long, best string")
    return got.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("n")).alias("low"), F.col("best").alias("word"))).alias("best"))


def _roots(forms: DataFrame) -> DataFrame:
    """word, root from (word, form): pointer jumping, the number of rounds is the logarithm of the longest chain."""
    now = stored(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = now.select(F.col("word").alias("of"), F.col("root").alias("next"))
        after = stored(now.join(ahead, F.col("root") == F.col("of"), "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        now = after.select("word", "root")
        if after.filter("moved").isEmpty():
            return now


def group_spellings(docs: DataFrame, sample: int = SAMPLE, cell: int = CELL) -> DataFrame:
    """word, form, root, n, n_near, form_n for every counted word of ``docs``."""
    words = stored(counted_words(docs))
    near = near_summary(words, fit_plan(words, sample, cell))
    n_best = -F.col("best.low")
    formed = n_best >= 2 * F.col("n")
    table = stored(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(formed, F.col("best.word")).alias("form"), F.when(formed, n_best).alias("form_n")))
    roots = _roots(table.filter("form is not null").select("word", "form"))
    return table.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")

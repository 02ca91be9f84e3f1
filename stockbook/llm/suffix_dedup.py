"""Removal of long repeated byte strings through suffix arrays.

A byte goes if a 100-byte string that also starts earlier covers it. To bring
equal strings of different documents together without sorting the corpus, each
100-byte window is keyed by its *minimizer*: the least hash among its 32-byte
grams, leftmost on ties. Equal windows have equal minimizers at equal offsets.
The windows that share one minimizer place are a *chunk*, about 35 windows and
135 bytes. Then:

1. Minimizers that occur once are dropped: a grouped count finds the others,
   and a bitmap of fixed size keeps most once-only places out of the shuffle.
2. Byte-identical chunks of one minimizer collapse to the earliest; the later
   ones are repeats as a whole.
3. The distinct chunks of one minimizer are laid side by side, and their suffix
   array (``suffix_array``: linear grouping) orders all suffixes. Neighbours
   with a common prefix of 100 bytes form intervals; the earliest place of an
   interval stays, the others are repeats.

A minimizer with very many distinct chunks is dealt into parts of bounded size;
each part's windows that are first there are then dealt anew by their content,
so the second pass sees every window's first places together and no task holds
the group.

Defined cases: null text is empty; texts under 100 bytes lose nothing; a null
doc_id counts as the smallest; documents with equal ids are ordered by a hash
of their text, and rows equal in id and text share one result; other columns
are not looked at. Very long texts are cut into overlapping stretches for the
scan only. Minimizers, chunks and the texts of one id are told apart by 64-bit
hashes each.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockbook.llm.common import BROADCAST_ROWS, null_id, small_batches, sorted_runs, stored_table
from stockbook.llm.suffix_array import suffix_array

LENGTH, GRAM = 100, 32
STRETCH = 1 << 18
#: Distinct chunks of one minimizer that one task may hold.
PART = 16384
BLOCK_BYTES = 1 << 16
#: Bits of the bitmap that repeated minimizers set; fixed, whatever the input.
FILTER_BITS = 25
_BASE = 0x9E3779B97F4A7C15


def _mix(h: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xC2B2AE3D27D4EB4F)
        return h ^ (h >> np.uint64(32))


_SYMBOLS = _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Mixed 64-bit hashes of all GRAM-byte strings (GRAM a power of two), by doubling."""
    h = _SYMBOLS[data]
    width, factor = 1, _BASE
    with np.errstate(over="ignore"):
        while width < GRAM:
            h = h[:-width] * np.uint64(factor) + h[width:]
            factor = factor * factor % 2**64
            width *= 2
    return _mix(h)


def minimizer_places(h: np.ndarray) -> np.ndarray:
    """For each window start the place of its minimizer."""
    wide = LENGTH - GRAM + 1
    bits = np.uint64(31)
    v = (h >> bits << bits) | np.arange(len(h), dtype=np.uint64)
    width = 1
    while width * 2 <= wide:
        v = np.minimum(v[:-width], v[width:])
        width *= 2
    rest = wide - width
    v = np.minimum(v[:-rest], v[rest:]) if rest else v
    return (v & np.uint64((1 << 31) - 1)).astype(np.int64)


def chunks_of(texts: list[bytes]) -> dict[str, np.ndarray]:
    """All chunks of several texts: row (index of the text), lo, n (windows less one), m, c (hash of the bytes)."""
    units = [(k, a) for k, t in enumerate(texts) for a in range(0, max(0, len(t) - LENGTH + 1), STRETCH)]
    parts = []
    at = 0
    while at < len(units):
        data, bounds, size = [], [], 0
        while at < len(units) and (not size or size < STRETCH):
            k, a = units[at]
            piece = texts[k][a:a + STRETCH + LENGTH - 1]
            bounds.append((size, len(piece), k, a))
            data.append(piece)
            size += len(piece)
            at += 1
        parts.append(_chunks(np.frombuffer(b"".join(data), np.uint8), np.array(bounds, np.int64)))
    if not parts:
        return {x: np.zeros(0, np.int64) for x in ("row", "lo", "n", "m", "c")}
    return {x: np.concatenate([p[x] for p in parts]) for x in parts[0]}


def _chunks(data: np.ndarray, bounds: np.ndarray) -> dict[str, np.ndarray]:
    h = gram_hashes(data)
    place = minimizer_places(h)
    unit = np.repeat(np.arange(len(bounds)), bounds[:, 1])[: len(place)]
    start = np.arange(len(place))
    fine = start + LENGTH <= (bounds[:, 0] + bounds[:, 1])[unit]
    start, place, unit = start[fine], place[fine], unit[fine]
    head = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (unit[1:] != unit[:-1])])) if len(start) else np.zeros(0, np.int64)
    n = np.diff(np.append(head, len(start))) - 1
    lo = start[head]
    # the chunk's first and last gram and every eighth between settle its bytes together with its length
    end = lo + n + LENGTH - GRAM
    c = h[lo] ^ _mix(h[end] + n.astype(np.uint64))
    with np.errstate(over="ignore"):
        for k in range(8, LENGTH - GRAM + LENGTH, GRAM):
            c = _mix(c * np.uint64(_BASE) + h[np.minimum(lo + k, end)])
    u = unit[head]
    return {"row": bounds[u, 2], "lo": lo - bounds[u, 0] + bounds[u, 3], "n": n, "m": h[place[head]].view(np.int64), "c": c.view(np.int64)}


# ------------------------------------------------------------ the suffix array over chunks

def _extension(strings: list[bytes]) -> list[int]:
    """For each string the longest prefix it shares with any other."""
    order = sorted(range(len(strings)), key=strings.__getitem__)
    out = [0] * len(strings)
    for i, j in zip(order, order[1:], strict=False):
        a, b = strings[i], strings[j]
        n = min(len(a), len(b))
        diff = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
        same = n - (diff.bit_length() + 7) // 8
        out[i], out[j] = max(out[i], same), max(out[j], same)
    return out


def trimmed(chunks: list[bytes], m: int) -> list[tuple[int, int]]:
    """What of each chunk another one can share: (start, end) around the minimizer m, empty if under LENGTH bytes.

    Equal windows hold the minimizer at one offset, so a window that leaves
    the longest extension a chunk shares on either side has no equal.
    """
    right, left, at = [], [], []
    for c in chunks:
        grams = gram_hashes(np.frombuffer(c, np.uint8))
        n = len(c) - LENGTH
        p = n + int(np.flatnonzero(grams[n:].view(np.int64) == m)[0])
        at.append(p)
        right.append(c[p:])
        left.append(c[:p][::-1])
    out = []
    for p, r, s in zip(at, _extension(right), _extension(left), strict=True):
        out.append((p - s, p + r) if r + s >= LENGTH else (p, p))
    return out


def repeats(segments: list[bytes], rank: np.ndarray) -> np.ndarray:
    """Windows of ``segments`` that have an equal, earlier one: rows (segment, start).

    ``rank[k]`` orders the segments' windows: by rank, then by start; segments
    of one rank must not hold equal windows at equal starts.
    """
    sizes = np.array([len(s) for s in segments])
    text = np.zeros(int(sizes.sum()) + len(segments), np.int64)
    owner = np.repeat(np.arange(len(segments)), sizes + 1)
    first = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    start = np.arange(len(text)) - first[owner]
    text[start < sizes[owner]] = np.frombuffer(b"".join(segments), np.uint8).astype(np.int64) + 1
    order = suffix_array(text)
    order = order[start[order] + LENGTH <= sizes[owner[order]]]
    if len(order) < 2:
        return np.zeros((0, 2), np.int64)
    # common prefixes of neighbours, in slices of bounded size
    same = np.zeros(len(order), bool)
    view = np.lib.stride_tricks.sliding_window_view(text, LENGTH)
    for lo in range(1, len(order), 4096):
        hi = min(lo + 4096, len(order))
        same[lo:hi] = (view[order[lo:hi]] == view[order[lo - 1:hi - 1]]).all(axis=1)
    interval = np.cumsum(~same)
    by = np.lexsort((start[order], rank[owner[order]], interval))
    earliest = np.concatenate([[True], interval[by][1:] != interval[by][:-1]])
    found = order[by[~earliest]]
    return np.column_stack([owner[found], start[found]])


def _spans(found: np.ndarray) -> list[tuple[int, int, int]]:
    """(segment, start) rows -> (segment, start of the first window, end of the last) by runs of neighbours."""
    if not len(found):
        return []
    found = found[np.lexsort((found[:, 1], found[:, 0]))]
    head = np.flatnonzero(np.concatenate([[True], (np.diff(found[:, 0]) != 0) | (np.diff(found[:, 1]) != 1)]))
    tail = np.append(head[1:], len(found)) - 1
    return list(zip(found[head, 0].tolist(), found[head, 1].tolist(), (found[tail, 1] + LENGTH).tolist(), strict=True))


class _Block:
    """Groups gathered until their suffix array is worth building."""

    def __init__(self) -> None:
        self.clear()

    def clear(self) -> None:
        self.segments: list[bytes] = []
        self.places: list[tuple[int, int, int]] = []  # id, tag, start of the segment in the text
        self.same: list[tuple[int, int, int, int]] = []  # spans that equal an earlier segment as a whole
        self.bytes = 0

    def add(self, m: int, chunks: list[bytes], places: list[tuple[int, int, int]]) -> None:
        """Chunks of one minimizer with their places."""
        parts: dict[bytes, list[tuple[int, int, int]]] = {}
        for c, (a, b), (i, tag, lo) in zip(chunks, trimmed(chunks, m), places, strict=True):
            if b > a:
                parts.setdefault(c[a:b], []).append((i, tag, lo + a))
        for s, at in parts.items():
            at.sort()
            self.same += [(i, tag, lo, lo + len(s)) for i, tag, lo in at[1:]]
            if len(parts) > 1:
                self.segments.append(s)
                self.places.append(at[0])
                self.bytes += len(s)

    def flush(self) -> list[tuple[int, int, int, int]]:
        """(id, tag, start, end) of repeated spans."""
        out = self.same
        if len(self.segments) > 1:
            rank = np.empty(len(self.places), np.int64)
            rank[sorted(range(len(self.places)), key=self.places.__getitem__)] = np.arange(len(self.places))
            # one document's segments are ordered by where they start, and equal windows of two
            # of them are as far apart as the segments, so the order by rank is that of the windows
            for k, a, b in _spans(repeats(self.segments, rank)):
                i, tag, lo = self.places[k]
                out.append((i, tag, lo + a, lo + b))
        self.clear()
        return out


_SPAN = "id long, tag long, start long, stop long"


def _span_batch(rows: list[tuple[int, int, int, int]]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) or [(), (), (), ()]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["id", "tag", "start", "stop"])


def _sorted_out(chunks: DataFrame) -> DataFrame:
    """(m, part, id, tag, lo, bytes) -> repeated spans within each (m, part)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = _Block()
        for g in sorted_runs(batches, ["m", "part"]):
            if len(g["m"]) > 1:
                block.add(int(g["m"][0]), g["bytes"].tolist(), _places(g))
            if block.bytes >= BLOCK_BYTES or len(block.same) > 10_000:
                yield _span_batch(block.flush())
        yield _span_batch(block.flush())

    return _grouped(chunks).mapInArrow(run, _SPAN)


def _places(g: dict) -> list[tuple[int, int, int]]:
    return list(zip(g["id"].tolist(), g["tag"].tolist(), g["lo"].tolist(), strict=True))


def _grouped(chunks: DataFrame) -> DataFrame:
    return chunks.select("m", "part", "id", "tag", "lo", "bytes").repartition("m", "part").sortWithinPartitions("m", "part", "id", "tag", "lo")


def _first_pass(chunks: DataFrame) -> DataFrame:
    """Parts of large groups -> spans (bytes null), and each window that is first in its part (with its bytes)."""
    names = ["id", "tag", "start", "stop", "m", "bytes"]
    kinds = [pa.int64()] * 5 + [pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in sorted_runs(batches, ["m", "part"]):
            block = _Block()
            m, places, chunks = int(g["m"][0]), _places(g), g["bytes"].tolist()
            if len(places) > 1:
                block.add(m, chunks, places)
            rows: list[tuple] = [(*s, m, None) for s in block.flush()]
            gone = {(i, tag, w) for i, tag, a, b, *_ in rows for w in range(a, b - LENGTH + 1)}
            for c, (i, tag, lo) in zip(chunks, places, strict=True):
                for k in range(len(c) - LENGTH + 1):
                    if (i, tag, lo + k) not in gone:
                        rows.append((i, tag, lo + k, lo + k + LENGTH, m, c[k:k + LENGTH]))
                if len(rows) > 20_000:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    return _grouped(chunks).mapInArrow(run, _SPAN + ", m long, bytes binary")


# ------------------------------------------------------------ the corpus

def _keyed(docs: DataFrame, *more: Column) -> DataFrame:
    """id, tag (64-bit hash of the text, for repeated ids), text as bytes."""
    tag = F.xxhash64(F.coalesce("text", F.lit("")))
    return docs.select(null_id().alias("id"), tag.alias("tag"), F.col("text").cast("binary").alias("text"), *more)


def _slices(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """Slices of at most 512 rows, and about 4 MB of ``column``."""
    for whole in batches:
        sizes = pc.fill_null(pc.binary_length(whole.column(whole.schema.get_field_index(column))), 0).to_numpy().astype(np.int64)
        cut = np.cumsum(sizes) // (4 << 20) * (1 << 32) + np.arange(len(sizes)) // 512
        heads = [0, *(np.flatnonzero(np.diff(cut)) + 1).tolist(), len(sizes)]
        for a, b in zip(heads, heads[1:], strict=False):
            if b > a:
                yield whole.slice(a, b - a)


def _repeated_minimizers(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches, "text"):
            m, n = np.unique(chunks_of([t or b"" for t in batch.column(0).to_pylist()])["m"], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(m), pa.array(np.minimum(n, 2).astype(np.int32))], names=["m", "n"])

    return small_batches(docs).select("text").mapInArrow(run, "m long, n int").groupBy("m").agg(F.sum("n").alias("n")).filter("n > 1").select("m")


def _bitmap(minimizers: DataFrame) -> np.ndarray:
    """A bit for each minimizer, by its low bits: 2 ** FILTER_BITS bits, whatever the number of rows."""
    spot = F.col("m").bitwiseAND((1 << FILTER_BITS) - 1)
    words = minimizers.groupBy(F.shiftright(spot, 6).cast("int").alias("w")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(m & 63 as int))")).alias("b")).toArrow()
    out = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
    out[words.column("w").to_numpy()] = words.column("b").to_numpy().view(np.uint64)
    return out


def _occurrences(docs: DataFrame, bitmap: np.ndarray) -> DataFrame:
    """m, c, id, tag, at (start and windows less one, packed in this order) of chunks whose minimizer may repeat."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches, "text"):
            x = chunks_of([t or b"" for t in batch.column(2).to_pylist()])
            spot = x["m"] & ((1 << FILTER_BITS) - 1)
            some = (bitmap[spot >> 6] >> (spot & 63).astype(np.uint64)) & np.uint64(1) == 1
            row = x["row"][some]
            at = (x["lo"][some] << 7) | x["n"][some]
            ids, tags = (batch.column(k).to_numpy()[row] for k in (0, 1))
            yield pa.RecordBatch.from_arrays([pa.array(v) for v in (x["m"][some], x["c"][some], ids, tags, at)],
                                             names=["m", "c", "id", "tag", "at"])

    return docs.select("id", "tag", "text").mapInArrow(run, "m long, c long, id long, tag long, at long")


def _unpacked(at: Column) -> list[Column]:
    return [F.shiftright(at, 7).alias("lo"), (at.bitwiseAND(127)).alias("n")]


def _once(docs: DataFrame) -> DataFrame:
    """One row for each id and tag: a row given twice must not be taken for its own repeat."""
    several = stored_table(docs.groupBy("id", "tag").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1").select("id", "tag"))
    n = several.count()
    if not n:
        return docs
    if n > BROADCAST_ROWS:
        return docs.dropDuplicates(["id", "tag"])
    side = F.broadcast(several)
    return docs.join(side, ["id", "tag"], "left_anti").unionByName(docs.join(side, ["id", "tag"], "left_semi").dropDuplicates(["id", "tag"]))


def _chunk_bytes(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(m, part, id, tag, lo, n) -> the same with the chunk's bytes; docs have one row for each id and tag."""
    per = wanted.groupBy("id", "tag").agg(F.collect_list(F.struct("m", "part", "lo", "n")).alias("w"))
    side = F.broadcast(per) if wanted.count() <= 2 * BROADCAST_ROWS else per

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [("m", pa.int64()), ("part", pa.int64()), ("id", pa.int64()), ("tag", pa.int64()), ("lo", pa.int64()), ("bytes", pa.binary())]
        for batch in _slices(batches, "text"):
            rows = []
            for r in batch.to_pylist():
                for x in r["w"]:
                    rows.append((x["m"], x["part"], r["id"], r["tag"], x["lo"], r["text"][x["lo"]:x["lo"] + x["n"] + LENGTH]))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows, strict=True), kinds, strict=True)], names=[k for k, _ in kinds])

    return docs.join(side, ["id", "tag"]).select("id", "tag", "text", "w").mapInArrow(
        run, "m long, part long, id long, tag long, lo long, bytes binary")


def repeated_spans(docs: DataFrame, part: int = PART) -> DataFrame:
    """id, tag, spans array<struct<start, stop>>: merged spans to remove, of the documents that have any."""
    keyed = _keyed(docs)
    minimizers = stored_table(_repeated_minimizers(keyed))
    places = stored_table(_occurrences(keyed, _bitmap(minimizers)).join(minimizers, "m"))
    chunks = stored_table(places.groupBy("m", "c").agg(F.min(F.struct("id", "tag", "at")).alias("first"), F.count(F.lit(1)).alias("places")))
    copies = places.join(chunks.filter("places > 1").select("m", "c", "first"), ["m", "c"]).filter(F.struct("id", "tag", "at") > F.col("first"))
    whole = copies.select("id", "tag", *_unpacked(F.col("at"))).select("id", "tag", F.col("lo").alias("start"), (F.col("lo") + F.col("n") + LENGTH).alias("stop"))

    several = chunks.groupBy("m").agg(F.count(F.lit(1)).alias("distinct")).filter("distinct > 1")
    n_parts = F.ceil(F.col("distinct") / part)
    wanted = stored_table(chunks.join(several, "m").select(
        "m", F.pmod(F.xxhash64("c"), n_parts).alias("part"), n_parts.alias("parts"), "first.id", "first.tag", *_unpacked(F.col("first.at"))))
    once = _once(keyed)
    spans = whole.unionByName(_sorted_out(_chunk_bytes(once, wanted.filter("parts = 1").drop("parts"))))
    large = wanted.filter("parts > 1")
    if not large.isEmpty():
        passed = stored_table(_first_pass(_chunk_bytes(once, large.drop("parts"))))
        spans = spans.unionByName(passed.filter("bytes is null").select("id", "tag", "start", "stop"))
        first = passed.filter("bytes is not null").join(large.groupBy("m").agg(F.first("parts").alias("parts")), "m")
        again = first.select("m", F.pmod(F.xxhash64("bytes"), F.col("parts") * 64).alias("part"), "id", "tag", F.col("start").alias("lo"), "bytes")
        spans = spans.unionByName(_sorted_out(again))
    return stored_table(spans.groupBy("id", "tag").agg(F.collect_list(F.struct("start", "stop")).alias("spans")).mapInArrow(
        _merged, "id long, tag long, spans array<struct<start:long,stop:long>>"))


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for spans in batch.column(2):
            a, b = (np.asarray(spans.values.field(k)) for k in (0, 1))
            order = np.argsort(a)
            a, b = a[order], np.maximum.accumulate(b[order])
            head = np.concatenate([[True], a[1:] > b[:-1]])
            stop = b[np.append(np.flatnonzero(head)[1:] - 1, len(b) - 1)]
            out.append([{"start": int(x), "stop": int(y)} for x, y in zip(a[head], stop, strict=True)])
        kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, kind)], names=["id", "tag", "spans"])


def remove_repeats(docs: DataFrame, with_kept: bool = True, part: int = PART) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, (kept, the remaining bytes) for every row of ``docs``."""
    spans = repeated_spans(docs, part)
    size = spans.agg(F.count(F.lit(1)) + F.sum(F.size("spans"))).first()[0] or 0
    side = F.broadcast(spans) if size <= 2 * BROADCAST_ROWS else spans
    joined = _keyed(docs, F.col("doc_id").cast("long").alias("doc_id")).join(side, ["id", "tag"], "left").select("doc_id", "text", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches, "text"):
            out: list[list] = [[], [], [], [], []]
            for t, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                t = t or b""
                at, kept = 0, []
                for s in spans or ():
                    kept.append(t[at:s["start"]])
                    at = s["stop"]
                rest = b"".join([*kept, t[at:]])
                for c, v in zip(out, (len(t), len(t) - len(rest), len(spans or ()), hashlib.sha256(rest).hexdigest(), rest), strict=True):
                    c.append(v)
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()][: 4 + with_kept]
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, t) for c, t in zip(out, kinds, strict=False)]],
                                             names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"][: 5 + with_kept])

    return joined.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_kept)

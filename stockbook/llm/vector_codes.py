"""Vector code compression: product codes from a member-resident Lloyd.

Every component becomes the integer ``floor(4096 * x)`` and every vector is cut
into 8 equal consecutive parts, each with a codebook of 16 entries. The parts are
the members of a state that is laid out once by (position, entry, salt): an owner
is a block of members of one entry. In each round an owner assigns its resident
members to the codebook of the round before. Those that keep their entry stay
where they lie and are summed there; only those that change entry are shuffled to
an owner of the new one, which sums them after the move. Members carry no ids, so a
block is packed integers of the narrowest width that holds them.

What reaches the driver is the codebooks: 8 x 16 entries and their sums. The salt
deals an entry that holds most of the members over many owners. All arithmetic is
on integers, so no result depends on the order of rows.

Defined cases: rows whose vector is null or holds null, NaN or infinite
components are dropped, as are vectors whose length is not that of the smallest
kept vec_id or is no multiple of 8; a null vec_id counts as the smallest; ties among
the first 16 go by the components. With fewer than 16 rows codebooks are shorter;
without any the result is empty. Repeated rows each count. Sums beyond 64 bits
(components beyond 2^27 / 4096) are taken on Python's integers and errors end at
2^63 - 1. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockbook.llm.common import null_id, small, stored, stored_table

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096.0
#: Members of one owner: larger entries are dealt over several by a salt.
BLOCK = 8192
#: Bytes of members a task holds, about, if the state is larger than eight such tasks.
TASK_BYTES = 32 << 20
LARGEST = 2**63 - 1
#: Up to this size of a component squared errors of a whole vector fit a long.
PLAIN = 1 << 27

_STATE = "position int, entry int, width int, members binary, moved boolean"


def integers(vectors: np.ndarray) -> np.ndarray:
    """``floor(4096 * x)`` as int64, or as Python's integers where that could overflow."""
    scaled = np.floor(vectors * SCALE)
    if scaled.size == 0 or np.abs(scaled).max() <= PLAIN:
        return scaled.astype(np.int64)
    # a double beyond the largest that can be scaled is an integer itself
    whole = [int(x) * int(SCALE) if np.isinf(y) else int(y) for x, y in zip(vectors.ravel(), scaled.ravel(), strict=True)]
    out = np.empty(len(whole), object)
    out[:] = whole
    return out.reshape(vectors.shape)


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of each part's nearest entry (ties to the lower) and the squared distance."""
    plain = all(m.dtype != object and np.abs(m).max(initial=0) <= PLAIN for m in (parts, entries))
    kind: type = np.int64 if plain else object
    parts, entries = parts.astype(kind), entries.astype(kind)
    best = np.zeros(len(parts), np.int64)
    least = None
    for k, entry in enumerate(entries):
        gap = parts - entry
        far = (gap * gap).sum(axis=1)
        if least is None:
            least = far
            continue
        closer = (far < least).astype(bool)
        best[closer], least[closer] = k, far[closer]
    return best, least if least is not None else np.zeros(0, np.int64)


def _packed(parts: np.ndarray) -> bytes:
    """The parts in the narrowest integers; the first byte names the width (0: decimal text)."""
    if parts.dtype == object:
        return b"\0" + ",".join(str(x) for x in parts.ravel()).encode()
    top = int(np.abs(parts).max(initial=0))
    for width, kind in ((2, np.int16), (4, np.int32), (8, np.int64)):
        if top < 1 << 8 * width - 1:
            return bytes([width]) + parts.astype(kind).tobytes()
    raise AssertionError(top)


def _unpacked(data: bytes, width: int) -> np.ndarray:
    if data[0] == 0:
        out = np.array([int(x) for x in data[1:].split(b",")], object)
        return out.reshape(-1, width)
    kind = {2: np.int16, 4: np.int32, 8: np.int64}[data[0]]
    return np.frombuffer(data, kind, offset=1).astype(np.int64).reshape(-1, width)


@dataclass
class Codebooks:
    """``at[position]``: the entries of a position as a matrix of integers."""

    at: list[np.ndarray]

    @property
    def width(self) -> int:
        return self.at[0].shape[1]

    def digest(self) -> str:
        return hashlib.sha256(",".join(str(int(x)) for m in self.at for x in m.ravel()).encode()).hexdigest()

    def moved(self, sums: dict[tuple[int, int], tuple[int, list[int]]]) -> Codebooks:
        """Each used entry replaced by floor(sum / count) of its members."""
        out = []
        for p, m in enumerate(self.at):
            new = m.astype(object)
            for e in range(len(m)):
                if (p, e) in sums:
                    n, total = sums[p, e]
                    new[e] = [t // n for t in total]
            out.append(new if np.abs(new).max(initial=0) > PLAIN else new.astype(np.int64))
        return Codebooks(out)


def _clean(embeddings: DataFrame) -> DataFrame:
    v = F.col("vector")
    fine = (F.size(v) > 0) & (F.size(v) % PARTS == 0) & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return embeddings.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"), "label",
    ).filter(F.coalesce(fine, F.lit(False)))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _blocks(rows: DataFrame, tasks: int) -> DataFrame:
    """(position, entry, member) rows packed into owners' blocks, dealt by (position, entry, salt)."""
    def block(key: tuple, held: list) -> pa.RecordBatch:
        parts = np.concatenate([x.astype(object) for x in held] if any(x.dtype == object for x in held) else held)
        return pa.RecordBatch.from_arrays([*(pa.array([x], pa.int32()) for x in key), pa.array([_packed(parts)], pa.binary()), pa.array([False])],
                                          names=["position", "entry", "width", "members", "moved"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, n = None, [], 0
        for batch in batches:
            for p, e, w, data in zip(*(batch.column(k).to_pylist() for k in (0, 1, 3, 4)), strict=True):
                if held and (key != (p, e, w) or n >= BLOCK):
                    yield block(key, held)
                    held, n = [], 0
                key = (p, e, w)
                held.append(_unpacked(data, w))
                n += len(held[-1])
        if held:
            yield block(key, held)

    keys = ["position", "entry", "salt"]
    return rows.select(*keys, "width", "member").repartition(tasks, *keys).sortWithinPartitions(*keys).mapInArrow(run, _STATE)


def _members(table: DataFrame, books: Codebooks, salts: int) -> DataFrame:
    """The parts of all vectors with the entry nearest to each in the first codebooks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = 0
        for whole in batches:
            for lo in range(0, whole.num_rows, BLOCK):
                vectors = integers(_matrix(whole.column(0).slice(lo, BLOCK)))
                turn += 1
                out: list = []
                for p, part in enumerate(np.split(vectors, PARTS, axis=1)):
                    entry = nearest(part, books.at[p])[0]
                    for e in np.unique(entry):
                        out.append((p, int(e), turn % salts, books.width, _packed(part[entry == e])))
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(list(c), pa.int32()) for c in list(zip(*out, strict=True))[:4]), pa.array([r[4] for r in out], pa.binary())],
                    names=["position", "entry", "salt", "width", "member"])

    return table.select("vector").mapInArrow(run, "position int, entry int, salt int, width int, member binary")


def _assigned(state: DataFrame, books: Codebooks) -> DataFrame:
    """Owners' blocks after their members are assigned anew: what stays, and what moves by its new entry."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p, e, w, data in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                parts = _unpacked(data, w)
                entry = nearest(parts, books.at[p])[0]
                out = [(p, int(x), w, _packed(parts[entry == x]), bool(x != e)) for x in np.unique(entry)]
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array([r[k] for r in out], pa.int32()) for k in range(3)),
                     pa.array([r[3] for r in out], pa.binary()), pa.array([r[4] for r in out])],
                    names=["position", "entry", "width", "members", "moved"])

    return state.mapInArrow(run, _STATE)


def _sums(state: DataFrame) -> dict[tuple[int, int], tuple[int, list[int]]]:
    """Count and componentwise sums of each entry's members: owners sum their own, a few rows meet."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict = {}
        for batch in batches:
            for p, e, w, data in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                parts = _unpacked(data, w)
                n, old = total.get((p, e), (0, [0] * w))
                total[p, e] = n + len(parts), [a + int(b) for a, b in zip(old, parts.sum(axis=0), strict=True)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in total], pa.int32()), pa.array([k[1] for k in total], pa.int32()),
             pa.array([v[0] for v in total.values()], pa.int64()), pa.array([[str(x) for x in v[1]] for v in total.values()], pa.list_(pa.string()))],
            names=["position", "entry", "n", "sums"])

    # one row an entry and task: at most 128 a task
    rows = state.mapInArrow(run, "position int, entry int, n long, sums array<string>")
    flat = rows.select("position", "entry", "n", F.posexplode("sums").alias("k", "s"))
    # whole numbers of any length: decimal text is summed in pieces of 15 digits
    digits = F.regexp_replace("s", "^-", "")
    sign = F.when(F.col("s").startswith("-"), F.lit(-1)).otherwise(F.lit(1))
    piece = F.explode(F.sequence(F.lit(0), F.floor((F.length(digits) - 1) / 15).cast("int")))
    cut = flat.select("position", "entry", "n", "k", sign.alias("sign"), F.reverse(digits).alias("digits"), piece.alias("piece"))
    value = F.reverse(F.substr("digits", F.col("piece") * 15 + 1, F.lit(15))).cast("decimal(38,0)") * F.col("sign")
    got = cut.groupBy("position", "entry", "k", "piece").agg(F.sum("n").alias("n"), F.sum(value).alias("s")).collect()
    out: dict = {}
    width = max((r.k for r in got), default=-1) + 1
    for r in got:
        n, total = out.get((r.position, r.entry), (0, [0] * width))
        total[r.k] += int(r.s) * 10 ** (15 * r.piece)
        out[r.position, r.entry] = (max(n, r.n) if r.piece == 0 else n, total)
    return out


def fit_codebooks(table: DataFrame, first: np.ndarray, rows: int, rounds: int = ROUNDS) -> Codebooks:
    """Codebooks after ``rounds`` rounds over ``table`` (vector) of ``rows`` rows, starting from the rows of ``first``."""
    books = Codebooks([m.copy() for m in np.split(integers(first), PARTS, axis=1)])
    salts = rows // (4 * BLOCK) + 1
    # the state's size is known, so its tasks are: small states would be spread over many empty ones
    tasks = max(8, rows * books.width * PARTS * 4 // TASK_BYTES)
    state = stored(_blocks(_members(table, books, salts), tasks))
    for k in range(rounds):
        books = books.moved(_sums(state))
        if k == rounds - 1:
            break
        after = stored(_assigned(state, books))
        # only the members that change entry are shuffled; the others lie where they lay
        salt = F.pmod(F.xxhash64("members"), F.lit(salts)).cast("int")
        movers = after.filter("moved").select("position", "entry", salt.alias("salt"), "width", F.col("members").alias("member"))
        state = after.filter("not moved").unionByName(_blocks(movers, tasks)).coalesce(tasks)
    return books


def encode(table: DataFrame, books: Codebooks) -> DataFrame:
    """vec_id, label, code, error: parts assigned to their nearest entries, row by row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, BLOCK):
                batch = whole.slice(lo, BLOCK)
                codes, error = [], None
                for p, part in enumerate(np.split(integers(_matrix(batch.column(2))), PARTS, axis=1)):
                    entry, far = nearest(part, books.at[p])
                    codes.append(entry.astype(np.uint8))
                    error = far if error is None else error + far
                digits = np.stack(codes, axis=1)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array([r.tobytes().hex() for r in digits], pa.string()),
                     pa.array([min(int(x), LARGEST) for x in error], pa.int64())], names=["vec_id", "label", "code", "error"])

    label = table.schema["label"].dataType.simpleString()
    return table.select("vec_id", "label", "vector").mapInArrow(run, f"vec_id long, label {label}, code string, error long")


def compress_vectors(embeddings: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, Codebooks | None]:
    """(vec_id, label, code, error) for every kept row, and the codebooks (None without rows)."""
    rows = _clean(embeddings)
    order = (null_id("vec_id"), F.col("vector"))
    sizes = rows.groupBy(F.size("vector").alias("width")).agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(*order)).alias("low")).orderBy("low").first()
    if sizes is None:
        return rows.limit(0).select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error")), None
    table = rows.filter(F.size("vector") == sizes.width)
    first = np.array([r.vector for r in table.orderBy(*order).limit(ENTRIES).select("vector").collect()], np.float64)
    books = fit_codebooks(table, first, sizes.n, rounds)
    return encode(table, books), books


def code_report(embeddings: DataFrame) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256: one row per kept row of ``embeddings``."""
    found, books = compress_vectors(embeddings)
    if books is not None:
        found = stored_table(found)
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(LARGEST).cast("decimal(38,0)")).cast("long")
    sums = found.groupBy(F.col("label").alias("of")).agg(total.alias("label_error"))
    if books is not None:
        sums = small(stored(sums))
    return found.join(sums, F.col("label").eqNullSafe(F.col("of"))).select(
        "vec_id", "code", "error", "label_error", F.lit(books.digest() if books else None).cast("string").alias("codebooks_sha256"))

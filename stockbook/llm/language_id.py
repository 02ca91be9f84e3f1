"""Language identification by segmentation-marginalised unigrams.

Every language has a probability for each piece of a fixed public vocabulary.
A word's likelihood is the sum over all its segmentations into pieces (forward
algorithm); the probabilities come from the training words by EM (expected
piece counts, forward-backward), starting from uniform ones. Word counts are
gathered over all training documents by a grouped sum; only the piece table,
bounded by vocabulary size times languages, reaches the driver.

Words are runs of letters, lower-cased, with the vocabulary's word-start mark
in front. Letters outside the vocabulary share one unknown piece. Words over
64 characters are scored in stretches of 64.

Defined cases: null text or text without a letter gives ``und`` with score 0,
as does a training set without languages; equal likelihoods go to the first
language in code-point order; rows are scored by themselves, so repeated rows
agree; other columns are not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import pairwise, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockbook.llm.common import small_batches, stored

WORD = re.compile(r"[^\W\d_]+")
MARK = "▁"
LONGEST = 64
#: Scales probabilities by this much a character, so that most words stay near 1.
LIFT = 100.0
#: (language, word) rows that a training task segments at once: by length they fill numpy's loops.
GATHER = 1 << 17
#: Decimal places that forward sums may fall by before they are rescaled; a double has some 300.
PLACES = 100


def vocabulary_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def raw_words(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


#: Latin-1 bytes, lower-cased; a blank for those that are no part of a run.
_LATIN = bytes(ord(c) if WORD.fullmatch(c) else 32 for c in (chr(b).lower() for b in range(256)))


def _blanked(text: str | None) -> bytes:
    """The runs of ``raw_words`` with blanks between them, as UTF-8; texts within Latin-1 need no search."""
    if text is None or text.isascii():
        return (text or "").encode().translate(_LATIN)
    try:
        return text.encode("latin-1").translate(_LATIN).decode("latin-1").encode()
    except UnicodeEncodeError:
        return " ".join(raw_words(text)).encode()


def _strings(column: pa.Array | pa.ChunkedArray) -> list[str]:
    """``to_pylist`` of strings, several times as fast."""
    return column.to_numpy(zero_copy_only=False).tolist()


def runs(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Where each text's runs begin and end, each run's place in the distinct runs, and these (``""`` may be one)."""
    found = pc.ascii_split_whitespace(pa.array([_blanked(t.as_py()) for t in texts], pa.large_string()))
    coded = found.values.dictionary_encode()
    return found.offsets.to_numpy(), coded.indices.to_numpy().astype(np.int64), _strings(coded.dictionary)


def stretches(word: str) -> list[str]:
    """What is scored of a run of word characters: none without a letter, else it with the mark, in stretches."""
    if not (word.isalpha() or any(map(str.isalpha, word))):
        return []
    word = MARK + word
    return [word] if len(word) <= LONGEST else [word[i:i + LONGEST] for i in range(0, len(word), LONGEST)]


def cut(words: list[str]) -> tuple[list[str], np.ndarray]:
    """The ``stretches`` of all ``words``, one word's after another's, and how many each has."""
    flat, sizes = [MARK + w for w in words], np.ones(len(words), np.int64)
    odd = [k for k, w in enumerate(words) if len(w) >= LONGEST or not w.isalpha()]
    if odd:
        parts = [stretches(words[k]) for k in odd]
        sizes[odd] = list(map(len, parts))
        flat = [x for k, last, p in zip(odd, [-1, *odd], parts, strict=False) for x in (*flat[last + 1:k], *p)] + flat[odd[-1] + 1:]
    return flat, sizes


def _codes(words: list[str]) -> np.ndarray:
    """(words, length) code points of words of one length."""
    return np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(words), -1).astype(np.uint64)


def _grow(h: np.ndarray, codes: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (h ^ codes) * np.uint64(0x9E3779B97F4A7C15)
        return h ^ (h >> np.uint64(29))


class Pieces:
    """The vocabulary's pieces by hash of each of their prefixes; id 0 is the unknown character.

    ``nodes`` are the prefixes' hashes, ``piece`` the id of the piece a prefix
    is (-1: none), ``inner`` whether a longer one goes on from it. A prefix is
    found by one of two tables of slots: the second holds those whose slot in
    the first is taken.
    """

    SLOTS = 20

    def __init__(self, path: str) -> None:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [sp.id_to_piece(i) for i in range(sp.get_piece_size())
                 if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        names = sorted({p for p in names if len(p) <= 16 and p == p.lower() and p.strip(MARK).isalpha() or p == MARK})
        prefixes = sorted({p[:k] for p in names for k in range(1, len(p) + 1)})
        number = {p: k + 1 for k, p in enumerate(names)}
        hashes = np.empty(len(prefixes), np.uint64)
        for i, p in enumerate(prefixes):
            h = np.zeros(1, np.uint64)
            for c in _codes([p])[0]:
                h = _grow(h, c)
            hashes[i] = h[0]
        self.size, self.longest = len(names) + 1, max(map(len, names), default=1)
        self.nodes = np.concatenate([np.zeros(1, np.uint64), hashes])  # node 0: no prefix
        self.piece = np.array([-1] + [number.get(p, -1) for p in prefixes], np.int64)
        inner = {p[:-1] for p in prefixes}
        self.inner = np.array([False] + [p in inner for p in prefixes])
        self.first, left = self._table(np.arange(1, len(self.nodes)), 0)
        self.second, rest = self._table(left, self.SLOTS)
        self.rest = rest[np.argsort(self.nodes[rest])]  # in neither table; looked up by search

    def _slot(self, h: np.ndarray, shift: int) -> np.ndarray:
        return ((h >> np.uint64(shift)) & np.uint64((1 << self.SLOTS) - 1)).astype(np.int64)

    def _table(self, nodes: np.ndarray, shift: int) -> tuple[np.ndarray, np.ndarray]:
        table = np.zeros(1 << self.SLOTS, np.int32)
        slot = self._slot(self.nodes[nodes], shift)
        _, one = np.unique(slot, return_index=True)
        table[slot[one]] = nodes[one]
        return table, np.delete(nodes, one)

    def find(self, h: np.ndarray) -> np.ndarray:
        """The nodes with hashes ``h``, 0 where there is none."""
        node = self.first[self._slot(h, 0)]
        miss = np.flatnonzero(self.nodes[node] != h)
        if len(miss):
            again = self.second[self._slot(h[miss], self.SLOTS)]
            again[self.nodes[again] != h[miss]] = 0
            if len(self.rest):
                own = self.nodes[self.rest]
                at = np.minimum(np.searchsorted(own, h[miss]), len(own) - 1)
                again = np.where(own[at] == h[miss], self.rest[at], again)
            node[miss] = again
        return node

    def steps(self, codes: np.ndarray) -> list[tuple[int, int, np.ndarray, np.ndarray]]:
        """(i, j, rows, piece ids) for each stretch [i, j) that is a piece of some of the words, by i."""
        out = []
        n = codes.shape[1]
        column = np.ascontiguousarray(codes.T)
        every, none = np.arange(len(codes)), np.zeros(len(codes), np.uint64)
        for i in range(n):
            rows, h = every, none
            for j in range(i + 1, min(n, i + self.longest) + 1):
                h = _grow(h, column[j - 1] if rows is every else column[j - 1].take(rows))
                node = self.find(h)
                got = self.piece.take(node)
                if j == i + 1:
                    out.append((i, j, rows, np.maximum(got, 0)))
                else:
                    some = got > 0
                    if some.any():
                        out.append((i, j, rows[some], got[some]))
                alive = self.inner.take(node)
                if not alive.all():
                    rows, h = rows[alive], h[alive]
                    if not len(rows):
                        break
        return out


def _by_length(words: list[str]) -> Iterator[tuple[int, list[int]]]:
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    order = np.argsort(sizes, kind="stable")
    edges = np.flatnonzero(np.diff(sizes[order], prepend=-1, append=-1))
    for a, b in pairwise(edges.tolist()):
        for lo in range(a, b, 8192):
            yield int(sizes[order[a]]), order[lo:min(b, lo + 8192)].tolist()


def _span(probs: np.ndarray) -> int:
    """Characters after which forward sums are rescaled: each may cost the smallest probability."""
    places = -np.log10(max(probs.min() * LIFT, 1e-300))
    return LONGEST if places * LONGEST <= PLACES else max(1, int(PLACES / places))


def _forward(n: int, steps: list, probs: np.ndarray, rows: int) -> tuple[list[np.ndarray], list[np.ndarray], dict[int, np.ndarray]]:
    """Forward sums, the probability of each step, and by place what the sums from there on were divided by."""
    alpha = [np.ones((rows, probs.shape[1]))] + [np.zeros((rows, probs.shape[1])) for _ in range(n)]
    used = []
    norms: dict[int, np.ndarray] = {}
    span, far = _span(probs), 0
    for i, j, r, ids in steps:  # by i ascending: alpha[i] is complete
        if i and i % span == 0 and i not in norms:
            norms[i] = np.where(alpha[i] > 0, alpha[i], 1.0)
            for k in range(i, far + 1):
                alpha[k] /= norms[i]
        far = max(far, j)
        p = probs.take(ids, axis=0)
        p *= LIFT ** (j - i)
        used.append(p)
        if len(r) == rows:
            alpha[j] += alpha[i] * p
        else:
            alpha[j][r] += alpha[i][r] * p
    return alpha, used, norms


def log_likelihoods(words: list[str], pieces: Pieces, probs: np.ndarray) -> np.ndarray:
    """(words, languages): log of the sum over all segmentations."""
    out = np.empty((len(words), probs.shape[1]))
    for n, at in _by_length(words):
        alpha, _, norms = _forward(n, pieces.steps(_codes([words[k] for k in at])), probs, len(at))
        out[at] = np.log(alpha[n]) - n * np.log(LIFT)
        for c in norms.values():
            out[at] += np.log(c)
    return out


def run_likelihoods(words: list[str], pieces: Pieces, probs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words, languages): log likelihoods, summed over a run's stretches; and whether it has a letter."""
    flat, sizes = cut(words)
    if len(flat) == len(words) and sizes.all():
        return log_likelihoods(flat, pieces, probs), sizes > 0
    row: dict[str, int] = {}  # stretches of long runs may repeat
    at = np.array([row.setdefault(x, len(row)) for x in flat], np.int64)
    ll = log_likelihoods(list(row), pieces, probs)[at]
    out, some = np.zeros((len(words), probs.shape[1])), sizes > 0
    if len(flat):
        out[some] = np.add.reduceat(ll, (np.cumsum(sizes) - sizes)[some], axis=0)
    return out, some


def expected_counts(words: list[str], counts: np.ndarray, pieces: Pieces, probs: np.ndarray, lang: np.ndarray | None = None) -> np.ndarray:
    """Expected uses of each piece over all segmentations of ``words``: of one language, or each of its own column of ``probs``."""
    width = probs.shape[1]
    total = np.zeros(pieces.size * width)
    cells = probs.reshape(-1, 1)
    for n, at in _by_length(words):
        steps = pieces.steps(_codes([words[k] for k in at]))
        if lang is not None:
            own = lang[at]
            steps = [(i, j, r, ids * width + own[r]) for i, j, r, ids in steps]
        alpha, used, norms = _forward(n, steps, cells, len(at))
        for place, c in norms.items():  # steps across a rescaled place lead from the old scale to the new
            for k, (i, j, r, _) in enumerate(steps):
                if i < place <= j:
                    used[k] = used[k] / c[r]
        beta = [np.zeros((len(at), 1)) for _ in range(n)] + [np.ones((len(at), 1))]
        for (i, j, r, _), p in zip(reversed(steps), reversed(used), strict=True):
            if len(r) == len(at):
                beta[i] += p * beta[j]
            else:
                beta[i][r] += p * beta[j][r]
        scale = counts[at][:, None] / alpha[n]
        weights = [(alpha[i][r] * p * beta[j][r] * scale[r])[:, 0] for (i, j, r, _), p in zip(steps, used, strict=True)]
        total += np.bincount(np.concatenate([ids for *_, ids in steps]), weights=np.concatenate(weights), minlength=len(total))
    return total if lang is None else total.reshape(-1, width)


def gathered(batches: Iterator[pa.RecordBatch], rows: int = GATHER) -> Iterator[tuple[list[str], list[str], np.ndarray]]:
    """Languages, words and counts of at least ``rows`` rows at a time (the last: of the rest)."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= rows:
            yield _columns(held)
            held, size = [], 0
    if size:
        yield _columns(held)


def _columns(held: list[pa.RecordBatch]) -> tuple[list[str], list[str], np.ndarray]:
    t = pa.Table.from_batches(held)
    return _strings(t.column(0)), _strings(t.column(1)), t.column(2).to_numpy()


class LanguageModel:
    def __init__(self, langs: list[str], pieces: Pieces, probs: np.ndarray, prior: np.ndarray) -> None:
        self.langs, self.pieces, self.probs, self.prior = langs, pieces, probs, prior


def train(docs: DataFrame, path: str | None = None, rounds: int = 2, smooth: float = 0.05) -> LanguageModel:
    """Learn from all rows of ``docs`` with a text and a lang."""
    pieces = Pieces(path or vocabulary_path())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends, at, words = runs(batch.column(1))
            lang = batch.column(0).cast(pa.string()).dictionary_encode()
            width = max(1, len(words))
            keys, n = np.unique(np.repeat(lang.indices.to_numpy().astype(np.int64), np.diff(ends)) * width + at, return_counts=True)
            flat, sizes = cut(words)
            own = keys % width
            times = sizes[own]  # a run's stretches follow each other
            part = np.repeat((np.cumsum(sizes) - sizes)[own] - (np.cumsum(times) - times), times) + np.arange(times.sum())
            yield pa.RecordBatch.from_arrays(
                [lang.dictionary.take(pa.array(np.repeat(keys // width, times))),
                 pa.array(flat, pa.string()).take(pa.array(part)), pa.array(np.repeat(n, times))],
                schema=pa.schema([("lang", pa.string()), ("word", pa.string()), ("n", pa.int64())]))

    known = small_batches(docs).filter(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text")
    counts = stored(known.mapInArrow(count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n")))
    totals = {r[0]: r[1] for r in counts.groupBy("lang").agg(F.sum("n")).collect()}  # a row a language
    langs = sorted(totals)
    probs = np.full((pieces.size, len(langs)), 1 / pieces.size)
    for _ in range(rounds if langs else 0):
        model = probs
        place = {lang: k for k, lang in enumerate(langs)}

        def expect(batches: Iterator[pa.RecordBatch], model=model) -> Iterator[pa.RecordBatch]:
            total = np.zeros((pieces.size, len(place)))
            for lang, words, n in gathered(batches):
                total += expected_counts(words, n.astype(float), pieces, model, np.array([place[x] for x in lang], np.int64))
            p, k = np.nonzero(total)
            yield pa.RecordBatch.from_pydict({"p": p.astype(np.int64), "k": k.astype(np.int64), "n": total[p, k]})

        # at most pieces x languages rows
        got = counts.mapInArrow(expect, "p long, k long, n double").groupBy("p", "k").agg(F.sum("n").alias("n")).collect()
        table = np.full(probs.shape, smooth)
        for r in got:
            table[r["p"], r["k"]] += r["n"]
        probs = table / table.sum(axis=0)
    prior = np.log(np.array([totals[x] for x in langs], float) / max(1, sum(totals.values())))
    return LanguageModel(langs, pieces, probs, prior)


def predict(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """doc_id, lang_pred, score, n_scored_words; a function of the text alone."""
    langs, pieces, probs, prior = model.langs, model.pieces, model.probs, model.prior

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # run of word characters -> its row in `known`; row 0 is for those without a letter
        index: dict[str, int] = {}
        known = np.zeros((1, len(langs)))
        for whole in batches:
            for lo in range(0, whole.num_rows, 2048):
                batch = whole.slice(lo, 2048)
                ends, at, words = runs(batch.column(1))
                if len(index) > 400_000:  # the cache is bounded; what it held is computed anew
                    index, known = {}, known[:1]
                places = np.fromiter(map(index.get, words, repeat(-1 if langs else 0)), np.int64, len(words))
                miss = np.flatnonzero(places < 0)
                if len(miss):
                    new = [words[k] for k in miss.tolist()]
                    more, lettered = run_likelihoods(new, pieces, probs)
                    places[miss] = np.where(lettered, np.arange(len(known), len(known) + len(new)), 0)
                    index.update(zip(new, places[miss].tolist(), strict=True))
                    known = np.vstack([known, more])
                places = places[at]
                pred, score, scored = [], [], []
                for first, end in pairwise(ends.tolist()):
                    at = places[first:end]
                    scored.append(int(np.count_nonzero(at)))
                    if not scored[-1]:
                        pred.append("und")
                        score.append(0.0)
                        continue
                    total = prior + known[at].sum(axis=0)
                    p = np.exp(total - total.max())
                    k = int(total.argmax())
                    pred.append(langs[k])
                    score.append(float(p[k] / p.sum()))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(pred, pa.string()), pa.array(score, pa.float64()),
                                                  pa.array(scored, pa.int64())], names=["doc_id", "lang_pred", "score", "n_scored_words"])

    return small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, lang_pred string, score double, n_scored_words long")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def identify_languages(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Train on the rows that are not held out, predict every row."""
    model = train(docs.filter(~held_out(F.col("doc_id"))), path)
    out = predict(docs, model)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "n_scored_words")

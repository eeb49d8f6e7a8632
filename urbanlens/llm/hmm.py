"""Hidden Markov language model over words.

Symbols: the ``HEAD`` most frequent words, then ``FORMS`` word forms (last
letter and length) for all others, then the end of a text. The chain of
hidden states emits symbols; a word behind a form has the form's share of
smoothed counts. So a text's probability is the chain's probability of its
symbols times its words' probabilities within their forms, both exact.

Word counts and all sums over them come from every training text through a
sharded aggregate and a join. Frequent words (``LOOKUP``, a bounded table) are
looked up inside the tasks, all others are joined, so only rare words are
shuffled. Training starts from the counts of neighbouring symbols (a table
bounded by the number of symbols), then runs Baum-Welch over every training
text: each task sums its expected counts, Spark adds them up across
partitions, the driver divides. The scaled forward recursion runs over many
texts of similar length at once.

Defined cases: null or empty text is the end alone; repeated rows count each;
a null id is held out; without training texts all symbols are equally likely
and every token has base score zero; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urbanlens.llm import text as X

HEAD = 1024
LOOKUP = 1 << 17
FORMS = 256
SYMBOLS = HEAD + FORMS + 1
END = HEAD + FORMS
#: Word hash that stands for the end of a text in the counts.
END_WORD = 0
BLOCK = 1 << 18
PAIR_BLOCK = 1 << 16


@dataclass(frozen=True)
class Settings:
    states: int = 8
    start_rounds: int = 150   # on the table of neighbouring symbols, at most
    still: float = 1e-6       # gain per pair under which they end
    rounds: int = 2           # Baum-Welch over all training texts
    prior: float = 1.0


def learnable() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 != 2, F.lit(False))


def _forms(w: X.Words) -> np.ndarray:
    return (w.data[w.end - 1] & 31).astype(np.int64) * 8 + np.minimum((w.end - w.start - 1) // 2, 7)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    space, fold = X.byte_table("space"), X.fold_table()
    schema = pa.schema([("w", pa.int64()), ("form", pa.int32()), ("c", pa.int64())])
    for batch in batches:
        data, off = X.column_bytes(batch.column("text"))
        words, forms = [np.full(batch.num_rows, END_WORD, np.uint64)], [np.full(batch.num_rows, FORMS)]
        for a, b in X.chunks(off):
            w = X.Words(data, off, a, b, space, fold)
            words.append(w.hashes())
            forms.append(_forms(w))
        word, at, n = np.unique(np.concatenate(words), return_index=True, return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(X.signed(word)), pa.array(np.concatenate(forms)[at].astype(np.int32)), pa.array(n)], schema=schema)


@dataclass
class Vocabulary:
    words: np.ndarray     # sorted hashes of the LOOKUP most frequent words
    counts: np.ndarray
    symbol: np.ndarray    # own symbol, or -1
    mass: np.ndarray      # of each form: sum of count + 1, and 1 for the unknown
    ends: int
    total: int            # N
    types: int            # V


def vocabulary(counts: DataFrame) -> Vocabulary:
    """The bounded part of the counts table (w, form, c) and its totals."""
    t = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v"),
                   F.coalesce(F.sum(F.when(F.col("w") == END_WORD, F.col("c"))), F.lit(0)).alias("ends")).first()
    head = counts.filter(F.col("w") != END_WORD).orderBy(F.desc("c"), "w").limit(LOOKUP).toPandas()
    mass = np.ones(FORMS)
    for r in counts.filter(F.col("w") != END_WORD).groupBy("form").agg(F.sum(F.col("c") + 1).alias("m")).collect():
        mass[r["form"]] += r["m"]
    own = head[:HEAD]
    np.subtract.at(mass, own["form"].to_numpy(np.int64), own["c"].to_numpy(np.float64) + 1)
    words = head["w"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(words)
    symbol = np.where(np.arange(len(head)) < HEAD, np.arange(len(head)), -1)
    return Vocabulary(words[order], head["c"].to_numpy(np.float64)[order], symbol[order], mass, int(t["ends"]), int(t["n"]), int(t["v"]))


_ENCODED = "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, inside double, symbols binary, rare array<long>"


def _encode(shared):
    schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                        ("base", pa.float64()), ("inside", pa.float64()), ("symbols", pa.binary()), ("rare", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        v = Vocabulary(*shared.value)
        space, fold, row = X.byte_table("space"), X.fold_table(), TaskContext.get().partitionId() << 33
        log_mass, log_count = np.log10(v.mass), np.log10(v.counts + 1)
        for batch in batches:
            data, off = X.column_bytes(batch.column("text"))
            for a, b in X.chunks(off):
                w = X.Words(data, off, a, b, space, fold)
                h, form = w.hashes(), _forms(w)
                at = np.minimum(np.searchsorted(v.words, h), max(0, len(v.words) - 1))
                known = v.words[at] == h if len(v.words) else np.zeros(w.n, bool)
                symbol, count = np.full(w.n, -1), np.zeros(w.n)
                symbol[known], count[known] = v.symbol[at[known]], log_count[at[known]]
                inside = np.where(symbol < 0, count - log_mass[form], 0.0)
                symbol = np.where(symbol < 0, HEAD + form, symbol).astype(np.uint16)

                def sums(x: np.ndarray, w: X.Words = w) -> np.ndarray:
                    s = np.r_[0, np.cumsum(x)]
                    return s[w.ptr[1:]] - s[w.ptr[:-1]]

                n = w.counts()
                full = np.insert(symbol, w.ptr[1:], END)
                ends = (w.ptr + np.arange(len(w.ptr))).astype(np.int32) * 2
                rare = np.r_[0, np.cumsum(~known)][w.ptr].astype(np.int32)
                cols = [pa.array(np.arange(row, row + b - a)), batch.column("doc_id").slice(a, b - a), batch.column("held_out").slice(a, b - a),
                        pa.array(n + 1), pa.array(sums(known) + (v.ends > 0)),
                        pa.array(sums(count) + np.log10(v.ends + 1) - (n + 1) * np.log10(v.total + v.types + 1)), pa.array(sums(inside)),
                        pa.Array.from_buffers(pa.binary(), b - a, [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(full.tobytes())]),
                        pa.ListArray.from_arrays(pa.array(rare), pa.array(X.signed(h[~known])))]
                row += b - a
                yield pa.RecordBatch.from_arrays(cols, schema=schema)

    return run


def _sequences(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """All symbols of a batch end to end, and the n+1 offsets."""
    data, off = X.column_bytes(batch.column("symbols"))
    return np.ascontiguousarray(data).view(np.uint16), off // 2


def _blocks(off: np.ndarray) -> Iterator[np.ndarray]:
    """Texts by falling length in blocks of about ``BLOCK`` places, the longest times their number."""
    size = np.diff(off)
    order = np.argsort(-size, kind="stable")
    i = 0
    while i < len(order):
        j = i + max(1, BLOCK // max(1, int(size[order[i]])))
        yield order[i:j]
        i = j


class Chain:
    """Start, move and emission probabilities, and the scaled recursions over a block of texts."""

    def __init__(self, start: np.ndarray, move: np.ndarray, emit: np.ndarray):
        self.start, self.move, self.emit = start, move, np.ascontiguousarray(emit)  # emit: symbol x state

    def forward(self, symbols: np.ndarray, off: np.ndarray, rows: np.ndarray, keep: bool):
        """Log likelihood of each text (natural), and with ``keep`` the scaled vectors and scales of every step."""
        first, size = off[rows], np.diff(off)[rows]
        log = np.zeros(len(rows))
        steps, vec = [], None
        alive = len(rows)
        for t in range(int(size[0]) if len(size) else 0):
            while alive and size[alive - 1] <= t:
                alive -= 1
            seen = self.emit[symbols[first[:alive] + t]]
            vec = (self.start if vec is None else vec[:alive] @ self.move) * seen
            scale = vec.sum(axis=1)
            vec /= scale[:, None]
            log[:alive] += np.log(scale)
            if keep:
                steps.append((vec, scale, seen))
        return log, steps

    def expected(self, symbols: np.ndarray, off: np.ndarray, rows: np.ndarray, start: np.ndarray, move: np.ndarray, emit: np.ndarray) -> None:
        """Adds the block's expected counts (Baum-Welch)."""
        _, steps = self.forward(symbols, off, rows, keep=True)
        first = off[rows]
        back, held, marks = None, [], []
        for t in range(len(steps) - 1, -1, -1):
            vec, scale, _ = steps[t]
            now = np.ones_like(vec)
            if back is not None:
                later, n = back, len(back)
                move += (vec[:n].T @ later) * self.move
                now[:n] = later @ self.move.T
            state = vec * now
            held.append(state)
            marks.append(symbols[first[: len(vec)] + t])
            if t == 0:
                start += state.sum(axis=0)
            back = now * steps[t][2] / scale[:, None]
        state, mark = np.concatenate(held), np.concatenate(marks)
        for k in range(state.shape[1]):
            emit[:, k] += np.bincount(mark, state[:, k], len(emit))


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of neighbouring symbols; the first symbol of a text follows an end."""
    total = np.zeros(SYMBOLS * SYMBOLS, np.int64)
    for batch in batches:
        s, off = _sequences(batch)
        if len(s):
            before = np.r_[END, s[:-1]].astype(np.int64)
            total += np.bincount(before * SYMBOLS + s, minlength=len(total))
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["i", "n"])


def _sum_expected(chain: Chain):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(chain.start)
        start, move, emit = np.zeros(k), np.zeros((k, k)), np.zeros((SYMBOLS, k))
        for batch in batches:
            s, off = _sequences(batch)
            for rows in _blocks(off):
                chain.expected(s, off, rows, start, move, emit)
        flat = np.concatenate([start, move.ravel(), emit.ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat))), pa.array(flat)], names=["i", "n"])

    return run


def _rows(x: np.ndarray) -> np.ndarray:
    return x / x.sum(axis=-1, keepdims=True)


def from_pairs(pairs: np.ndarray, s: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, move and emission (symbol x state) that fit the counts of neighbouring symbols, by expectation steps."""
    k, rng = s.states, np.random.default_rng(11)
    share = (pairs.sum(axis=0) + s.prior) / (pairs.sum() + s.prior * len(pairs))
    joint = _rows(rng.random((k * k)) + 1).reshape(k, k)
    emit = _rows((share[:, None] * (0.5 + rng.random((len(pairs), k)))).T).T
    i, j = np.nonzero(pairs)
    n, last = pairs[i, j], -np.inf
    for _ in range(s.start_rounds if len(i) else 0):
        left, right, both, fit = np.zeros_like(emit), np.zeros_like(emit), np.zeros_like(joint), 0.0
        for a in range(0, len(i), PAIR_BLOCK):
            x, y, c = i[a:a + PAIR_BLOCK], j[a:a + PAIR_BLOCK], n[a:a + PAIR_BLOCK]
            ex, ey = emit[x], emit[y]
            given = (ex @ joint) * ey
            total = given.sum(axis=1)
            fit += float(c @ np.log(total))
            ratio = (c / total)[:, None]
            back = ex * (ey @ joint.T) * ratio
            given *= ratio
            for z in range(k):
                left[:, z] += np.bincount(x, back[:, z], len(pairs))
                right[:, z] += np.bincount(y, given[:, z], len(pairs))
            both += joint * ((ex * ratio).T @ ey)
        joint = both / both.sum()
        emit = _rows((left + right + s.prior * share[:, None]).T).T
        if fit - last < s.still * n.sum():
            break
        last = fit
    move = _rows(joint + 1e-9)
    after_end = emit[END] * joint.sum(axis=1)
    return _rows(after_end @ move + 1e-9), move, emit


def train(encoded: DataFrame, settings: Settings = Settings()) -> Chain:
    """The chain after ``rounds`` of Baum-Welch over the rows that are not held out."""
    k, texts = settings.states, encoded.filter("not held_out").select("symbols")
    pairs = np.zeros(SYMBOLS * SYMBOLS)
    got = texts.mapInArrow(_pairs, "i long, n long").groupBy("i").agg(F.sum("n").alias("n")).toArrow()  # at most SYMBOLS squared rows
    pairs[got["i"].to_numpy()] = got["n"].to_numpy()
    pairs = pairs.reshape(SYMBOLS, SYMBOLS)
    share = (pairs.sum(axis=0) + settings.prior) / (pairs.sum() + settings.prior * SYMBOLS)
    start, move, emit = from_pairs(pairs, settings)
    chain = Chain(start, move, emit)
    for _ in range(settings.rounds if pairs.any() else 0):
        got = texts.mapInArrow(_sum_expected(chain), "i long, n double").groupBy("i").agg(F.sum("n").alias("n")).toArrow()
        flat = np.zeros(k + k * k + SYMBOLS * k)
        flat[got["i"].to_numpy()] = got["n"].to_numpy()
        start, move, emit = flat[:k], flat[k: k + k * k].reshape(k, k), flat[k + k * k:].reshape(SYMBOLS, k)
        prior = settings.prior
        chain = Chain(_rows(start + prior / k), _rows(move + prior / k), _rows((emit + prior * share[:, None]).T).T)
    return chain


def _likelihood(chain: Chain):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s, off = _sequences(batch)
            log = np.zeros(batch.num_rows)
            for rows in _blocks(off):
                log[rows] = chain.forward(s, off, rows, keep=False)[0]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(log / np.log(10))], names=[*batch.schema.names[1:], "chain"])

    return run


def score_texts(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score (log10) of every row."""
    slim = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), (~learnable()).alias("held_out"))
    counts = slim.filter("not held_out").select("text").mapInArrow(_count, "w long, form int, c long")
    counts = X.stored(counts.groupBy("w").agg(F.first("form").alias("form"), F.sum("c").alias("c")), "word-counts")
    v = vocabulary(counts)
    shared = docs.sparkSession.sparkContext.broadcast((v.words, v.counts, v.symbol, v.mass, v.ends, v.total, v.types))  # LOOKUP words at most
    encoded = X.stored(slim.mapInArrow(_encode(shared), _ENCODED), "encoded-texts")
    chain = train(encoded, settings)
    rare = (encoded.select("row", F.explode("rare").alias("w")).join(counts, "w").groupBy("row")
            .agg(F.sum(F.log10(F.col("c") + 1)).alias("more"), F.count("*").alias("found")))
    names = ["doc_id", "held_out", "n_tokens", "n_known", "base", "inside"]
    likely = encoded.select("symbols", "row", *names).mapInArrow(
        _likelihood(chain), "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, inside double, chain double")
    more = F.coalesce("more", F.lit(0.0))
    return likely.join(rare, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("found", F.lit(0))).alias("n_known"), F.lit(v.total).cast("long").alias("train_tokens"),
        (F.col("base") + more).alias("base_score"), (F.col("chain") + F.col("inside") + more).alias("score"))

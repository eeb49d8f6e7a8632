"""Toxicity: a support vector machine on a subsequence string kernel.

Kernel: words are compared by their subsequences of three letters; a triple
spread over g letters weighs ``DECAY ** g`` (up to ``SPREAD`` letters), so
gaps and inserted characters cost little. Nyström landmarks are word stems
that labelled toxic texts use and clean ones do not; a word's features are its
kernel values with the landmarks, each divided by the landmark's own value and
capped at one and squared, and the fourth powers of these, each times the
inverse root of the landmarks' kernel matrix. Signs inside a word are skipped, so they cost nothing at all; three or
more words of one letter in a row are also taken as one word. ``FLOOR`` drops
zeros only: a single common triple weighs more. A task computes each
distinct word once and keeps the values of up to ``CACHE`` words.
A sentence takes the largest value of its words for each landmark.

Training uses a bounded sample of labelled documents (``Settings``): every
sentence of a clean document is a clean sentence; a toxic document's toxic
sentence is the one that scores highest, picked anew each round. A document's
score is a logistic function, fitted on the sample, of its two highest
sentences, the sum of its sentences' evidence and its length; every whole text
is scored in one pass over the documents.

Defined cases: null, empty and wordless texts have one sentence without
features and get its score; repeated rows get equal scores; without labels of
both kinds, or without any landmark, every score is zero; extra columns are kept as they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urbanlens.llm import text as X

DECAY = 0.7
SPREAD = 6
FLOOR = 1e-3
BLOCK = 1 << 18
CACHE = 1 << 17
#: Weight of the values' fourth powers beside the values; the smaller, the more evidence wide gaps keep.
SHARP = 0.3
LETTERS = 32
#: Distances between the letters of a triple, up to SPREAD letters in all.
STEPS = [(a, b) for a in range(1, SPREAD - 1) for b in range(1, SPREAD - a)]


@dataclass(frozen=True)
class Settings:
    toxic_docs: int = 3000     # labelled documents used, at most
    clean_docs: int = 6000
    landmarks: int = 64
    stem: tuple[int, ...] = (4, 5, 6, 7, 8)
    rounds: int = 3
    epochs: int = 200
    sentences: int = 64        # of one sampled document, the highest first
    cost: float = 300.0
    least: float = 10.0        # of a landmark's log-likelihood ratio
    reach: float = 0.01        # share of the toxic sample that must have it


def letters() -> np.ndarray:
    """Byte to letter number: a-z 1 to 26, digits 27, other ASCII 28, the rest 29 to 31; 0 is white space."""
    t = np.full(256, 28, np.uint8)
    t[:33] = 0
    t[0x30:0x3A] = 27
    t[0x61:0x7B] = t[0x41:0x5B] = np.arange(1, 27)
    t[128:] = 29 + np.arange(128) % 3
    return t


def _triples(codes: np.ndarray, rest: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """For each pair of steps: the triple starting at each position, whether it stays in its word, and its weight.

    ``rest``: how many letters of its word each position has, itself included.
    """
    c = codes.astype(np.int32)
    first, second = c * LETTERS**2, c * LETTERS
    n = len(c)
    for a, b in STEPS:
        if n > a + b:
            yield first[: n - a - b] + second[a: n - b] + c[a + b:], rest[: n - a - b] > a + b, DECAY ** (a + b + 1)


class Landmarks:
    """Kernel values of words against a fixed list of strings."""

    def __init__(self, names: list[bytes]):
        self.names = names
        self.slots: dict[int, int] = {}
        self.cached = np.zeros((1 << 12, len(names)), np.float32)
        table, own = letters(), np.zeros((LETTERS**3, max(1, len(names))))
        for j, name in enumerate(names):
            code = table[np.frombuffer(name, np.uint8)]
            for t, inside, weight in _triples(code, np.arange(len(code), 0, -1)):
                np.add.at(own[:, j], t[inside], weight)
        gram = own.T @ own
        norm = np.maximum(np.diag(gram), 1e-12)
        self.weights = (own / norm).astype(np.float32)
        self.most = self.weights.max(axis=1)
        cap = np.minimum(gram / np.sqrt(np.outer(norm, norm)), 1.0) ** 2
        self.roots = []  # inverse square roots, of the kernel matrix and its fourth power
        for part in (cap, cap**4):
            val, vec = np.linalg.eigh(part)
            self.roots.append(((vec / np.sqrt(np.maximum(val, 1e-3))) @ vec.T).astype(np.float32))

    def mapped(self, features: np.ndarray) -> np.ndarray:
        """The machine's inputs: wide gaps weigh in the values themselves, almost whole words in their fourth powers."""
        return np.hstack([features @ self.roots[0], SHARP * features**4 @ self.roots[1]])

    def words(self, codes: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Indexes of the words with any value of FLOOR or more, and their squared values (word x landmark)."""
        kept = codes != 28
        place = np.cumsum(kept) - kept
        codes, start = codes[kept], place[start] if len(start) else start
        # Words of signs alone have no letters and share their place with the next word.
        real = np.flatnonzero((start < len(codes)) & np.r_[start[1:] != start[:-1], True][: len(start)])
        start = start[real]
        if not len(start) or not self.names:
            return np.zeros(0, np.int64), np.zeros((0, len(self.names)), np.float32)
        size = np.diff(np.r_[start, len(codes)])
        rest = np.minimum(np.repeat(start + size, size) - np.arange(start[0], len(codes)), 255).astype(np.uint8)
        codes, start = codes[start[0]:], start - start[0]
        # White space is no letter: a word's letters end before it.
        gaps = np.add.reduceat(codes == 0, start, dtype=np.int64)
        rest = np.maximum(rest.astype(np.int16) - np.repeat(gaps, size), 0)
        bound = np.zeros(len(codes), np.float32)
        for t, inside, weight in _triples(codes, rest):
            bound[: len(t)] += self.most[t] * (inside * np.float32(weight))
        word = np.flatnonzero(np.add.reduceat(bound, start) >= FLOOR)
        out = np.zeros((len(word), len(self.names)), np.float32)
        if len(word):
            lengths = size[word]
            owner = np.repeat(np.arange(len(word)), lengths)
            place = np.repeat(start[word] - np.cumsum(lengths) + lengths, lengths) + np.arange(lengths.sum())
            for t, inside, weight in _triples(codes[place], rest[place]):
                known = np.flatnonzero(inside & (self.most[t] > 0))
                for i in range(0, len(known), BLOCK):
                    at = known[i: i + BLOCK]
                    rows = owner[at]
                    cut = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
                    out[rows[cut]] += np.float32(weight) * np.add.reduceat(self.weights[t[at]], cut, axis=0)
        out = np.minimum(out, 1.0) ** 2
        out[out < FLOOR**2] = 0
        some = out.any(axis=1)
        return real[word[some]], out[some]

    def spans(self, codes: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The squared values of any spans of ``codes``, a row for each."""
        out = np.zeros((len(start), len(self.names)), np.float32)
        size = end - start + 1  # and a white space
        ends = np.cumsum(size)
        a = 0
        while a < len(start):
            b = max(a + 1, int(np.searchsorted(ends, ends[a] - size[a] + BLOCK, "right")))
            first = ends[a:b] - size[a:b] - (ends[a] - size[a])
            place = np.repeat(start[a:b] - first, size[a:b]) + np.arange(first[-1] + size[b - 1])
            part = codes[np.minimum(place, len(codes) - 1)]
            part[first + size[a:b] - 1] = 0
            word, values = self.words(part, first)
            out[a + word] = values
            a = b
        return out

    def rows(self, w: X.Words, codes: np.ndarray) -> np.ndarray:
        """For each word its row of ``cached``; words not met before are added."""
        h, first, of = np.unique(w.hashes(), return_index=True, return_inverse=True)
        if len(self.slots) + len(h) > CACHE:
            self.slots.clear()
        keys = h.tolist()
        new = np.array([k not in self.slots for k in keys], bool)
        n, more = len(self.slots), int(new.sum())
        if n + more > len(self.cached):
            grown = np.zeros((2 * (n + more), len(self.names)), np.float32)
            grown[:n] = self.cached[:n]
            self.cached = grown
        self.cached[n: n + more] = self.spans(codes, w.start[first[new]], w.end[first[new]])
        self.slots.update(zip(h[new].tolist(), range(n, n + more), strict=True))
        return np.fromiter((self.slots[k] for k in keys), np.int64, len(keys))[of]

    def spelled(self, w: X.Words, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The first word of each run of three or more words of one letter in a document, and the values of the joined letters."""
        letter = (codes != 28) & (codes != 0)
        many = np.add.reduceat(letter & ((w.data & 0xC0) != 0x80), w.start, dtype=np.int64)
        real = np.flatnonzero(many > 0)  # signs alone do not end a run
        if not len(real):
            return real, np.zeros((0, len(self.names)), np.float32)
        one, doc = many[real] == 1, w.doc()[real]
        new = np.r_[True, ~(one[1:] & one[:-1] & (doc[1:] == doc[:-1]))]  # does not go on from the word before
        head = np.flatnonzero(new)
        length = np.diff(np.r_[head, len(real)])
        head, length = head[length >= 3], length[length >= 3]
        if not len(head):
            return head, np.zeros((0, len(self.names)), np.float32)
        # The letters of each run next to each other, then a white space.
        a, b = w.start[real[head]], w.end[real[head + length - 1]]
        kept = np.r_[0, np.cumsum(letter)]
        packed, start, end = codes[letter], kept[a], kept[b]
        return real[head], self.spans(packed, start, end)


def _sentences(w: X.Words) -> tuple[np.ndarray, np.ndarray]:
    """Sentence of each word, and document of each sentence; every document has at least one.

    A sentence ends after a word that ends in . ! or ? and at a line break.
    """
    new = np.zeros(w.n, bool)
    first = w.ptr[:-1][w.counts() > 0]
    if w.n:
        stop = np.isin(w.data[w.end - 1], np.frombuffer(b".!?", np.uint8))
        new[1:] = stop[:-1]
        breaks = np.cumsum(w.data == 10)
        new[1:] |= breaks[w.start[1:]] != breaks[w.start[:-1]]
        new[first] = True
    return np.cumsum(new) - 1, w.doc()[new]


def _features(w: X.Words, marks: Landmarks, table: np.ndarray):
    """Sentences with any kernel value: their documents and features (largest over words)."""
    sentence, doc = _sentences(w)
    out = np.zeros((len(doc), len(marks.names)), np.float32)
    if not w.n:
        return doc, out

    def raise_to(s: np.ndarray, values: np.ndarray) -> None:
        cut = np.flatnonzero(np.r_[True, s[1:] != s[:-1]])
        out[s[cut]] = np.maximum(out[s[cut]], np.maximum.reduceat(values, cut, axis=0))

    codes = table[w.data]
    rows = marks.rows(w, codes)
    for i in range(0, w.n, BLOCK // 4):
        raise_to(sentence[i: i + BLOCK // 4], marks.cached[rows[i: i + BLOCK // 4]])
    head, values = marks.spelled(w, codes)
    if len(head):
        raise_to(sentence[head], values)
    some = out.any(axis=1)
    return doc[some], out[some]


@dataclass
class Model:
    marks: Landmarks | None
    weights: np.ndarray      # of the machine
    logit: np.ndarray        # of ``summary``
    above: float = 0.0       # the machine's offset and one: zero evidence is the margin asked of clean sentences

    def evidence(self, features: np.ndarray) -> np.ndarray:
        """How far a sentence's margin is above that of a clean one."""
        return self.marks.mapped(features) @ self.weights + self.above

    def score(self, summary: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(summary @ self.logit, -30, 30)))


def summary(doc: np.ndarray, evidence: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Per document: 1, the two highest sentences, log of the summed evidence, log of the words,
    log of the evidence per word, and the fourth power of the highest, which only a sure sentence raises."""
    n = len(words)
    out = np.zeros((n, 7))
    out[:, 0] = 1
    order = np.lexsort((-evidence, doc))
    d, e = doc[order], np.maximum(evidence[order], 0)
    if len(d):
        head = np.flatnonzero(np.r_[True, d[1:] != d[:-1]])
        out[d[head], 1] = e[head]
        out[d[head], 6] = np.minimum(e[head], 1.5) ** 4
        second = head[np.r_[head[1:], len(d)] - head > 1] + 1
        out[d[second], 2] = e[second]
        total = np.bincount(d, e, n)
        out[:, 3] = np.log1p(total)
        out[:, 5] = np.log1p(100 * total / np.maximum(words, 20))
    out[:, 4] = np.log1p(words) / 10
    return out


def _sample(docs: DataFrame, labels: DataFrame, s: Settings) -> DataFrame:
    """Up to the stated numbers of labelled documents: (doc_id, text, toxic), picked by a hash of the id."""
    ids = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).filter("doc_id is not null and toxic in (0, 1)")
    ids = ids.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = F.xxhash64(F.col("doc_id"), F.lit(17))
    some = ids.filter("toxic = 1").orderBy(order).limit(s.toxic_docs).unionAll(ids.filter("toxic = 0").orderBy(order).limit(s.clean_docs))
    found = docs.select("doc_id", "text").join(F.broadcast(some), "doc_id")  # at most toxic_docs + clean_docs rows
    # Copies and near copies of one text would make its rare words look telling.
    found = found.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), "toxic").mapInArrow(
        _signed, "doc_id long, text string, toxic int, " + ", ".join(f"m{i} long" for i in range(SEEDS)))
    for i in range(SEEDS):
        found = found.dropDuplicates([f"m{i}", "toxic"])
    return found.select("doc_id", "text", "toxic")


SEEDS = 4


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the least hashes of the three-word shingles, for SEEDS hash functions; shorter texts use the whole text."""
    space = X.byte_table("space")
    for batch in batches:
        data, off = X.column_bytes(batch.column("text"))
        least = np.zeros((SEEDS, batch.num_rows), np.uint64)
        for a, b in X.chunks(off):
            w = X.Words(data, off, a, b, space)
            h = X.SpanHash(w.hashes(), X.BASE_B)
            for i in range(a, b):
                s, e = int(w.ptr[i - a]), int(w.ptr[i - a + 1])
                at = np.arange(s, max(s + 1, e - 2))
                grams = h(at, np.minimum(at + 3, e)) if e > s else np.zeros(1, np.uint64)
                for k in range(SEEDS):
                    least[k, i] = X.mix(grams + np.uint64(k * 0x9E3779B97F4A7C15 & (1 << 64) - 1)).min()
        yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(X.signed(x)) for x in least)],
                                         names=["doc_id", "text", "toxic", *(f"m{i}" for i in range(SEEDS))])


def _stems(lengths: tuple[int, ...]):
    """Task function: each document's distinct word beginnings of the given lengths, and whole words."""
    schema = pa.schema([("stem", pa.binary()), ("toxic", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stems, toxic = [], []
            for text, label in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
                own = {w.strip(b".,!?;:\"'()").lower() for w in (text or "").encode().split()}
                own = {w[:n] for w in own for n in lengths if len(w) >= n}
                stems += own
                toxic += [label] * len(own)
            yield pa.RecordBatch.from_arrays([pa.array(stems, pa.binary()), pa.array(toxic, pa.int32())], schema=schema)

    return run


def choose_landmarks(sample: DataFrame, s: Settings) -> list[bytes]:
    """Word beginnings by how much more often toxic documents have them (signed log-likelihood ratio)."""
    sizes = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    pos, neg = sizes.get(1, 0), sizes.get(0, 0)
    if not pos or not neg:
        return []
    stems = sample.select("text", "toxic").mapInArrow(_stems(s.stem), "stem binary, toxic int")
    stems = stems.groupBy("stem").agg(F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b"))
    stems = stems.filter(F.col("a") >= max(2, s.reach * pos))

    def term(k: Column, e: Column) -> Column:
        return F.when(k > 0, k * F.log(k / e)).otherwise(0.0)

    a, b = F.col("a").cast("double"), F.col("b").cast("double")
    p = (a + b) / (pos + neg)
    ratio = term(a, p * pos) + term(b, p * neg) + term(pos - a, (1 - p) * pos) + term(neg - b, (1 - p) * neg)
    best = (stems.filter(a / pos > 2 * b / neg).withColumn("g", ratio).filter(F.col("g") > s.least)
            .orderBy(F.desc("g"), F.desc(F.length("stem")), "stem").limit(32 * s.landmarks).collect())
    chosen: dict[bytes, tuple[int, float]] = {}
    for r in best:
        stem, toxic, share = bytes(r["stem"]), r["a"], r["a"] / (r["a"] + r["b"])
        # A longer form must be surer, a shorter one must reach more documents.
        idle = any(stem.startswith(c) and share <= 1.2 * p or c.startswith(stem) and toxic <= 1.25 * n for c, (n, p) in chosen.items())
        if not idle and len(chosen) < s.landmarks:
            chosen[stem] = toxic, share
    return list(chosen)


def _training(names: list[bytes], most: int):
    """Task function: (doc_id, toxic, features of one sentence); a document without any gives zeros."""
    schema = pa.schema([("doc_id", pa.int64()), ("toxic", pa.int32()), ("words", pa.int64()), ("f", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks, table, space = Landmarks(names), letters(), X.byte_table("space")
        for batch in batches:
            data, off = X.column_bytes(batch.column("text"))
            ids, toxic = batch.column("doc_id").to_pylist(), batch.column("toxic").to_pylist()
            for a, b in X.chunks(off, BLOCK):
                w = X.Words(data, off, a, b, space)
                doc, f = _features(w, marks, table)
                order = np.lexsort((-f.sum(axis=1), doc))
                rank = np.arange(len(doc)) - np.searchsorted(doc[order], doc[order])
                doc, f = doc[order[rank < most]], f[order[rank < most]]
                none = np.setdiff1d(np.arange(b - a), doc)
                f = np.concatenate([f, np.zeros((len(none), len(names)), np.float32)])
                doc = np.concatenate([doc, none])
                yield pa.RecordBatch.from_arrays([
                    pa.array([ids[a + d] for d in doc], pa.int64()), pa.array([toxic[a + d] for d in doc], pa.int32()), pa.array(w.counts()[doc], pa.int64()),
                    pa.array([x.tobytes() for x in f.astype(np.float32)], pa.binary())], schema=schema)

    return run


def _svm(x: np.ndarray, y: np.ndarray, cost: float, epochs: int) -> tuple[np.ndarray, float]:
    """Linear machine with squared hinge loss, both classes weighing the same, by accelerated gradient steps.

    ``x`` stays in single precision, so that the driver holds it once.
    """
    d = x.shape[1]
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())) * cost
    gram = np.zeros((d + 1, d + 1))
    for i in range(0, len(x), 1 << 16):
        part = np.hstack([x[i: i + (1 << 16)], np.ones((len(x[i: i + (1 << 16)]), 1))])
        gram += (part * weight[i: i + (1 << 16), None]).T @ part
    step = 1.0 / (1.0 + 2 * np.linalg.eigvalsh(gram)[-1])
    v = last = np.zeros(d + 1)
    ridge = np.r_[np.ones(d), 1e-3]
    for t in range(epochs):
        look = v + (t / (t + 3)) * (v - last)
        pull = weight * y * np.maximum(0, 1 - y * (x @ look[:-1].astype(np.float32) + look[-1]))
        last, v = v, look - step * (ridge * look - 2 * np.r_[pull.astype(np.float32) @ x, pull.sum()])
    return v[:-1], float(v[-1])


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    s = settings
    sample = X.stored(_sample(docs, labels, s), "toxic-sample")
    names = choose_landmarks(sample, s)
    if not names:
        return Model(None, np.zeros(0), np.array([-30.0, 0, 0, 0, 0, 0, 0]))
    rows = sample.repartition(8).mapInArrow(_training(names, s.sentences), "doc_id long, toxic int, words long, f binary").toArrow()
    marks = Landmarks(names)
    f = X.column_bytes(rows["f"].combine_chunks())[0].view(np.float32).reshape(-1, len(names))
    _, doc = np.unique(rows["doc_id"].to_numpy(), return_inverse=True)
    order = np.argsort(doc, kind="stable")
    toxic, doc, counts = rows["toxic"].to_numpy()[order], doc[order], rows["words"].to_numpy()[order]
    margin, x = f.max(axis=1)[order], marks.mapped(f)[order]
    del f, rows
    cut = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
    first = toxic[cut]
    for _ in range(s.rounds):
        best = np.maximum.reduceat(margin, cut)
        # A toxic document's highest sentence is its toxic one; its others are left out.
        use = (toxic == 0) | (margin >= best[doc])
        w, offset = _svm(x[use], np.where(toxic[use] > 0, 1.0, -1.0), s.cost, s.epochs)
        margin = x @ w.astype(np.float32)
    above = offset + 1
    return Model(marks, w, _logistic(summary(doc, margin.astype(np.float64) + above, counts[cut]), first), above)


def _logistic(x: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Weights with the least log loss (damped Newton steps, smoothed targets, a light ridge)."""
    pos, neg = (label > 0).sum(), (label <= 0).sum()
    target = np.where(label > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    v, ridge = np.zeros(x.shape[1]), 1e-2 * np.eye(x.shape[1])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ v, -30, 30)))
        h = (x * (p * (1 - p) + 1e-6)[:, None]).T @ x + ridge
        move = np.linalg.solve(h, x.T @ (p - target) + ridge @ v)
        v = v - move * min(1.0, 3.0 / max(1e-12, np.abs(move).max()))
    return v


def _score(model: Model, schema: pa.Schema):
    names = model.marks.names if model.marks else []
    weights, logit, above = model.weights, model.logit, model.above

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = Landmarks(names) if names else None
        m = Model(marks, weights, logit, above)
        table, space = letters(), X.byte_table("space")
        for batch in batches:
            data, off = X.column_bytes(batch.column(0))
            score = np.zeros(batch.num_rows)
            if marks:
                for a, b in X.chunks(off, BLOCK):
                    w = X.Words(data, off, a, b, space)
                    doc, f = _features(w, marks, table)
                    score[a:b] = m.score(summary(doc, m.evidence(f), w.counts()))
            cols = [c for i, c in enumerate(batch.columns) if i] + [pa.array(score)]
            yield pa.RecordBatch.from_arrays(cols, names=[str(i) for i in range(len(cols))]).rename_columns(schema)

    return run


def score(docs: DataFrame, model: Model, keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all by default) of every row, and ``score`` in [0, 1]."""
    keep = list(docs.columns) if keep is None else keep
    name = X.fresh(docs.select(*[f"`{c}`" for c in keep]), "score")[0]
    kept = docs.select(*[f"`{c}`" for c in keep])
    slim = docs.select(F.col("text").cast("string").alias(X.fresh(kept, "_text")[0]), *[F.col(f"`{c}`") for c in keep])
    out = kept.schema.add(name, "double")
    return slim.mapInArrow(_score(model, [f.name for f in out.fields]), out)


def learnable() -> Column:
    """Rows whose labels may be learned: crc32 of the id as text, modulo 3, is not 1."""
    return F.crc32(F.col("doc_id").cast("string")) % 3 != 1


def drop_toxic(docs: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    """The documents that score under ``threshold``, with all their columns."""
    scored = score(docs, model)
    name = scored.columns[-1]
    return scored.filter(F.col(name) < threshold).drop(name)

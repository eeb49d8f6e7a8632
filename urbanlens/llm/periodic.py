"""Periodic runs of words, by suffix trees.

A run is a stretch of words with smallest period q (words q apart are equal)
that no neighbouring word extends. Every run has, in one of the two orders of
the symbols, a Lyndon word of length q as its root, and each place where that
root stands in the run is the longest Lyndon word beginning there. So two
candidates a word hold all runs: from the word to the next smaller suffix, and
to the next greater one. Each candidate is extended to the right by the
longest common extension of its two ends, and to the left by the one of the
reversed text.

The extensions come from Ukkonen's suffix trees of the text and of its
reversal. A tree is walked once (its Euler tour, kept as the depth of the
parent at each step down); the common extension of two suffixes is the least
of these depths between their leaves, which two lookups in a sparse table give.
The order of the leaves is the order of the suffixes.

The trees of many texts are joined to arrays of about ``CHUNK`` words; memory
follows the chunk or the longest single text (about 600 bytes a word).

Defined cases: a null or empty text has no words and no runs; a null id is
never altered; repeated rows each give their row; an empty table gives none;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK = 1 << 15
MIN_WORDS, MIN_PERIODS = 24, 3

SCHEMA = ("doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
          "runs_sha256 string, collapsed_sha256 string")


def suffix_tree(text: list[int], symbols: int) -> tuple[list[int], list[int], list[int], list[int]]:
    """Ukkonen's suffix tree of ``text``, whose last symbol (below ``symbols``) occurs once.

    For every node, the root (0) first: its parent and a place where its edge's
    first symbol stands. Then the inner nodes but the root, and the number of
    symbols from the root to each. The other nodes are the leaves of suffix 0, 1, ...
    """
    n = len(text)
    parent, begin, end = [0], [0], [0]
    inner, depth = [], []
    link: dict[int, int] = {}
    child: dict[int, int] = {}
    node = edge = along = waiting = 0
    new = 1
    for i, c in enumerate(text):
        waiting += 1
        last = 0  # the inner node made last, still without a suffix link
        while waiting:
            if along:
                at = node * symbols + text[edge]
                below = child[at]
                first = begin[below]
                size = end[below] - first
                if along >= size:
                    edge += size
                    along -= size
                    node = below
                    continue
                middle = first + along
                d = text[middle]
                if d == c:
                    along += 1
                    if last:
                        link[last] = node
                    break
                child[at] = new
                child[new * symbols + d] = below
                child[new * symbols + c] = new + 1
                begin[below] = middle
                parent[below] = new
                parent += (node, new)
                begin += (first, i)
                end += (middle, n)
                inner.append(new)
                depth.append(waiting - 1)
                if last:
                    link[last] = new
                last = new
                new += 2
            else:
                at = node * symbols + c
                if last:
                    link[last] = node
                    last = 0
                if at in child:
                    edge, along = i, 1
                    break
                child[at] = new
                parent.append(node)
                begin.append(i)
                end.append(n)
                new += 1
            waiting -= 1
            if node:
                node = link[node]
            elif along:
                along -= 1
                edge = i - waiting + 1
    return parent, begin, inner, depth


class Extensions:
    """Order and longest common extensions of the suffixes of texts laid end to end.

    Each text is a list of symbols from 1 on; it is followed by its own 0.
    ``base[t]`` is the place of text t, ``rank`` the order of all suffixes.
    """

    def __init__(self, texts: Sequence[list[int]]):
        sizes = np.array([len(t) + 1 for t in texts], np.int64)
        self.base = np.concatenate([[0], np.cumsum(sizes)])
        symbols = max(max(t, default=0) for t in texts) + 1
        self.text = np.zeros(self.base[-1], np.int64)
        parents, begins, depths, nodes = [], [], [], []
        for t, a, n in zip(texts, self.base.tolist(), sizes.tolist(), strict=False):
            parent, begin, inner, inner_depth = suffix_tree([*t, 0], symbols)
            self.text[a:a + n - 1] = t
            size = len(parent)
            depth = np.full(size, -1, np.int64)
            depth[0] = 0
            depth[inner] = inner_depth
            depth[depth < 0] = np.arange(n, 0, -1)
            parents.append(np.array(parent, np.int64))
            begins.append(np.array(begin, np.int64))
            depths.append(depth)
            nodes.append(size)
        first = np.concatenate([[0], np.cumsum(nodes)])
        tree = np.repeat(np.arange(len(texts)), nodes)
        parent = np.concatenate(parents) + first[tree]
        depth = np.concatenate(depths)
        symbol = self.text[np.concatenate(begins) + self.base[tree]]
        symbol[first[:-1]] = 0
        # Children by parent, the greatest symbol first, so that a stack gives them in order.
        order = np.argsort(parent * symbols + (symbols - 1 - symbol), kind="stable")
        roots = np.zeros(len(parent), bool)
        roots[first[:-1]] = True
        order = order[~roots[order]]
        ptr = np.zeros(len(parent) + 1, np.int64)
        np.cumsum(np.bincount(parent[order], minlength=len(parent)), out=ptr[1:])
        leaf = ptr[1:] == ptr[:-1]
        tour = np.array(_walk(order.tolist(), ptr.tolist(), first[:-1].tolist()), np.int64)
        at = np.flatnonzero(leaf[tour])
        suffix = self.base[tree[tour[at]] + 1] - depth[tour[at]]
        self.rank = np.empty(len(suffix), np.int64)
        self.rank[suffix] = np.arange(len(suffix))
        # Between two leaves next to each other, the step after the first leaves from their meeting node.
        meet = np.zeros(len(suffix), np.int32)
        meet[1:] = depth[parent[tour[at[:-1] + 1]]]
        self.least = [meet]
        width = 1
        while 2 * width <= int(sizes.max()):
            below = self.least[-1]
            up = below.copy()
            np.minimum(below[:-width], below[width:], out=up[:-width])
            self.least.append(up)
            width *= 2
        self.least = np.stack(self.least)

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many symbols the different suffixes at a and b of one text have in common."""
        a, b = self.rank[a], self.rank[b]
        lo, hi = np.minimum(a, b) + 1, np.maximum(a, b) + 1
        level = np.frexp((hi - lo).astype(np.float64))[1] - 1
        return np.minimum(self.least[level, lo], self.least[level, hi - (1 << level)])


def _walk(order: list[int], ptr: list[int], roots: list[int]) -> list[int]:
    """All nodes in the order in which a walk through the trees meets them."""
    out: list[int] = []
    meet = out.append
    for root in roots:
        stack = [root]
        take = stack.pop
        while stack:
            v = take()
            meet(v)
            stack += order[ptr[v]:ptr[v + 1]]
    return out


def next_smaller(rank: list[int]) -> list[int]:
    """For each place the next one with a smaller value, or the length."""
    n = len(rank)
    rank = [*rank, -1]
    out = [n] * n
    for i in range(n - 1, -1, -1):
        r, j = rank[i], i + 1
        while rank[j] > r:
            j = out[j]
        out[i] = j
    return out


def find_runs(texts: Sequence[list[int]], min_words: int = MIN_WORDS, min_periods: int = MIN_PERIODS):
    """All runs of each text (symbols from 1 on): arrays text, start, length, period by text, start, period.

    A run has at least ``min_words`` words and ``min_periods`` (2 or more) periods.
    """
    none = tuple(np.zeros(0, np.int64) for _ in range(4))
    texts = list(texts)
    if not any(len(t) >= max(min_words, min_periods) for t in texts):
        return none
    ext = Extensions(texts)
    size = np.diff(ext.base)
    owner = np.repeat(np.arange(len(texts)), size)
    smaller = np.array(next_smaller(ext.rank.tolist()))
    greater = np.array(next_smaller((len(ext.rank) - 1 - ext.rank).tolist()))
    i = np.tile(np.arange(len(owner)), 2)
    j = np.concatenate([smaller, greater])
    # The first root in a run of two periods or more begins in its first period, so the right
    # extension is longer than what is left of min_periods - 2 periods.
    t = np.concatenate([owner, owner])
    inside = (j < ext.base[t + 1] - 1) & (min_periods * (j - i) < size[t])
    i, j, t = i[inside], j[inside], t[inside]
    same = ext.text[i] == ext.text[j]
    i, j, t = i[same], j[same], t[same]
    right = ext.common(i, j).astype(np.int64)
    far = right > (min_periods - 2) * (j - i)
    i, j, t, right = i[far], j[far], t[far], right[far]
    if not len(i):
        return none
    # Only texts with a candidate left need the tree of their reversal.
    some = np.unique(t)
    back = Extensions([texts[x][::-1] for x in some.tolist()])
    at = np.searchsorted(some, t)
    last = ext.base[t + 1] - 1
    left = back.common(back.base[at] + last - i, back.base[at] + last - j).astype(np.int64)
    start, period = i - left - ext.base[t], j - i
    length = right + left + period
    whole = (length >= min_words) & (length >= min_periods * period)
    found = np.unique(np.stack([t, start, period, length], 1)[whole], axis=0)
    return found[:, 0], found[:, 1], found[:, 3], found[:, 2]


def stretched(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words of a document, with the tail of every tenth document (by checksum of its id) made periodic."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    unit = words[a:a + p]
    return (words[:a] + unit * -(-(n - a) // p))[:n]


def summary(words: list[bytes], start: list[int], length: list[int], period: list[int]) -> tuple:
    """n_runs, the run of the highest exponent and the two digests."""
    lines = "".join(f"{s},{m},{q}\n" for s, m, q in zip(start, length, period, strict=True))
    if not start:
        top: tuple = (None, None, None, None)
        kept = words
    else:
        best = 0
        gone = np.zeros(len(words) + 1, np.int64)
        for k, (s, m, q) in enumerate(zip(start, length, period, strict=True)):
            gone[s + q] += 1
            gone[s + m] -= 1
            if m * period[best] > length[best] * q:
                best = k
        s, m, q = start[best], length[best], period[best]
        top = (s, m, q, 1000 * m // q)
        kept = [words[k] for k in np.flatnonzero(np.cumsum(gone[:-1]) == 0).tolist()]
    return (len(start), *top, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(b" ".join(kept)).hexdigest())


def _runs_of_batches(change):
    schema = pa.schema([(c, pa.int64()) for c in ("doc_id", "n_runs", "start", "length", "period", "exponent_milli")]
                       + [("runs_sha256", pa.string()), ("collapsed_sha256", pa.string())])

    def rows(ids, texts, words) -> pa.RecordBatch:
        t, start, length, period = find_runs(texts)
        ptr = np.searchsorted(t, np.arange(len(texts) + 1)).tolist()
        start, length, period = start.tolist(), length.tolist(), period.tolist()
        out = [(d, *summary(w, start[a:b], length[a:b], period[a:b]))
               for d, w, a, b in zip(ids, words, ptr[:-1], ptr[1:], strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, words, total = [], [], [], 0
        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary()), strict=True):
                w = change((text.as_py() or b"").split(), doc)
                number: dict[bytes, int] = {}
                ids.append(doc)
                words.append(w)
                texts.append([number.setdefault(x, len(number) + 1) for x in w])
                total += len(w) + 1
                if total >= CHUNK:
                    yield rows(ids, texts, words)
                    ids, texts, words, total = [], [], [], 0
        if ids:
            yield rows(ids, texts, words)

    return run


def periodic_runs(docs: DataFrame, change=stretched) -> DataFrame:
    """One row per document: its number of runs, the one with most periods, and digests of all runs and of the words kept.

    ``change(words, doc_id)`` gives the words to look at. The words kept are those in no run after its first period.
    """
    slim = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return slim.mapInArrow(_runs_of_batches(change), SCHEMA)

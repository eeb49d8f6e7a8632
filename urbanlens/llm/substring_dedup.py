"""Substring deduplication by De Bruijn compaction over word k-mers.

The edges are ``K``-word k-mers. Walking a text, the k-mers between two
neighbouring selected ones (the leftmost minimum hash of every window of
``WINDOW`` words) form a path without a branch, so a task writes it as one
row: the selected k-mer, the place and number of the windows that select it,
and the digest of all words those windows cover. Equal words select equal
k-mers, so equal windows lie on paths through the same k-mer.

Spark joins then compact across documents. A k-mer that occurs once ends
there. Paths with equal digests are one path; each copy in a document after
the first is repeated as a whole. A k-mer with one digest does not branch and
is done; where it branches, its first copies are unrolled into windows with
their source coordinates (document, position), and a window is repeated if
its whole content also starts in an earlier document. Nothing is decided by
k-mers alone: digests of the full content (128 bits for a path; 64 and the
k-mer's 64 for a window) verify every span.

Hot paths (a text copied by a third of all rows) are counted with partial
aggregates and joined; no group is gathered and pairs are never listed.

Defined cases: a null or empty text has no words and keeps nothing; fewer
than ``WINDOW`` words are kept whole; rows that share an id are no source for
each other and are judged alike if their texts are equal; a null id counts as
the last document; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urbanlens.llm import text as X

WINDOW = 50
K = 12


def _windows(w: X.Words, h: np.ndarray, window: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows inside one document: starts, the selected k-mers' places, and all k-mer hashes."""
    none = np.zeros(0, np.int64)
    if w.n < window:
        return none, none, none.astype(np.uint64)
    at = np.arange(w.n - k + 1)
    grams = X.SpanHash(h, X.BASE_B)(at, at + k)
    pick = X.first_min(grams, window - k + 1)
    doc = w.doc()
    p = np.arange(len(pick))
    p = p[doc[p] == doc[p + window - 1]]
    return p, pick[p], grams


def _paths(window: int, k: int):
    schema = pa.schema([("id", pa.int64()), ("key", pa.int64()), ("lo", pa.int32()), ("m", pa.int32()),
                        ("a", pa.int64()), ("s1", pa.int64()), ("s2", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space = X.byte_table("space")
        for batch in batches:
            data, off = X.column_bytes(batch.column("text"))
            ids, keys = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("id", "key"))
            for a, b in X.chunks(off):
                w = X.Words(data, off, a, b, space)
                h = w.hashes()
                p, pick, grams = _windows(w, h, window, k)
                if not len(p):
                    continue
                # A run of windows with one selected k-mer; runs never cross documents, as k-mers do not.
                head = np.flatnonzero(np.r_[True, (pick[1:] != pick[:-1]) | (p[1:] != p[:-1] + 1)])
                m = np.diff(np.r_[head, len(p)])
                lo, hi = p[head], p[head] + m - 1 + window
                doc = w.doc()[lo]
                cols = (ids[a + doc], keys[a + doc], (lo - w.ptr[doc]).astype(np.int32), m.astype(np.int32), X.signed(grams[pick[head]]),
                        X.signed(X.SpanHash(h, X.BASE_A)(lo, hi)), X.signed(X.SpanHash(h, X.BASE_B)(lo, hi)))
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], schema=schema)

    return run


def _unroll(window: int, k: int):
    """Task function on texts with the paths to unroll: one row per window."""
    schema = pa.schema([("id", pa.int64()), ("key", pa.int64()), ("p", pa.int32()), ("a", pa.int64()), ("c", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space = X.byte_table("space")
        for batch in batches:
            data, off = X.column_bytes(batch.column("text"))
            ids, keys = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("id", "key"))
            todo, ptr = batch.column("todo").flatten(), batch.column("todo").offsets.to_numpy()
            ptr = ptr - ptr[0]
            lo, m, a_ = (todo.field(i).to_numpy(zero_copy_only=False) for i in range(3))
            for a, b in X.chunks(off):
                w = X.Words(data, off, a, b, space)
                s, e = ptr[a], ptr[b]
                of = np.repeat(np.arange(a, b), np.diff(ptr[a: b + 1]))
                n = m[s:e].astype(np.int64)
                if not n.sum():
                    continue
                row = np.repeat(np.arange(s, e), n)
                step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                own = np.repeat(of, n)
                p = lo[row] + step
                at = w.ptr[own - a] + p
                c = X.SpanHash(w.hashes(), X.BASE_A)(at, at + window)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (ids[own], keys[own], p.astype(np.int32), a_[row], X.signed(c))], schema=schema)

    return run


def repeated_spans(docs: DataFrame, window: int = WINDOW, k: int = K) -> DataFrame:
    """(id, key, spans): the word spans [lo, hi) to remove, per document that has any; they may overlap."""
    slim = docs.select(X.id_key().alias("id"), X.text_key().alias("key"), F.col("text").cast("string").alias("text"))
    paths = X.stored(slim.mapInArrow(_paths(window, k), "id long, key long, lo int, m int, a long, s1 long, s2 long"), "paths")
    # The sides of a join are written first: a hot key is then split, which an aggregate beside it would prevent.
    shared = X.stored(paths.groupBy("a").count().filter("count > 1").select("a"), "shared-kmers")
    paths = X.stored(paths.join(shared, "a", "left_semi"), "shared-paths")
    kinds = X.stored(paths.groupBy("s1", "s2").agg(F.min("id").alias("first"), F.first("a").alias("a"), F.count("*").alias("n")), "path-kinds")
    # Only kinds that recur or branch need a look; the others have no equal window elsewhere.
    branch = X.stored(kinds.groupBy("a").agg(F.count("*").alias("kinds")).filter("kinds > 1").select("a"), "branching-kmers")
    later = (paths.join(kinds.filter("n > 1").select("s1", "s2", "first"), ["s1", "s2"]).filter("id > first")
             .select("id", "key", "lo", (F.col("lo") + F.col("m") - 1 + window).alias("hi")))
    first = paths.join(kinds.join(branch, "a", "left_semi").select("s1", "s2", "first"), ["s1", "s2"]).filter("id = first")
    todo = first.groupBy("id", "key").agg(F.sort_array(F.collect_set(F.struct("lo", "m", "a"))).alias("todo"))
    windows = slim.join(todo, ["id", "key"]).dropDuplicates(["id", "key"]).select("id", "key", "text", "todo").mapInArrow(
        _unroll(window, k), "id long, key long, p int, a long, c long")
    windows = X.stored(windows, "windows")
    early = X.stored(windows.groupBy("a", "c").agg(F.min("id").alias("first"), F.max("id").alias("last"))
                     .filter("first < last").select("a", "c", "first"), "repeated-windows")
    again = (windows.join(early, ["a", "c"]).filter("id > first")
             .select("id", "key", F.col("p").alias("lo"), (F.col("p") + window).alias("hi")))
    return later.unionAll(again).groupBy("id", "key").agg(F.sort_array(F.collect_set(F.struct("lo", "hi"))).alias("spans"))


def _cut(schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_removed, kept = [], [], []
            for text, spans in zip(batch.column("text"), batch.column("spans"), strict=True):
                words = text.as_buffer().to_pybytes().split() if text.is_valid else []
                n_words.append(len(words))
                if spans.is_valid:
                    left, at = [], 0
                    for s in spans.as_py():
                        left += words[at: s["lo"]]
                        at = max(at, s["hi"])
                    words = left + words[at:]
                n_removed.append(n_words[-1] - len(words))
                kept.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                                              pa.array(kept, pa.binary()).cast(pa.string())], schema=schema)

    return run


def dedup_substrings(docs: DataFrame, window: int = WINDOW, k: int = K) -> DataFrame:
    """doc_id, n_words, n_removed and the kept words joined by one space, for every row."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())])
    slim = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text"), X.id_key().alias("id"), X.text_key().alias("key"))
    marked = slim.join(repeated_spans(docs, window, k), ["id", "key"], "left").select("doc_id", "text", "spans")
    return marked.mapInArrow(_cut(schema), "doc_id long, n_words long, n_removed long, kept string")

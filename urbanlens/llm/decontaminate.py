"""Benchmark decontamination by winnowing.

A window is ``WINDOW`` consecutive words of a benchmark item (a shorter item
is one window). Every window of ``WINDOW`` words selects the leftmost minimum
of its ``K``-gram hashes, so a span of that length shared by a document and an
item selects the same k-gram in both. The selected fingerprints are joined
with Spark; a hit carries the words around it, and is extended left and right
word by word. Only equal words count, so a hash collision adds nothing.

A bounded set of benchmark fingerprints (``PREFILTER_MAX``) is sent to the
tasks to drop fingerprints that cannot join; a larger benchmark goes through
the join alone, with the same rows.

Defined cases: null or empty text has no words, is never contaminated and as
an item has no window; repeated rows are judged one by one; null ids are kept
as null; an item without an id hits but is not named; an empty benchmark hits
nothing; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urbanlens.llm import text as X

WINDOW = 10
K = 5
PREFILTER_MAX = 200_000

_CAND = "doc_id long, row long, key long, n_words long, pos long, fp long, size int, left int, ctx string"
_SCHEMA = pa.schema([("doc_id", pa.int64()), ("row", pa.int64()), ("key", pa.int64()), ("n_words", pa.int64()),
                     ("pos", pa.int64()), ("fp", pa.int64()), ("size", pa.int32()), ("left", pa.int32()),
                     ("ctx", pa.string())])


def _selected(w: X.Words, h: np.ndarray, window: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the winnowed k-grams, once each, and their fingerprints."""
    none = np.zeros(0, np.int64)
    if w.n < window:
        return none, none.astype(np.uint64)
    at = np.arange(w.n - k + 1)
    grams = X.SpanHash(h, X.BASE_B)(at, at + k)
    pick = X.first_min(grams, window - k + 1)
    p = np.arange(len(pick))
    doc = w.doc()
    pick = np.unique(pick[doc[p] == doc[p + window - 1]])
    return pick, grams[pick]


def _short(w: X.Words, h: np.ndarray, sizes: list[int]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    doc = w.doc()
    for n in sizes:
        if w.n >= n:
            at = np.arange(w.n - n + 1)
            at = at[doc[at] == doc[at + n - 1]]
            yield n, at, X.SpanHash(h, X.BASE_B)(at, at + n) + np.uint64(n)


def fingerprints(window: int, k: int, sizes: list[int] | None, known: np.ndarray | None):
    """Task function: one row per input row (pos -1) and one per fingerprint.

    ``sizes`` None marks benchmark items: an item shorter than the window
    gives its whole sequence. Else these short lengths are tried everywhere.
    """
    is_word, fold = X.byte_table("alnum"), X.fold_table()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        row0 = TaskContext.get().partitionId() << 33
        for batch in batches:
            data, off = X.column_bytes(batch.column("text"))
            ids, keys = batch.column("doc_id").to_pylist(), batch.column("key").to_pylist()
            for a, b in X.chunks(off):
                w = X.Words(data, off, a, b, is_word, fold)
                h, cnt, doc = w.hashes(), w.counts(), w.doc()
                found = [(window, *_selected(w, h, window, k))]
                if sizes is None:
                    few = np.flatnonzero((cnt > 0) & (cnt < window))
                    found += [(int(cnt[i]), w.ptr[i: i + 1], X.SpanHash(h, X.BASE_B)(w.ptr[i: i + 1], w.ptr[i + 1: i + 2]) + np.uint64(cnt[i]))
                              for i in few]
                else:
                    found += list(_short(w, h, sizes))
                cols: list[list] = [ids[a:b], list(range(row0 + a, row0 + b)), keys[a:b], cnt.tolist(),
                                    [-1] * (b - a), [0] * (b - a), [0] * (b - a), [0] * (b - a), [None] * (b - a)]
                for size, at, fp in found:
                    if known is not None and len(at):
                        i = np.minimum(np.searchsorted(known, fp), len(known) - 1)
                        hit = known[i] == fp if len(known) else np.zeros(len(at), bool)
                        at, fp = at[hit], fp[hit]
                    more = window - k if size == window else 0
                    length = k if size == window else size
                    for p, f in zip(at.tolist(), X.signed(fp).tolist(), strict=True):
                        d = int(doc[p])
                        lo, hi = max(p - more, int(w.ptr[d])), min(p + length + more, int(w.ptr[d + 1]))
                        ctx = b" ".join(w.word(i) for i in range(lo, hi)).decode("utf-8", "replace")
                        for c, v in zip(cols, (ids[a + d], row0 + a + d, keys[a + d], int(cnt[d]), p - int(w.ptr[d]), f, size, p - lo, ctx), strict=True):
                            c.append(v)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _SCHEMA, strict=True)], schema=_SCHEMA)
            row0 += batch.num_rows

    return run


def extend(window: int, k: int):
    """Task function on joined hits: the hit words [lo, hi) of the document.

    The shared k-gram is extended over equal words on both sides inside the
    two contexts; a span that reaches the window's length is kept.
    """
    schema = pa.schema([("row", pa.int64()), ("lo", pa.int64()), ("hi", pa.int64()), ("item", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for row, pos, size, left, ctx, ileft, ictx, item in zip(*(batch.column(c).to_pylist() for c in (
                    "row", "pos", "size", "left", "ctx", "ileft", "ictx", "item")), strict=True):
                d, t = ctx.split(" "), ictx.split(" ")
                length = k if size == window else size
                if d[left: left + length] != t[ileft: ileft + length]:
                    continue
                x, y = 0, length
                while x < min(left, ileft) and d[left - x - 1] == t[ileft - x - 1]:
                    x += 1
                while left + y < len(d) and ileft + y < len(t) and d[left + y] == t[ileft + y]:
                    y += 1
                if x + y >= size:
                    for c, v in zip(out, (row, pos - x, pos + y, item), strict=True):
                        c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, schema, strict=True)], schema=schema)

    return run, "row long, lo long, hi long, item string"


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, k: int = K) -> DataFrame:
    """One row per document row: doc_id, key (hash of the text), n_words, n_hit, items (sorted item ids as strings)."""
    slim = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), X.text_key().alias("key"))
    items = benchmark.select(F.monotonically_increasing_id().alias("doc_id"), F.col("text").cast("string"),
                             F.lit(0).cast("long").alias("key"), F.col("item_id").cast("string").alias("item_id"))
    items = X.stored(items, "bench-items")
    grams = items.select("doc_id", "text", "key").mapInArrow(fingerprints(window, k, None, None), _CAND).filter("pos >= 0")
    grams = X.stored(grams.join(items.select("doc_id", "item_id"), "doc_id").select(
        "fp", "size", F.col("left").alias("ileft"), F.col("ctx").alias("ictx"), F.col("item_id").alias("item")).distinct(), "bench")
    sizes = sorted(r[0] for r in grams.filter(F.col("size") < window).select("size").distinct().collect())
    few = grams.select("fp").distinct().limit(PREFILTER_MAX + 1).toPandas()["fp"].to_numpy(np.int64)
    known = np.sort(few.view(np.uint64)) if len(few) <= PREFILTER_MAX else None
    cand = X.stored(slim.mapInArrow(fingerprints(window, k, sizes, known), _CAND), "fingerprints")
    run, schema = extend(window, k)
    hits = (cand.filter("pos >= 0").select("row", "pos", "size", "left", "ctx", "fp")
            .join(grams, ["fp", "size"]).mapInArrow(run, schema))
    # Hit words of a row: the spans, merged; a row's spans are as many as its own hits.
    spans = hits.select("row", "lo", "hi").distinct().groupBy("row").agg(
        F.aggregate(F.array_sort(F.collect_list(F.struct("lo", "hi"))), F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end")),
                    lambda acc, s: F.struct((acc["n"] + F.greatest(F.lit(0), s["hi"] - F.greatest(s["lo"], acc["end"]))).alias("n"),
                                            F.greatest(acc["end"], s["hi"]).alias("end")))["n"].alias("n_hit"))
    named = hits.select("row", "item").distinct().groupBy("row").agg(F.array_sort(F.collect_list("item")).alias("items"))
    found = X.stored(spans.join(named, "row", "left"), "hit-rows")
    return (cand.filter("pos < 0").select("row", "doc_id", "key", "n_words").join(found, "row", "left")
            .select("doc_id", "key", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
                    F.coalesce("items", F.array().cast("array<string>")).alias("items")))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without any hit, with all their columns."""
    return X.drop_keyed(docs, contamination(docs, benchmark).filter("n_hit > 0"))

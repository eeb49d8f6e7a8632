"""Words, spans and hashes of whole texts as numpy arrays.

All functions work on the bytes of one Arrow string column. A batch is cut at
document boundaries into chunks of about ``CHUNK`` bytes, so memory follows
the chunk (or the longest single text), not the batch or the partition.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from urbanlens.session import scratch_path

CHUNK = 4 << 20
#: Stands for a null id: sorts behind every real one.
NO_ID = (1 << 63) - 1

BASE_A = np.uint64(0x9E3779B97F4A7C15)
BASE_B = np.uint64(0xD6E8FEB86659FD93)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared scratch folder and read back.

    Cuts the lineage: a lost executor costs a reread, not the work before.
    """
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex[:6]}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names like ``names`` that ``df`` does not have yet."""
    have = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in have:
            n += "_"
        have.add(n.lower())
        out.append(n)
    return out


def drop_keyed(docs: DataFrame, bad: DataFrame) -> DataFrame:
    """``docs`` without the rows whose (id, text hash) is in ``bad`` (doc_id, key)."""
    i, k = fresh(docs, "_id", "_key")
    bad = bad.select(id_key().alias(i), F.col("key").alias(k)).distinct()
    keyed = docs.withColumns({i: id_key(), k: text_key()})
    return keyed.join(bad, [i, k], "left_anti").select(*[f"`{c}`" for c in docs.columns])


def id_key(col: str = "doc_id") -> Column:
    return F.coalesce(F.col(col).cast("long"), F.lit(NO_ID))


def text_key(col: str = "text") -> Column:
    return F.xxhash64(F.coalesce(F.col(col), F.lit("")))


def byte_table(word: str) -> np.ndarray:
    """Which bytes belong to words: ``space`` (all but 20, 09-0D) or ``alnum``."""
    t = np.ones(256, bool)
    if word == "space":
        t[[0x20, 9, 10, 11, 12, 13]] = False
    else:
        t[:128] = False
        t[0x30:0x3A] = t[0x41:0x5B] = t[0x61:0x7B] = True
    return t


def fold_table() -> np.ndarray:
    """Lower-cases A-Z; every other byte stays."""
    t = np.arange(256, dtype=np.uint8)
    t[0x41:0x5B] += 32
    return t


def column_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Data bytes and the n+1 offsets of a string column; nulls are empty."""
    if pa.types.is_null(col.type):
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    if col.null_count:
        col = col.fill_null("")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, off, data = col.buffers()
    if len(col) == 0 or off is None:
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    o = np.frombuffer(off, np.int64 if wide else np.int32)[col.offset: col.offset + len(col) + 1].astype(np.int64)
    d = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return d[o[0]: o[-1]], o - o[0]


def chunks(offsets: np.ndarray, size: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Document ranges [a, b) of about ``size`` bytes; a longer text stands alone."""
    n, a = len(offsets) - 1, 0
    while a < n:
        b = int(np.searchsorted(offsets, offsets[a] + size, "right")) - 1
        b = min(max(b, a + 1), n)
        yield a, b
        a = b


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def powers(base: np.uint64, n: int) -> np.ndarray:
    p = np.full(n + 1, base, np.uint64)
    p[0] = 1
    return np.multiply.accumulate(p)


def inverse(base: np.uint64) -> np.uint64:
    return np.uint64(pow(int(base), -1, 1 << 64))


class SpanHash:
    """Polynomial hashes mod 2^64 of any spans of one array, from prefix sums."""

    def __init__(self, values: np.ndarray, base: np.uint64):
        n = len(values)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values * powers(base, n)[:n], out=self.sums[1:])
        self.back = powers(inverse(base), n)

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.back[start] + (end - start).astype(np.uint64))


class Words:
    """The words of documents [a, b) of a batch.

    ``start``/``end``: byte spans in ``data`` (which holds these documents
    only, folded if asked); ``ptr[i]:ptr[i+1]``: the words of document i.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, a: int, b: int,
                 is_word: np.ndarray, fold: np.ndarray | None = None):
        lo, hi = int(offsets[a]), int(offsets[b])
        self.data = data[lo:hi] if fold is None else fold[data[lo:hi]]
        self.offsets = offsets[a: b + 1] - lo
        m = is_word[self.data]
        first = np.zeros(len(m) + 1, bool)
        first[self.offsets] = True
        s, e = m.copy(), m.copy()
        if len(m):
            s[1:] &= ~m[:-1] | first[1:-1]
            e[:-1] &= ~m[1:] | first[1:-1]
        self.start, self.end = np.flatnonzero(s), np.flatnonzero(e) + 1
        self.ptr = np.searchsorted(self.start, self.offsets)
        self.n = len(self.start)

    def counts(self) -> np.ndarray:
        return np.diff(self.ptr)

    def doc(self) -> np.ndarray:
        """The document (0-based in the chunk) of every word."""
        return np.repeat(np.arange(len(self.ptr) - 1), self.counts())

    def hashes(self, seg: int = 1 << 20) -> np.ndarray:
        """A 64-bit hash of each word; long texts go in pieces of about ``seg`` bytes."""
        out = np.empty(self.n, np.uint64)
        i = 0
        while i < self.n:
            j = max(int(np.searchsorted(self.end, self.start[i] + seg, "right")), i + 1)
            lo, hi = int(self.start[i]), int(self.end[j - 1])
            out[i:j] = SpanHash(self.data[lo:hi].astype(np.uint64) + np.uint64(1), BASE_A)(
                self.start[i:j] - lo, self.end[i:j] - lo)
            i = j
        return out

    def word(self, i: int) -> bytes:
        return self.data[self.start[i]: self.end[i]].tobytes()


def first_min(h: np.ndarray, w: int) -> np.ndarray:
    """Index of the leftmost minimum of h[p:p+w] for each p (len(h)-w+1 values).

    Compares the high 34 bits, then the position: the choice depends on the
    window's own values only.
    """
    n = len(h)
    if n < w:
        return np.zeros(0, np.int64)
    low = np.uint64((1 << 30) - 1)
    k = (h & ~low) | np.arange(n, dtype=np.uint64)
    span = 1
    while span * 2 <= w:
        k = np.minimum(k[:-span], k[span:])
        span *= 2
    rest = w - span
    if rest:
        k = np.minimum(k[:len(k) - rest], k[rest:])
    return (k & low).astype(np.int64)


def signed(h: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(h).view(np.int64)

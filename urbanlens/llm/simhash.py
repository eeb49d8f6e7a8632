"""SimHash near-duplicates by bit-sliced comparison.

Fingerprint: A-Z lower-cased, words split at white space, XXH64 (seed 42) of
the joined 3-word shingles, repeats included; a bit is 1 if set in over half.
Distinct fingerprints are cut into five blocks of bits. Two that differ in at
most three bits agree on at least two blocks, so they meet under one of the
ten pairs of blocks. What meets is compared in vertical form: one bit plane
per position, distances in carry-save counters for 64 candidates a machine
word, and a block of candidates is left once all exceed the radius.

A key shared by more than ``HOT`` fingerprints is cut into tiles, and every
pair of tiles is compared in its own group, so no task gets an unbounded
group. A group passes on a spanning forest of its links, never all pairs.

Defined cases: null, empty or blank text has fingerprint zero and links like
any other; fewer than three words are one shingle; repeated rows share a
component; a null id is never the component's id unless it has no other.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urbanlens.llm import text as X
from urbanlens.llm.components import connected_components

SHINGLE = 3
RADIUS = 3
HOT = 8192
TILE = 1024
#: Bits of the five blocks, low first.
BLOCKS = (13, 13, 13, 13, 12)


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The SimHash of one text (already UTF-8), unsigned."""
    import xxhash

    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    k = min(shingle, len(words))
    size = np.fromiter(map(len, words), np.int64, len(words)) + 1
    start = np.zeros(len(words), np.int64)
    np.cumsum(size[:-1], out=start[1:])
    end = (start + size - 1)[k - 1:].tolist()
    start = start[: len(end)].tolist()
    ones, step = np.zeros(64, np.int64), 1 << 18
    for i in range(0, len(end), step):
        h = np.fromiter(map(xxhash.xxh64_intdigest, [joined[s:e] for s, e in zip(start[i:i + step], end[i:i + step], strict=True)], repeat(42)),
                        np.uint64, len(end[i:i + step]))
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(end), bitorder="little").view(np.uint64)[0])


def _fingerprints(shingle: int):
    schema = pa.schema([("doc_id", pa.int64()), ("key", pa.int64()), ("fp", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.fromiter((fingerprint(t.as_buffer().to_pybytes() if t.is_valid else b"", shingle) for t in batch.column("text")),
                              np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("key"), pa.array(X.signed(fps))], schema=schema)

    return run


def _keys() -> Column:
    """Ten keys: the number of the pair of blocks, then the bits of both."""
    at = [sum(BLOCKS[:i]) for i in range(len(BLOCKS))]
    bits = [F.shiftrightunsigned("fp", a).bitwiseAND(F.lit((1 << n) - 1)) for a, n in zip(at, BLOCKS, strict=True)]
    return F.array(*[(F.lit(t << 32) + F.shiftleft(bits[i], 13) + bits[j]).cast("long")
                     for t, (i, j) in enumerate(combinations(range(len(BLOCKS)), 2))])


def bit_planes(fps: np.ndarray) -> np.ndarray:
    """64 rows of bit vectors: row b holds bit b of every fingerprint, 64 to a word."""
    bits = np.unpackbits(fps.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    pad = -len(fps) % 64
    bits = np.pad(bits, ((0, pad), (0, 0)))
    return np.ascontiguousarray(np.packbits(bits.T, axis=1, bitorder="little")).view(np.uint64)


def near_pairs(left: np.ndarray, right: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (i, j) with at most ``radius`` differing bits, by vertical counters.

    The counters hold 0 to ``2^c - 1`` in c bit vectors; ``over`` marks
    candidates past the radius. After every eight planes the left rows whose
    whole block is over are dropped.
    """
    planes = bit_planes(right)
    n_words = planes.shape[1]
    live = np.arange(len(left))
    c = max(1, int(radius).bit_length())
    counters = np.zeros((c, len(left), n_words), np.uint64)
    over = np.zeros((len(left), n_words), np.uint64)
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    if len(right) % 64:
        over[:, -1] = full << np.uint64(len(right) % 64)
    for b in range(64):
        flip = np.where((left[live] >> np.uint64(b)) & np.uint64(1), full, np.uint64(0))
        carry = planes[b][None, :] ^ flip[:, None]
        for level in counters:
            sums = level ^ carry
            carry &= level
            level[:] = sums
        over |= carry
        if radius + 1 < 1 << c:
            over |= _exceeds(counters, radius)
        if b % 8 == 7:
            stay = (over != full).any(axis=1)
            if not stay.all():
                live, over, counters = live[stay], over[stay], counters[:, stay]
                if not len(live):
                    break
    if not len(live):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    near = np.unpackbits((~over).view(np.uint8), axis=1, bitorder="little")[:, : len(right)]
    i, j = np.nonzero(near)
    return live[i], j


def _exceeds(counters: np.ndarray, radius: int) -> np.ndarray:
    """Where the counted number is over ``radius`` (compared bit by bit)."""
    more = np.zeros_like(counters[0])
    same = ~more
    for level in range(len(counters) - 1, -1, -1):
        if radius >> level & 1:
            same &= counters[level]
        else:
            more |= same & counters[level]
            same &= ~counters[level]
    return more


def forest(fps: np.ndarray, radius: int = RADIUS, tile: int = TILE) -> tuple[np.ndarray, np.ndarray]:
    """Links that join the same groups as all pairs within ``radius``: each to its group's first."""
    label = np.arange(len(fps))
    for a in range(0, len(fps), tile):
        for b in range(a, len(fps), tile):
            i, j = near_pairs(fps[a:a + tile], fps[b:b + tile], radius)
            i, j = i + a, j + b
            keep = i < j
            i, j = i[keep], j[keep]
            while True:
                x, y = label[i], label[j]
                if (x == y).all():
                    break
                low = np.minimum(x, y)
                np.minimum.at(label, x, low)
                np.minimum.at(label, y, low)
                while (label != label[label]).any():
                    label = label[label]
    child = np.flatnonzero(label != np.arange(len(fps)))
    return fps[child], fps[label[child]]


def _links(radius: int):
    """Task function over rows sorted by group: blocks of whole groups, compared all at once."""
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def edges(grp: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
        cut = np.concatenate([[0], np.flatnonzero((grp[1:] != grp[:-1]).any(axis=1)) + 1, [len(fps)]])
        out, a = [], 0
        while a < len(cut) - 1:
            b = max(int(np.searchsorted(cut, cut[a] + TILE, "right")) - 1, a + 1)
            if cut[b] - cut[a] > 1:
                out.append(forest(np.unique(fps[cut[a]: cut[b]]), radius))
            a = b
        u = np.concatenate([x for x, _ in out]) if out else np.zeros(0, np.uint64)
        v = np.concatenate([x for _, x in out]) if out else np.zeros(0, np.uint64)
        return pa.RecordBatch.from_arrays([pa.array(X.signed(u)), pa.array(X.signed(v))], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((0, 3), np.int64)
        for batch in batches:
            rows = np.column_stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("k", "p", "fp")])
            held = np.concatenate([held, rows])
            if len(held) < 8 * TILE:
                continue
            change = np.flatnonzero((held[1:, :2] != held[:-1, :2]).any(axis=1))
            if len(change):
                done = int(change[-1]) + 1
                yield edges(held[:done, :2], np.ascontiguousarray(held[:done, 2]).view(np.uint64))
                held = held[done:]
        if len(held):
            yield edges(held[:, :2], np.ascontiguousarray(held[:, 2]).view(np.uint64))

    return run


def fingerprint_links(fps: DataFrame, radius: int = RADIUS, hot: int = HOT) -> DataFrame:
    """Links (u, v) that connect the distinct fingerprints ``fp`` exactly as all pairs within ``radius`` <= 3 do."""
    if not 0 <= radius <= 3:
        raise ValueError("five blocks find pairs of up to three differing bits")
    rows = X.stored(fps.select(F.explode(_keys()).alias("k"), "fp"), "block-keys")
    heavy = rows.groupBy("k").count().filter(F.col("count") > hot).select("k", F.ceil(F.col("count") / (hot // 2)).cast("long").alias("tiles"))
    heavy = X.stored(heavy, "hot-keys")
    if heavy.isEmpty():
        dealt = rows.select("k", F.lit(0).cast("long").alias("p"), "fp")
    else:
        # Tile t of a hot key meets tiles 0..n-1; the pair (low, high) names the group.
        tiled = rows.join(heavy, "k").withColumn("t", F.pmod(F.xxhash64("fp"), F.col("tiles")))
        tiled = tiled.withColumn("o", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)))
        tiled = tiled.select("k", (F.least("t", "o") * F.col("tiles") + F.greatest("t", "o") + 1).alias("p"), "fp")
        dealt = rows.join(heavy, "k", "left_anti").select("k", F.lit(0).cast("long").alias("p"), "fp").unionAll(tiled)
    return (dealt.repartition("k", "p").sortWithinPartitions("k", "p")
            .mapInArrow(_links(radius), "u long, v long"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row per document row: doc_id, key (hash of the text), fp (signed), component_id."""
    slim = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), X.text_key().alias("key"))
    marked = X.stored(slim.mapInArrow(_fingerprints(shingle), "doc_id long, key long, fp long"), "simhash")
    kinds = X.stored(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "fingerprints")
    groups = connected_components(fingerprint_links(kinds, radius))
    rooted = kinds.join(groups.select(F.col("node").alias("fp"), "root"), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    rooted = X.stored(rooted, "rooted")
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return marked.join(rooted.join(named, "root").select("fp", "component_id"), "fp")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One document of each component, with all its columns: the one with the smallest id.

    Of rows that share that id, the smallest text hash stays, and of equal rows one.
    """
    found = near_duplicates(docs, shingle, radius)
    best = (found.groupBy("component_id", F.when(F.col("component_id").isNull(), F.col("fp")).alias("fp"))
            .agg(F.min(F.struct(X.id_key().alias("i"), "key")).alias("best")))
    i, k = X.fresh(docs, "_id", "_key")
    best = best.select(F.col("best.i").alias(i), F.col("best.key").alias(k)).distinct()
    return (docs.withColumns({i: X.id_key(), k: X.text_key()}).join(best, [i, k], "left_semi")
            .dropDuplicates([i, k]).select(*[f"`{c}`" for c in docs.columns]))

"""Quality classifier: interpolated modified Kneser-Ney model of trusted text.

Tokens are bytes. The model is made of raw n-grams of ``RAW`` down to two
bytes; below them stands a model of bytes folded to ``SYMBOLS`` classes
(letters, capitals, digits, groups of signs, UTF-8 bytes) of order ``ORDER``,
times the byte's share of its class, which judges what raw bytes never showed.

Tasks count the raw n-grams of trusted text; the counts meet by shard, a hash
of the two bytes before the last one, so that an n-gram, its contexts and all
its shorter forms down to three bytes are in one shard. Shards give the tallies for
the discounts, the pairs of bytes and the folded n-grams, all bounded
(``256 ** 2``, ``SYMBOLS ** ORDER``) and sent to the tasks; the n-grams themselves
stay in their shards. To score, the texts are dealt into parts; a part asks
the shards for each of its different n-grams once, and the answers meet the
part's texts again by key. Trusted documents held out from the counts give each
language's quantile of perplexity; documents over it are rejected.

The model counts every trusted row that is not held out and the quantiles use
every one that is; every document is scored whole.

Defined cases: null or empty text has no perplexity and is not kept; repeated
rows are judged alike; languages with fewer than ``Settings.least`` held-out
trusted rows (and null ones) take the threshold of all; without trusted rows
every text with a byte is kept; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from urbanlens.llm import text as X

SYMBOLS = 48
ORDER = 4
RAW = 6          # from ORDER to 8
SHARDS = 256
BLOCK = 1 << 20
#: N-grams gathered before they are merged, or answered at once.
MANY = 1 << 21
#: A part's table of answers has at most 2 to this power places (100 MB); the others are searched.
SLOTS = 23
BYTE = np.uint64(8)
CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@dataclass(frozen=True)
class Settings:
    quantile: float = 0.99
    least: int = 30
    holdout: int = 3          # one trusted row in so many is held out


def classes() -> np.ndarray:
    """Byte to symbol: 0 white space, 1-26 letters, 27 line end, 28 digit, 29-33 signs, 34 capital, the rest UTF-8."""
    t = np.full(256, 31, np.uint8)
    t[:33] = 0
    t[10] = 27
    t[0x30:0x3A] = 28
    t[0x61:0x7B] = np.arange(1, 27)
    t[0x41:0x5B] = 34
    for sign, c in ((b".", 29), (b",", 30), (b"#*$%&|<>@^~=+_/\\", 32), (b"!?", 33)):
        t[np.frombuffer(sign, np.uint8)] = c
    t[0x80:0xC0] = 36 + np.arange(64) % 12
    t[0xC0:] = 35
    return t


# N-grams of raw bytes: the byte itself lowest, above it those before it, the nearest highest.

def _keys(data: np.ndarray, off: np.ndarray, a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
    """The n-gram that ends at every byte of documents [a, b), and their offsets; white space stands before a text."""
    off = off[a: b + 1]
    s = data[off[0]: off[-1]]
    off = off - off[0]
    head = off[:-1, None] + np.arange(RAW - 1)
    inside = head < off[1:, None]
    key = s.astype(np.uint64)
    for k in range(1, RAW):
        prev = np.full(len(s), 32, np.uint8)
        prev[k:] = s[:-k]
        prev[head[:, :k][inside[:, :k]]] = 32
        key |= prev.astype(np.uint64) << np.uint64(8 * (RAW - k))
    return key, off


def _shorter(key: np.ndarray) -> np.ndarray:
    """Without the first byte."""
    return (key >> np.uint64(16) << BYTE) | (key & np.uint64(255))


def _folded(key: np.ndarray) -> np.ndarray:
    """The n-gram of classes of the last ``ORDER`` bytes."""
    table = classes().astype(np.int64)
    code = table[key & np.uint64(255)]
    for k in range(1, ORDER):
        code += table[(key >> np.uint64(8 * (RAW - k))) & np.uint64(255)] * SYMBOLS**k
    return code


def _distinct(key: np.ndarray) -> np.ndarray:
    """Different keys in order; faster than ``np.unique``, which hashes."""
    key = np.sort(key)
    return key[np.r_[True, key[1:] != key[:-1]][:len(key)]]


def _sum(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Different keys in order, and the sum of each one's counts."""
    key, c = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(key, kind="stable")
    key = key[order]
    at = np.flatnonzero(np.r_[True, key[1:] != key[:-1]][:len(key)])
    return key[at], np.add.reduceat(c[order], at) if len(at) else c


def _by_shard(key: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Shards and the places of their n-grams in the sorted ``key``."""
    pair = (key >> np.uint64(8 * (RAW - 2))).astype(np.uint32)
    shard = (pair * np.uint32(0x9E3779B1) >> np.uint32(24)).astype(np.uint8)
    order, ends = np.argsort(shard, kind="stable"), np.cumsum(np.bincount(shard, minlength=SHARDS))
    for i in np.flatnonzero(np.diff(ends, prepend=0)):
        yield int(i), order[ends[i - 1] if i else 0: ends[i]]


def _pack(a: np.ndarray) -> bytes:
    """Numbers as one compressed string: the lowest byte of all of them, then the next."""
    return pa.compress(np.ascontiguousarray(a.view(np.uint8).reshape(len(a), -1).T), codec="zstd", asbytes=True)


def _unpack(blob: bytes, n: int, kind: type) -> np.ndarray:
    wide = np.dtype(kind).itemsize
    planes = np.frombuffer(pa.decompress(blob, n * wide, codec="zstd"), np.uint8).reshape(wide, n)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def _pack_keys(key: np.ndarray) -> bytes:
    return _pack(np.diff(key, prepend=np.uint64(0)))


def _unpack_keys(blob: bytes, n: int) -> np.ndarray:
    return np.cumsum(_unpack(blob, n, np.uint64), dtype=np.uint64)


def _released(df: DataFrame, name: str) -> DataFrame:
    """``df`` stored; the shuffle files of the job, of no more use, go at its end."""
    conf = df.sparkSession.conf
    was = conf.get(CLEAN, None)
    conf.set(CLEAN, "true")
    try:
        return X.stored(df, name)
    finally:
        conf.unset(CLEAN) if was is None else conf.set(CLEAN, was)


# Counting

COUNTED = "shard int, n int, keys binary, counts binary"
#: what: 0 for the n-grams of a shard; 1 for a folded n-gram; 2 for a pair of bytes and how many different bytes stand
#: before it; 3 for 8 x order + count and how many n-grams of that order have that count.
MERGED = "what int, shard int, gram long, c long, n int, keys binary, counts binary"


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    keys, counts, many = [], [], 0
    for batch in batches:
        data, off = X.column_bytes(batch.column("text"))
        for a, b in X.chunks(off, BLOCK):
            k, c = np.unique(_keys(data, off, a, b)[0], return_counts=True)
            keys.append(k)
            counts.append(c)
            many += len(k)
            if many > MANY and many > 2 * len(keys[0]):
                k, c = _sum(keys, counts)
                keys, counts, many = [k], [c], len(k)
    if many:
        k, c = _sum(keys, counts)
        rows = [(s, len(at), _pack_keys(k[at]), _pack(c[at])) for s, at in _by_shard(k)]
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), (pa.int32(), pa.int32(), pa.binary(), pa.binary()))],
                                         names=["shard", "n", "keys", "counts"])


def _merged(shard: int, keys: list[np.ndarray], counts: list[np.ndarray]) -> pa.RecordBatch:
    key, c = _sum(keys, counts)
    whole = (np.zeros(1, np.int32), np.zeros(1, np.int64), np.zeros(1, np.int64))
    code, at = np.unique(_folded(key), return_inverse=True)
    small = [(1, code, np.bincount(at, c).astype(np.int64))]
    k, d = key, c
    for n in range(RAW, 2, -1):
        small.append((3, 8 * n + np.arange(1, 5), np.bincount(np.minimum(d, 5), minlength=6)[1:5]))
        k, d = np.unique(_shorter(k), return_counts=True)
    small.append((2, k.astype(np.int64), d))
    what, gram, total = (np.concatenate(x) for x in zip(whole, *((np.full(len(g), w, np.int32), g, t) for w, g, t in small)))
    none = [None] * (len(what) - 1)
    return pa.RecordBatch.from_arrays(
        [pa.array(what), pa.array([shard, *none], pa.int32()), pa.array(gram), pa.array(total), pa.array([len(key), *none], pa.int32()),
         pa.array([_pack_keys(key), *none], pa.binary()), pa.array([_pack(c), *none], pa.binary())],
        names=["what", "shard", "gram", "c", "n", "keys", "counts"])


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The counts of each shard, whose rows come together."""
    now, keys, counts, many = None, [], [], 0
    for batch in batches:
        for shard, n, k, c in zip(*(batch.column(x).to_pylist() for x in ("shard", "n", "keys", "counts"))):
            if shard != now and keys:
                yield _merged(now, keys, counts)
                keys, counts, many = [], [], 0
            now = shard
            keys.append(_unpack_keys(k, n))
            counts.append(_unpack(c, n, np.int64))
            many += n
            if many > MANY and many > 2 * len(keys[0]):
                k, c = _sum(keys, counts)
                keys, counts, many = [k], [c], len(k)
    if keys:
        yield _merged(now, keys, counts)


def _levels(grams: DataFrame) -> DataFrame:
    """(n, gram, c) of every order: the counts themselves for the highest, below it the different symbols before a gram."""
    suffixes = [F.struct(F.lit(n).alias("n"), (F.col("gram") % SYMBOLS ** (n + 1)).alias("longer"), (F.col("gram") % SYMBOLS**n).alias("gram"))
                for n in range(1, ORDER)]
    lower = grams.select(F.explode(F.array(*suffixes)).alias("s")).select("s.*").distinct()
    return grams.select(F.lit(ORDER).alias("n"), "gram", "c").unionAll(lower.groupBy("n", "gram").agg(F.count("*").alias("c")))


def _cuts(n1: int, n2: int, n3: int, n4: int) -> list[float]:
    """What counts of one, of two and of more give up, from how many n-grams have counts of one to four."""
    y = n1 / (n1 + 2 * n2) if n1 + n2 else 0.5
    return [float(min(max(i - (i + 1) * y * b / a, 0.1), i - 0.1)) if a and b else 0.5 for i, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]


def _discounts(counts: DataFrame) -> Column:
    """What a gram's count gives up: for each order one value for counts of one, of two and of more."""
    tally = {(r["n"], r["c"]): r["count"] for r in counts.filter("c <= 4").groupBy("n", "c").count().collect()}
    out = F.lit(None).cast("double")
    for n in range(1, ORDER + 1):
        d = _cuts(*(tally.get((n, i), 0) for i in (1, 2, 3, 4)))
        out = F.when(F.col("n") == n, F.when(F.col("c") == 1, d[0]).when(F.col("c") == 2, d[1]).otherwise(d[2])).otherwise(out)
    return out


def _shares(counts: DataFrame) -> DataFrame:
    """(n, gram, v) with v the discounted share, and (-n, context, v) with the weight left for the lower order."""
    counts = counts.withColumns({"ctx": F.floor(F.col("gram") / SYMBOLS), "d": _discounts(counts)})
    context = counts.groupBy("n", "ctx").agg(F.sum("c").alias("total"), F.sum("d").alias("spared"))
    shares = counts.join(context, ["n", "ctx"]).select("n", "gram", ((F.col("c") - F.col("d")) / F.col("total")).alias("v"))
    left = context.select(-F.col("n"), "ctx", F.col("spared") / F.col("total"))
    return shares.unionAll(left).select(F.col("n").cast("byte").alias("n"), F.col("gram").cast("int").alias("gram"), "v")


@dataclass
class Low:
    """What every shard needs, of bounded size."""

    cuts: dict[int, list[float]]  # of each raw order
    pairs: np.ndarray             # discounted share of each pair of bytes
    left: np.ndarray              # weight a byte leaves for the folded model
    share: np.ndarray             # of a byte in its class
    fold: np.ndarray              # the folded model


class Table(np.ndarray):
    """log10 P of the folded model, flat; with it the raw one."""

    grams: DataFrame              # shard, n, keys, counts
    low: Low


def _low(small: pa.Table, fold: np.ndarray) -> Low:
    what, gram, c = (small[x].to_numpy() for x in ("what", "gram", "c"))
    tally = dict(zip(gram[what == 3].tolist(), c[what == 3].tolist()))
    cuts = {n: _cuts(*(tally.get(8 * n + i, 0) for i in (1, 2, 3, 4))) for n in range(3, RAW + 1)}
    pairs = np.zeros(1 << 16, np.int64)
    pairs[gram[what == 2]] = c[what == 2]
    cuts[2] = _cuts(*np.bincount(np.minimum(pairs, 5), minlength=6)[1:5].tolist())
    spared = np.r_[0.0, cuts[2]][np.minimum(pairs, 3)]
    total, weight = pairs.reshape(256, 256).sum(axis=1), spared.reshape(256, 256).sum(axis=1)
    own = (pairs.reshape(256, 256) > 0).sum(axis=0) + 1.0
    at = classes()
    return Low(cuts, (pairs - spared) / np.repeat(np.maximum(total, 1), 256), np.where(total > 0, weight / np.maximum(total, 1), 1.0),
               own / np.bincount(at, own, SYMBOLS)[at], fold)


def train(texts: DataFrame) -> Table:
    """log10 P(class | three before) for every n-gram of classes, as a flat table, and the raw model in its shards."""
    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counted = texts.select("text").mapInArrow(_count, COUNTED).repartition(parts, "shard").sortWithinPartitions("shard")
    merged = _released(counted.mapInArrow(_merge, MERGED), "grams")
    grams = X.stored(merged.filter("what = 1").groupBy("gram").agg(F.sum("c").alias("c")), "folded")
    rows = _shares(X.stored(_levels(grams), "levels")).toArrow()  # at most SYMBOLS ** ORDER rows and their contexts
    order, gram, value = (rows[c].to_numpy() for c in ("n", "gram", "v"))
    p = np.full(SYMBOLS, 1.0 / SYMBOLS)
    for n in range(1, ORDER + 1):
        left = np.ones(SYMBOLS ** (n - 1))
        left[gram[order == -n]] = value[order == -n]
        p = (left.reshape(-1, len(p) // SYMBOLS, 1) * p.reshape(-1, SYMBOLS)).ravel()
        p[gram[order == n]] += value[order == n]
    # In place: the driver holds one table of doubles.
    np.log10(np.maximum(p, 1e-12, out=p), out=p)
    p = p.astype(np.float32)
    table = p.view(Table)
    table.grams = merged.filter("what = 0").select("shard", "n", "keys", "counts")
    # At most 256 ** 2 pairs and four counts an order.
    table.low = _low(merged.filter("what > 1").groupBy("what", "gram").agg(F.sum("c").alias("c")).toArrow(), p)
    return table


# Scoring

class Shard:
    """The raw model of the n-grams of one shard."""

    def __init__(self, key: np.ndarray, c: np.ndarray, low: Low):
        self.low, self.levels = low, {}
        for n in range(RAW, 2, -1) if len(key) else ():
            d = np.r_[0.0, low.cuts[n]][np.minimum(c, 3)]
            context = key >> BYTE
            at = np.flatnonzero(np.r_[True, context[1:] != context[:-1]])
            total = np.add.reduceat(c, at)
            share = (c - d) / np.repeat(total, np.diff(np.r_[at, len(key)]))
            self.levels[n] = key, share, context[at], np.add.reduceat(d, at) / total
            key, c = np.unique(_shorter(key), return_counts=True)

    def log10(self, key: np.ndarray) -> np.ndarray:
        """log10 P(byte | those before it) of n-grams in order."""
        low, last = self.low, key & np.uint64(255)
        first = key >> np.uint64(8 * (RAW - 1))
        p = low.pairs[first << BYTE | last] + low.left[first] * low.share[last] * 10.0 ** low.fold[_folded(key)].astype(np.float64)
        for n in range(3, RAW + 1):
            if n in self.levels:
                grams, share, contexts, left = self.levels[n]
                k = key >> np.uint64(8 * (RAW - n + 1)) << BYTE | last
                p = _found(grams, share, k, 0.0) + _found(contexts, left, k >> BYTE, 1.0) * p
        return np.log10(np.maximum(p, 1e-300)).astype(np.float32)


def _found(keys: np.ndarray, values: np.ndarray, key: np.ndarray, other: float) -> np.ndarray:
    at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
    return np.where(keys[at] == key, values[at], other)


ANSWER = "part int, n int, keys binary, logs binary"


def _answer(shared):
    """Rows of a shard: its model, then the n-grams that parts ask for."""
    def of(shard: Shard, rows: list[tuple]) -> pa.RecordBatch:
        part, n, blob, keys = zip(*rows)
        key, at = np.unique(np.concatenate(keys), return_inverse=True)
        logs = np.split(shard.log10(key)[at], np.cumsum(n)[:-1])
        return pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(n, pa.int32()), pa.array(blob, pa.binary()), pa.array(map(_pack, logs), pa.binary())],
                                          names=["part", "n", "keys", "logs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, shard, rows, many = None, None, [], 0
        for batch in batches:
            for i, part, n, k, c in zip(*(batch.column(x).to_pylist() for x in ("shard", "part", "n", "keys", "counts"))):
                if rows and (i != now or many > MANY):
                    yield of(shard, rows)
                    rows, many = [], 0
                key = _unpack_keys(k, n)
                if i != now:
                    now, shard = i, Shard(*((key, _unpack(c, n, np.int64)) if part < 0 else (key[:0], None)), shared.value)
                if part >= 0:
                    rows.append((part, n, k, key))
                    many += n
        if rows:
            yield of(shard, rows)

    return run


SLIM = pa.schema([("doc_id", pa.int64()), ("lang", pa.string()), ("text", pa.string())])


def _spread(spark: SparkSession, parts: int) -> np.ndarray:
    """Names for parts, of which Spark's hash deals each to a partition of its own."""
    found = spark.range(20 * parts).select(F.pmod(F.hash(F.col("id").cast("int")), F.lit(parts)).alias("at"), F.col("id").cast("int").alias("id"))
    return np.sort([r["id"] for r in found.groupBy("at").agg(F.min("id").alias("id")).collect()])  # a number for each partition


def _bundle(names: np.ndarray):
    """The rows of each part, compressed together."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 3))
        for batch in batches:
            part = names[batch.column("part").to_numpy()]
            order = np.argsort(part, kind="stable")
            rows = pa.RecordBatch.from_arrays([batch.column(f.name).cast(f.type) for f in SLIM], schema=SLIM).take(pa.array(order))
            at = np.flatnonzero(np.diff(part[order], prepend=-1))
            blobs = []
            for a, b in zip(at, [*at[1:], len(part)]):
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, SLIM, options=options) as out:
                    out.write_batch(rows.slice(a, b - a))
                blobs.append(sink.getvalue().to_pybytes())
            yield pa.RecordBatch.from_arrays([pa.array(part[order][at], pa.int32()), pa.array(blobs, pa.binary())], names=["part", "rows"])

    return run


def _unbundle(blob: bytes) -> pa.RecordBatch:
    return pa.ipc.open_stream(blob).read_next_batch()


def _ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The different n-grams of each part, by shard."""
    asked: dict[int, list[np.ndarray]] = {}
    for batch in batches:
        for part, blob in zip(batch.column("part").to_pylist(), batch.column("rows")):
            data, off = X.column_bytes(_unbundle(blob.as_buffer()).column("text"))
            own = asked.setdefault(part, [])
            for a, b in X.chunks(off, BLOCK):
                own.append(_distinct(_keys(data, off, a, b)[0]))
                if len(own) > 1 and sum(map(len, own[1:])) > max(len(own[0]), MANY):
                    own[:] = [_distinct(np.concatenate(own))]
    for part, own in asked.items():
        if sum(map(len, own)):
            key = _distinct(np.concatenate(own))
            rows = [(s, part, len(at), _pack_keys(key[at])) for s, at in _by_shard(key)]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), (pa.int32(), pa.int32(), pa.int32(), pa.binary()))],
                                             names=["shard", "part", "n", "keys"])


class Lookup:
    """Values by key, for keys that are all there: a table by hash, and a sorted list of those whose place was taken."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        bits = min(max(len(keys), 2).bit_length() + 1, SLOTS)
        self.shift = np.uint64(64 - bits)
        at = self._place(keys)
        self.keys, self.values = np.zeros(1 << bits, np.uint64), np.zeros(1 << bits, np.float32)
        self.keys[at] = keys
        rest = self.keys[at] != keys
        self.values[at[~rest]] = values[~rest]
        order = np.argsort(keys[rest])
        self.rest, self.other = keys[rest][order], values[rest][order]

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return (keys * X.BASE_A >> self.shift).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        at = self._place(keys)
        out = self.values[at]
        miss = np.flatnonzero(self.keys[at] != keys)
        if len(miss):
            place = np.minimum(np.searchsorted(self.rest, keys[miss]), max(len(self.rest) - 1, 0))
            if not len(self.rest) or (self.rest[place] != keys[miss]).any():
                raise RuntimeError("an n-gram of a text has no answer: the rows of documents changed while they were read")
            out[miss] = self.other[place]
        return out


SCORED = "doc_id long, lang string, n_bytes long, log10_prob double"


def _score(bundles: pa.Table, answers: pa.Table) -> pa.Table:
    """log10 probability of every text of a part, from the answers to its n-grams."""
    n, keys, logs = (answers[x].to_pylist() for x in ("n", "keys", "logs"))
    logp = Lookup(np.concatenate([np.zeros(0, np.uint64), *map(_unpack_keys, keys, n)]),
                  np.concatenate([np.zeros(0, np.float32), *(_unpack(x, k, np.float32) for x, k in zip(logs, n))]))
    out = []
    for blob in bundles["rows"]:
        batch = _unbundle(blob.as_buffer())
        data, off = X.column_bytes(batch.column("text"))
        total = np.zeros(batch.num_rows)
        for a, b in X.chunks(off, BLOCK):
            key, o = _keys(data, off, a, b)
            full = np.flatnonzero(np.diff(o))  # each text on its own: copies get the same sum
            if len(full):
                total[a + full] = np.add.reduceat(logp(key).astype(np.float64), o[full])
        out.append(pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("lang"), pa.array(np.diff(off)), pa.array(total)],
                                              names=["doc_id", "lang", "n_bytes", "log10_prob"]))
    return pa.Table.from_batches(out)


def log_probs(slim: DataFrame, table: Table) -> DataFrame:
    """doc_id, lang, n_bytes, log10_prob of every row of (doc_id, lang, text)."""
    spark = slim.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shared, names = spark.sparkContext.broadcast(table.low), _spread(spark, parts)
    # By id and text: null or repeated ids have no part of their own.
    part = F.pmod(F.xxhash64("doc_id", "text"), F.lit(len(names))).cast("int")
    bundles = slim.select("doc_id", "lang", "text", part.alias("part")).mapInArrow(_bundle(names), "part int, rows binary").repartition(parts, "part")
    model = table.grams.select("shard", F.lit(-1).alias("part"), "n", "keys", "counts")
    asked = bundles.mapInArrow(_ask, "shard int, part int, n int, keys binary").withColumn("counts", F.lit(None).cast("binary"))
    rows = model.unionAll(asked).repartition(parts, "shard").sortWithinPartitions("shard", "part")
    answers = rows.mapInArrow(_answer(shared), ANSWER)
    return bundles.groupBy("part").cogroup(answers.groupBy("part")).applyInArrow(_score, SCORED)


def _held(s: Settings) -> Column:
    return F.pmod(F.xxhash64(F.col("doc_id"), F.lit(5)), F.lit(s.holdout)) == 0


def classify(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, lang, n_bytes, log10_prob, perplexity, threshold, kept of every row; ``labels``: (doc_id, quality), 1 for trusted."""
    trusted = labels.filter("quality = 1 and doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    slim = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), lang.alias("lang"))
    # Trusted ids have no bound: texts are dealt out by id at every size, and not sorted.
    texts = slim.join(trusted.filter(~_held(settings)).hint("shuffle_hash"), "doc_id")
    scored = log_probs(slim.select("doc_id", "lang", "text"), train(texts))
    scored = _released(scored.withColumn("perplexity", F.when(F.col("n_bytes") > 0, F.pow(F.lit(10.0), -F.col("log10_prob") / F.col("n_bytes")))), "perplexity")
    held = scored.join(trusted.filter(_held(settings)), "doc_id").filter("perplexity is not null")
    at = F.percentile_approx("perplexity", settings.quantile, 10_000)
    by_lang = held.groupBy("lang").agg(at.alias("own"), F.count("*").alias("n")).filter(F.col("n") >= settings.least).select(F.col("lang").alias("of"), "own")
    whole = held.agg(at.alias("all")).first()["all"]
    rows = scored.join(by_lang, F.col("lang").eqNullSafe(F.col("of")), "left")
    limit = F.coalesce("own", F.lit(whole).cast("double"))
    return rows.select("doc_id", "lang", "n_bytes", "log10_prob", "perplexity", limit.alias("threshold"),
                       (F.coalesce(F.col("perplexity") <= F.coalesce(limit, F.lit(float("inf"))), F.lit(False))).alias("kept"))

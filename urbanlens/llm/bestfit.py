"""Best-two-fit packing of documents into sequences of bounded length.

Only a document longer than a sequence is cut: into whole sequences and a last
piece. What remains is bin packing of pieces of at most ``limit`` tokens, and
pieces of one length are interchangeable. So the packing is decided on the
number of pieces of each length, ``limit`` numbers at any input size:

* fill a sequence greedily, each time with the longest piece that fits;
* then take out its shortest piece if two pieces left over fill the gap so
  widened more tightly, and put in the two that fill it most.

A sequence is repeated as long as the pieces it takes are there, which gives
what one sequence after the other would give; each such run uses up a length,
so there are few of them.

Spark does the rest: tasks cut and number the pieces of each length, prefix
sums over (length, task) make the numbers global, and a piece finds its
sequence and place by the number. No group of pieces is gathered; a length
that a third of all pieces share is numbered task by task as any other.

Defined cases: a null or empty text is one piece, the end id alone; repeated
rows are packed once each; a null id stays null; an empty table gives no
pieces; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from urbanlens.llm import text as X
from urbanlens.llm.packing import WordIds

LIMIT = 2048
END_ID = 0

PIECES = "doc_id long, piece int, start long, length int, ids_crc32 long, task int, nth long"


class Counts:
    """How many pieces of each length are left, with the next shorter length that has any."""

    def __init__(self, counts: np.ndarray):
        self.left = counts.astype(np.int64)
        self.refresh()

    def refresh(self) -> None:
        at = np.where(self.left > 0, np.arange(len(self.left)), 0)
        self.upto = np.maximum.accumulate(at)

    def longest(self, room: int, used: dict[int, int]) -> int:
        """The longest length up to ``room`` with a piece not in ``used``; 0 if there is none."""
        size = int(self.upto[min(room, len(self.upto) - 1)])
        while size and self.left[size] <= used.get(size, 0):
            size = int(self.upto[size - 1])
        return size

    def pair(self, room: int, used: dict[int, int]) -> tuple[int, int]:
        """Two lengths that fill ``room`` most, the longer first; of several such pairs the one with the longest piece. (0, 0) if none fit."""
        free = self.left.copy()
        for size, n in used.items():
            free[size] -= n
        top = min(room - 1, len(free) - 1)
        if top < 1:
            return 0, 0
        has = np.flatnonzero(free[:top + 1] > 0)
        upto = np.maximum.accumulate(np.where(free > 0, np.arange(len(free)), 0))
        short = upto[np.minimum(has, room - has)]
        # The same length twice needs two pieces.
        alone = (short == has) & (free[has] < 2)
        short[alone] = upto[has[alone] - 1]
        total = np.where(short > 0, has + short, 0)
        if not len(total) or not total.max():
            return 0, 0
        k = len(total) - 1 - int(np.argmax(total[::-1]))
        return int(has[k]), int(short[k])


def fill(stock: Counts, limit: int) -> list[int]:
    """The lengths of the next sequence, longest first."""
    room, used = limit, {}
    while room and (size := stock.longest(room, used)):
        n = min(room // size, int(stock.left[size]) - used.get(size, 0))
        used[size] = used.get(size, 0) + n
        room -= n * size
    if room:
        last = min(used)
        used[last] -= 1
        a, b = stock.pair(room + last, used)
        if a + b > last:
            for size in (a, b):
                used[size] = used.get(size, 0) + 1
        else:
            used[last] += 1
    return [size for size in sorted(used, reverse=True) for _ in range(used[size])]


def plan(counts: np.ndarray, limit: int) -> list[tuple[list[int], int]]:
    """Sequences as (lengths, how often), for ``counts[n]`` pieces of length n."""
    stock, out = Counts(counts), []
    while stock.upto[-1]:
        sizes = fill(stock, limit)
        kinds, times = np.unique(sizes, return_counts=True)
        often = int((stock.left[kinds] // times).min())
        stock.left[kinds] -= often * times
        stock.refresh()
        out.append((sizes, often))
    return out


def _cut_texts(path: str, limit: int):
    schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int32()),
                        ("ids_crc32", pa.int64()), ("task", pa.int32()), ("nth", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        words, task, seen = WordIds(path), TaskContext.get().partitionId(), [0] * (limit + 1)
        for batch in batches:
            out = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                ids = words.encode(text.as_py() or "") + END_ID.to_bytes(4, "little")
                for piece, at in enumerate(range(0, len(ids), 4 * limit)):
                    part = ids[at:at + 4 * limit]
                    n = len(part) // 4
                    out.append((doc, piece, at // 4, n, zlib.crc32(part), task, seen[n]))
                    seen[n] += 1
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    return run


def _place(sequences: list[tuple[list[int], int]], limit: int):
    """Sequence and offset of the piece numbered ``number`` among those of its length."""
    rows: list[list[tuple]] = [[] for _ in range(limit + 1)]
    taken, first = [0] * (limit + 1), 0
    for sizes, often in sequences:
        offset = 0
        for size in sizes:
            rows[size].append((taken[size], first, offset))
            taken[size] += often
            offset += size
        first += often
    # One sorted key for all lengths: length and number of the first piece of each run.
    table = np.array([(size, *r) for size in range(limit + 1) for r in rows[size]], np.int64).reshape(-1, 4)
    keys = (table[:, 0] << 48) | table[:, 1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number = batch.column("number").to_numpy(zero_copy_only=False)
            k = (batch.column("length").to_numpy(zero_copy_only=False).astype(np.int64) << 48) | number
            at = np.searchsorted(keys, k, "right") - 1
            out = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays(
                [*out, pa.array(table[at, 2] + number - table[at, 1]), pa.array(table[at, 3])],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return run


def pack_texts(docs: DataFrame, tokenizer: str, limit: int = LIMIT) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    ``start`` counts the document's ids before the piece, ``offset`` the sequence's.
    """
    slim = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    pieces = X.stored(slim.mapInArrow(_cut_texts(tokenizer, limit), PIECES), "cut-pieces")
    per_task = X.stored(pieces.groupBy("length", "task").count(), "piece-counts")
    # Bounded: one row per length.
    found = {r["length"]: r["n"] for r in per_task.groupBy("length").agg(F.sum("count").alias("n")).collect()}
    counts = np.zeros(limit + 1, np.int64)
    counts[list(found)] = list(found.values())
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_task.select("length", "task", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("earlier"))
    numbered = pieces.join(starts, ["length", "task"]).select(
        "doc_id", "piece", "start", F.col("length").cast("long"), "ids_crc32", (F.col("earlier") + F.col("nth")).alias("number"))
    return numbered.mapInArrow(_place(plan(counts, limit), limit),
                               "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")

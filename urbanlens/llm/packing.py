"""Sequence packing by vector bin packing.

Every sequence has three capacities: tokens, segments (pieces) and
loss-bearing tokens. It is filled by the dot-product rule: of all piece sizes
that still fit, take the one whose demand has the largest dot product with
the capacity left, both as shares of the whole capacity. Pieces of one size
are interchangeable, so a choice costs one pass over the sizes present.

Each task packs the rows it reads and keeps at most ``BLOCK`` pieces; nothing
is shuffled. What does not fill a sequence waits for the next block, so a
task leaves one short sequence at its end (more only if the segment limit
binds). Documents may be cut: when no piece fits the tokens left, the piece
with the largest demand gives its head.

Ids come from a public vocabulary with word ends (path as a parameter). Each
distinct word is split once per task and then looked up; texts with letters
outside the Latin blocks, or with the literal of a special token, go to the
tokenizer library whole.

Defined cases: null or empty text is one piece holding the end id alone;
repeated rows are packed once each; a null id stays null; an empty table
gives no pieces; an example that exceeds a limit alone is an error unless it
may be cut.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

END_ID = 1
BLOCK = 8192
CACHE = 400_000

SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long, segment int")


@dataclass(frozen=True)
class Limits:
    tokens: int = 2048
    segments: int = 256
    loss: int = 2048


class Packer:
    """Fills one sequence after another from a bounded stock of pieces.

    A piece is (key, start, length, loss); with ``cut`` its loss is its length.
    """

    def __init__(self, limits: Limits, cut: bool):
        self.limits, self.cut = limits, cut
        self.index: dict[tuple[int, int], int] = {}
        self.stock: list[list] = []
        self.size = np.zeros((64, 2), np.int64)
        self.left = np.zeros(64, np.int64)
        self.tokens = self.pieces = 0

    def add(self, key, start: int, length: int, loss: int) -> None:
        i = self.index.setdefault((length, loss), len(self.stock))
        if i == len(self.stock):
            self.stock.append([])
            if i == len(self.left):
                self.left = np.concatenate([self.left, np.zeros_like(self.left)])
                self.size = np.concatenate([self.size, np.zeros_like(self.size)])
            self.size[i] = length, loss
        self.stock[i].append((key, start))
        self.left[i] += 1
        self.tokens += length
        self.pieces += 1

    def _take(self, i: int):
        self.left[i] -= 1
        self.pieces -= 1
        length, loss = map(int, self.size[i])
        self.tokens -= length
        return (*self.stock[i].pop(), length, loss)

    def sequence(self) -> list[tuple]:
        """The pieces (key, start, length) of the next sequence."""
        cap = self.limits
        room = [cap.tokens, cap.segments, cap.loss]
        out: list[tuple] = []
        n = len(self.stock)
        size, left = self.size[:n], self.left[:n]
        while room[0] > 0 and room[1] > 0 and self.pieces:
            gain = size[:, 0] * (room[0] / cap.tokens**2) + size[:, 1] * (room[2] / cap.loss**2) + room[1] / cap.segments**2
            fits = (left > 0) & (size[:, 0] <= room[0]) & (size[:, 1] <= room[2])
            if fits.any():
                key, start, length, loss = self._take(int(np.argmax(np.where(fits, gain, -1.0))))
            elif self.cut and (head := min(room[0], room[2])) > 0:
                key, start, whole, _ = self._take(int(np.argmax(np.where(left > 0, gain, -1.0))))
                self.add(key, start + head, whole - head, whole - head)
                length = loss = head
                n = len(self.stock)
                size, left = self.size[:n], self.left[:n]
            else:
                break
            out.append((key, start, length))
            room[0] -= length
            room[1] -= 1
            room[2] -= loss
        return out

    def full(self) -> bool:
        """Whether the stock has reached its bound and sequences must be written."""
        return self.pieces >= BLOCK or self.tokens >= BLOCK * 256

    def enough(self) -> bool:
        """Whether the stock fills sequences without running short."""
        return self.tokens >= 4 * self.limits.tokens


class WordIds(dict):
    """Token ids of lower-cased words as little-endian 32-bit bytes, filled on demand.

    Keys are stretches without white space, so one lookup may give several words of the vocabulary.
    """

    #: Word patterns of the vocabulary, for texts without letters past the Latin blocks.
    PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\t-\r \x85\xa0\p{L}\p{N}]+"

    def __init__(self, path: str):
        import json

        import regex
        import tiktoken
        from tokenizers import Tokenizer

        super().__init__()
        self.whole = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            data = json.load(f)
        self.special = [t["content"] for t in data["added_tokens"]]
        # The vocabulary writes bytes as letters: printable ones as they are, the rest from 256 up.
        plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        rest = [b for b in range(256) if b not in plain]
        byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}
        # 0xFF is in no UTF-8 text, so it can stand for the word end.
        ranks = {}
        for token, i in data["model"]["vocab"].items():
            if token in self.special:
                continue
            stem = token.removesuffix("</w>")
            ranks[bytes(byte_of[c] for c in stem) + b"\xff" * (stem != token)] = i
        self.split = tiktoken.Encoding("words", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece
        self.find = regex.compile(self.PATTERN).findall
        self.far = regex.compile(r"[^\x00-\u024F]").search
        # White space to Python's split, but not to the vocabulary.
        self.joined = regex.compile(r"[\x1C-\x1F]").search

    def __missing__(self, word: str) -> bytes:
        words = [word] if word.isalpha() else self.find(word)
        ids = [i for w in words for i in self.split(w.encode() + b"\xff")]
        ids = struct.pack(f"<{len(ids)}I", *ids)
        if len(word) <= 64:
            if len(self) >= CACHE:
                self.clear()
            self[word] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """The ids that the library gives, without special tokens added; their literals in the text count."""
        if any(t in text for t in self.special) or not text.isascii() and self.far(text):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        text = text.lower()
        return b"".join(map(self.__getitem__, self.find(text) if self.joined(text) else text.split()))


def _pack_texts(path: str, limits: Limits, keep_ids: bool):
    fields = [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()),
              ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("segment", pa.int32())]
    schema = pa.schema(fields + [("ids", pa.binary())] * keep_ids)
    whole = min(limits.tokens, limits.loss)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        words = WordIds(path)
        packer, seq, out = Packer(limits, cut=True), TaskContext.get().partitionId() << 32, []

        def put(pieces) -> None:
            nonlocal seq
            offset = 0
            for segment, ((doc, total, ids, base), start, length) in enumerate(pieces):
                part = ids[4 * (start - base): 4 * (start - base + length)]
                row = (doc, start, length, zlib.crc32(part), total, seq, offset, segment)
                out.append((*row, part) if keep_ids else row)
                offset += length
            seq += 1

        def rows() -> pa.RecordBatch:
            cols = list(zip(*out, strict=True)) if out else [[] for _ in schema]
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)

        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                ids = words.encode(text.as_py() or "") + END_ID.to_bytes(4, "little")
                total = len(ids) // 4
                cut = total - total % whole
                for start in range(0, cut, whole):
                    put([((doc, total, ids, 0), start, whole)])
                if cut < total:
                    packer.add((doc, total, ids[4 * cut:], cut), cut, total - cut, total - cut)
                    if packer.full():
                        while packer.enough():
                            put(packer.sequence())
                if len(out) >= 20_000:
                    yield rows()
        while packer.pieces:
            put(packer.sequence())
        yield rows()

    return run


def pack_documents(docs: DataFrame, tokenizer: str, limits: Limits = Limits(), keep_ids: bool = False) -> DataFrame:
    """One row per piece of a document; ``keep_ids`` adds the ids as little-endian 32-bit bytes.

    ``start`` counts the document's ids before the piece, ``offset`` the sequence's.
    """
    slim = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return slim.mapInArrow(_pack_texts(tokenizer, limits, keep_ids), SCHEMA + ", ids binary" * keep_ids)


def _pack_examples(limits: Limits):
    schema = pa.schema([("example_id", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("segment", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        packer, seq = Packer(limits, cut=False), TaskContext.get().partitionId() << 32

        def rows(more) -> pa.RecordBatch:
            nonlocal seq
            out: list[list] = [[], [], [], []]
            while packer.pieces and more():
                offset = 0
                for segment, (key, _, length) in enumerate(packer.sequence()):
                    for c, v in zip(out, (key, seq, offset, segment), strict=True):
                        c.append(v)
                    offset += length
                seq += 1
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, schema, strict=True)], schema=schema)

        for batch in batches:
            for key, tokens, loss in zip(*(batch.column(c).to_pylist() for c in ("example_id", "tokens", "loss")), strict=True):
                if tokens > limits.tokens or loss > limits.loss:
                    raise ValueError(f"example {key} exceeds the limits: {tokens} tokens, {loss} with loss")
                packer.add(key, 0, tokens, loss)
                if packer.full():
                    yield rows(packer.enough)
        yield rows(lambda: True)

    return run


def pack_examples(examples: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Instruction examples (example_id, tokens, loss), never cut: example_id, sequence_id, offset, segment.

    Null counts are zero.
    """
    slim = examples.select(F.col("example_id").cast("long"), *[F.coalesce(F.col(c).cast("long"), F.lit(0).cast("long")).alias(c) for c in ("tokens", "loss")])
    return slim.mapInArrow(_pack_examples(limits), "example_id long, sequence_id long, offset long, segment int")

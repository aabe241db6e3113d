"""Tokenised documents packed into sequences of fixed length by bounded-space best fit."""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.cluster import checkpointed

CAPACITY = 2048
OPEN_BINS = 256
MERGED_TASKS = 64  # tasks whose last open bins are packed together
MEMO = 400_000  # word pieces whose ids a worker remembers
JOINED = 64  # words encoded as one text
SPECIAL = "<|endoftext|>"

# The byte-level splitting rule, for characters on which this spelling and the original agree.
_SPLIT = re.compile(r"'(?:[sdmt]|ll|ve|re)| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
_APART = ((0x1C, 0x1F), (0xB2, 0xB3), (0xB9, 0xB9), (0xBC, 0xBE), (0x250, 0x200F), (0x2028, 0x202F), (0x2060, 0x10FFFF))
_CONTROLS = "\x1c\x1d\x1e\x1f"  # those of them in ASCII
_OTHER = re.compile("[" + "".join(f"{chr(a)}-{chr(b)}" for a, b in _APART) + "]")

SPACE = "\u0120"  # a space, as the names of tokens spell it
# How they spell each byte: printable ones by themselves, others by the characters from 256 on.
_PRINTED = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_SPELLED = np.zeros(256, "<u2")
_SPELLED[_PRINTED] = _PRINTED
_SPELLED[[b for b in range(256) if b not in _PRINTED]] = 256 + np.arange(256 - len(_PRINTED))
_BYTE = {chr(c): b for b, c in enumerate(_SPELLED.tolist())}


def spelled_out(name: str) -> str:
    """The text of a token; bytes that are no whole character become a mark, which is no white space."""
    return bytes(_BYTE.get(c, 0xFF) for c in name).decode("utf-8", "replace")


class Encoder:
    """Ids of texts as little-endian 32-bit bytes. Splits texts into pieces and asks the tokenizer once per piece.

    New words go to the tokenizer's model many at once, as one text: no token reaches from a word over the space into
    the next one, which is looked up in the vocabulary.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = Tokenizer(self.tokenizer.model)  # without the splitting rule
        names = self.tokenizer.get_vocab()
        self.size = np.zeros(max(names.values(), default=0) + 1, np.int64)  # bytes of a token: its name spells them one by one
        for name, number in names.items():
            self.size[number] = len(name)
        self.apart = not any(SPACE in n.lstrip(SPACE) and re.search(r"\S ", spelled_out(n)) for n in names)
        self.memo: dict[str, bytes] = {}

    def whole(self, texts: list[str]) -> list[bytes]:
        return [
            np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        ]

    def words(self, words: list[str]) -> list[bytes]:
        """Ids of each of some words, a space and letters, from one text of them all.

        Tokens are dealt to the words by their bytes. If a word's end is not the end of a token, each is asked for alone.
        """
        joined = "".join(words)
        data = joined.encode()
        spelled = _SPELLED[np.frombuffer(data, np.uint8)].tobytes().decode("utf-16-le")
        ids = np.array(self.model.encode_batch_fast([spelled], add_special_tokens=False)[0].ids, "<u4")
        ends = np.cumsum([len(w) for w in (words if joined.isascii() else [w.encode() for w in words])])
        reached = np.cumsum(self.size[ids])
        last = np.searchsorted(reached, ends)
        if not self.apart or not len(ids) or reached[-1] != ends[-1] or (reached[last] != ends).any():
            return self.whole(words)
        blob = ids.tobytes()
        at = [0, *(4 * (last + 1)).tolist()]
        return [blob[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]

    def learn(self, new: set[str]) -> None:
        """Put pieces into the memo."""
        words = [p for p in new if p[0] == " " and p[1:].isalpha()]
        for begin in range(0, len(words), JOINED):
            part = words[begin : begin + JOINED]
            self.memo.update(zip(part, self.words(part), strict=True))
        rest = list(new.difference(words))
        self.memo.update(zip(rest, self.whole(rest), strict=True))

    def __call__(self, texts: list[str]) -> list[bytes]:
        plain = [(t.isascii() and not any(c in t for c in _CONTROLS) or _OTHER.search(t) is None) and SPECIAL not in t for t in texts]
        pieces = [_SPLIT.findall(t) if p else [] for t, p in zip(texts, plain, strict=True)]
        memo = self.memo
        if len(memo) > MEMO:
            memo.clear()
        self.learn(set().union(*pieces).difference(memo))
        ids = [b"".join(map(memo.__getitem__, p)) for p in pieces]
        odd = [i for i, p in enumerate(plain) if not p]
        for i, whole in zip(odd, self.whole([texts[i] for i in odd]), strict=True):
            ids[i] = whole
        return ids


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One per worker process and vocabulary."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


class OpenBins:
    """At most ``limit`` open bins; a bitset has a bit for each amount of free space that some bin has."""

    def __init__(self, capacity: int, limit: int, first: int):
        self.capacity, self.limit, self.next = capacity, limit, first
        self.bits, self.open = 0, 0
        self.by_free: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _take(self, free: int) -> int:
        bins = self.by_free[free]
        number = bins.pop()
        if not bins:
            self.bits ^= 1 << free
        self.open -= 1
        return number

    def place(self, length: int) -> tuple[int, int]:
        """Bin and offset for an item: the fullest bin it fits in, else a new one."""
        fits = self.bits >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            number = self._take(free)
        else:
            number, free = self.next, self.capacity
            self.next += 1
        left = free - length
        if left:
            if self.open == self.limit:  # the fullest closes
                self._take((self.bits & -self.bits).bit_length() - 1)
            self.by_free[left].append(number)
            self.bits |= 1 << left
            self.open += 1
        return number, self.capacity - free

    def rest(self) -> Iterator[tuple[int, int]]:
        """Open bins and what they hold."""
        for free, bins in enumerate(self.by_free):
            for number in bins:
                yield number, self.capacity - free


def cut(ids: bytes, capacity: int) -> list[tuple[int, bytes]]:
    """A document's pieces: whole if it fits, else full pieces after a first one that may be shorter."""
    n = len(ids) // 4
    begin, end, out = 0, n % capacity or min(n, capacity), []
    if n <= capacity:
        end = n
    while begin < n:
        out.append((begin, ids[4 * begin : 4 * end]))
        begin, end = end, end + capacity
    return out


_FIELDS = ["piece", "start", "length", "ids_crc32", "bin", "offset"]


def _piece_batches(path: str, capacity: int, limit: int):
    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        bins = OpenBins(capacity, limit, TaskContext.get().partitionId() << 40)
        kind = pa.int64()
        for batch in source:
            kind = batch.column("doc_id").type
            texts = [t or "" for t in batch.column("text").to_pylist()]
            row, rows = [], []
            begin = 0
            while begin < len(texts):
                end, size = begin, 0
                while end < len(texts) and (end == begin or size + len(texts[end]) <= 1 << 20):
                    size += len(texts[end])
                    end += 1
                for i, ids in enumerate(encode(texts[begin:end]), begin):
                    for piece, (start, own) in enumerate(cut(ids + b"\0\0\0\0", capacity)):
                        number, offset = bins.place(len(own) // 4)
                        row.append(i)
                        rows.append((piece, start, len(own) // 4, zlib.crc32(own), number, offset))
                begin = end
            columns = np.array(rows, np.int64).reshape(-1, 6).T
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(row, pa.int32())), *(pa.array(c) for c in columns)],
                names=["doc_id", *_FIELDS],
            )
        rest = np.array([(-1, 0, used, 0, number, 0) for number, used in bins.rest()], np.int64).reshape(-1, 6).T
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(rest.shape[1], kind), *(pa.array(c) for c in rest)], names=["doc_id", *_FIELDS]
        )

    return batches


def _merge_batches(capacity: int, limit: int):
    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = OpenBins(capacity, limit, -((TaskContext.get().partitionId() + 1) << 40))
        for batch in source:
            placed = [bins.place(n) for n in batch.column("length").to_pylist()]
            merged, base = np.array(placed, np.int64).reshape(-1, 2).T
            yield pa.RecordBatch.from_arrays(
                [batch.column("bin"), pa.array(merged), pa.array(base)], names=["bin", "merged", "base"]
            )

    return batches


def pack(
    docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, open_bins: int = OPEN_BINS
) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32, sequence_id, offset)`` per piece of ``docs(doc_id, text)``.

    A document is its token ids and an id 0; null text counts as empty, so it is the 0 alone. Only
    documents longer than ``capacity`` are cut. Each task packs its documents as they come into at most
    ``open_bins`` open bins; a document goes to the fullest bin that has room, and if too many are
    open, the fullest closes. Bins still open at a task's end are packed again, those of
    ``MERGED_TASKS`` tasks together, and keep their contents in one stretch. ``sequence_id`` is any
    number; offsets are gapless from 0. Repeated rows and rows without ``doc_id`` are packed like
    others; other columns are ignored. Runs jobs.
    """
    fields = ", ".join(f"{c} bigint" for c in _FIELDS)
    source = docs.select("doc_id", "text")
    kind = dict(source.dtypes)["doc_id"]
    placed = checkpointed(source.mapInArrow(_piece_batches(tokenizer_path, capacity, open_bins), f"doc_id {kind}, {fields}"))
    left = placed.where("piece < 0").select("bin", "length")
    parts = max(1, -(-left.count() // (MERGED_TASKS * open_bins)))
    # By a hash of the bin and in its order, so a task that runs again places its rows as before.
    again = left.repartition(parts, F.xxhash64("bin")).sortWithinPartitions(F.xxhash64("bin"), "bin")
    moved = checkpointed(again.mapInArrow(_merge_batches(capacity, open_bins), "bin bigint, merged bigint, base bigint"))
    return (
        placed.where("piece >= 0")
        .join(moved, "bin", "left")
        .select(
            "doc_id",
            F.col("piece").cast("int").alias("piece"),
            "start",
            "length",
            "ids_crc32",
            F.coalesce("merged", "bin").alias("sequence_id"),
            (F.col("offset") + F.coalesce("base", F.lit(0))).alias("offset"),
        )
    )

"""Weighted context trees over the bytes of whole texts, and what they say of every text.

A text is the bytes of its words, a space after each, and the end mark; the mark stands before it too, zeros before
that. Texts pass in chunks. A chunk asks for its distinct windows (``windows`` of ``ctw``, but across words) and gives
their training counts; tasks that hold whole groups of like nearest bytes merge what chunks ask, build the tree below
these bytes and answer with a value per window and class; the chunk sums the answers by text. The levels above lie in
one table of decisions at the driver, which has two context bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.cluster import SHUFFLES, checkpointed, wide_partitions
from millrace.llm.words import SPACED, find_words, mix, slices, text_buffers

_U = np.uint64
CHUNK_BYTES = 16 << 20  # of text and 8 a row; a longer text is a chunk of its own
PART_BYTES = 4 << 20  # of it, text whose windows are sorted at once
HELD_WINDOWS = 1 << 18  # asked-for windows that a task holds at once, if groups allow
GROUP = _U(43)  # bits of a window below its group, which the two nearest bytes and five bits of the third name
NEAR = 2  # context bytes of the lowest level at the driver
CLOSE, END = 0x20, 0x0A
HEAD = np.array([0, 0, 0, 0, 0, 0, END], np.uint8)

_CODEC = "zstd"


def text_stream(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Streams of the rows, each after ``HEAD``; their sizes without it; and their numbers of words."""
    words = find_words(data, offsets, SPACED)
    length, counts = words.end - words.start, words.counts()
    size = np.bincount(words.row, weights=length + 1, minlength=words.rows).astype(np.int64) + 1
    begin = np.cumsum(size + len(HEAD)) - size
    out = np.full(int(size.sum()) + len(HEAD) * words.rows, CLOSE, np.uint8)
    out[(begin[:, None] - len(HEAD) + np.arange(len(HEAD))).ravel()] = np.tile(HEAD, words.rows)
    out[begin + size - 1] = END
    place = np.cumsum(length + 1) - (length + 1)  # of a word in all streams, were they without heads and end marks
    place += (words.row + 1) * len(HEAD) + words.row
    within = np.arange(int(length.sum())) - np.repeat(np.cumsum(length) - length, length)
    out[np.repeat(place, length) + within] = words.data[np.repeat(words.start, length) + within]
    return out, size, counts


def stream_windows(stream: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Window of every byte of the streams: the byte lowest, the byte before it highest."""
    held = np.concatenate([stream, np.zeros(1, np.uint8)])  # so that the view has a last element
    seen = np.ndarray(len(stream) - 7, "<u8", held.data, strides=(1,))
    inside = np.ones(len(stream), bool)
    ends = np.cumsum(size + len(HEAD))
    inside[(ends[:, None] - 1 - np.arange(len(HEAD))).ravel()] = False
    raw = seen[inside[: len(seen)]]
    return (raw << _U(8)) | (raw >> _U(56))


def packed(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted windows as differences and their counts (window, class), byte by byte, compressed."""
    step = np.diff(keys, prepend=_U(0))
    planes = [step.view(np.uint8).reshape(-1, 8).T, np.ascontiguousarray(counts.T, "<u4").view(np.uint8).reshape(len(counts.T), -1, 4).transpose(0, 2, 1)]
    return pa.Codec(_CODEC, 1).compress(b"".join(p.tobytes() for p in planes), asbytes=True)


def unpacked(data: bytes, n: int, classes: int) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(pa.Codec(_CODEC).decompress(data, n * (8 + 4 * classes), asbytes=True), np.uint8)
    step = np.ascontiguousarray(raw[: 8 * n].reshape(8, n).T).view(_U).ravel()
    counts = np.ascontiguousarray(raw[8 * n :].reshape(classes, 4, n).transpose(0, 2, 1)).view("<u4").reshape(classes, n)
    return np.cumsum(step, dtype=_U), counts.T


def _squeezed(values: np.ndarray) -> bytes:
    """Values by class, compressed: windows that a class has not seen often share theirs."""
    return pa.Codec(_CODEC, 1).compress(np.ascontiguousarray(values.T).tobytes(), asbytes=True)


def _loosened(data: bytes, n: int, classes: int) -> np.ndarray:
    return np.frombuffer(pa.Codec(_CODEC).decompress(data, 4 * n * classes, asbytes=True), "<f4").reshape(classes, n).T


def chunk_batches(chunk_bytes: int):
    """Rows of a partition in chunks: one row with the streams, compressed, and lists of what belongs to each text."""
    columns = ["doc_id", "train", "class"]

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 20
        held: list[tuple] = []
        total = 0

        def flush() -> pa.RecordBatch:
            streams, sizes, tokens, rows = zip(*held, strict=True)
            stream, size, token = (np.concatenate(x) for x in (streams, sizes, tokens))
            table = pa.concat_tables(rows)
            arrays = [pa.array([number]), pa.array([pa.Codec(_CODEC, 1).compress(stream.tobytes(), asbytes=True)], pa.binary())]
            at = pa.array([0, len(size)], pa.int32())
            for values in (pa.array(size), pa.array(token), *(table.column(c).combine_chunks() for c in columns)):
                arrays.append(pa.ListArray.from_arrays(at, values))
            return pa.RecordBatch.from_arrays(arrays, names=["chunk", "stream", "size", "words", "ids", "trains", "classes"])

        for batch in source:
            data, offsets = text_buffers(batch.column("text"))
            for begin, end in slices(offsets):
                cost = int(offsets[end] - offsets[begin]) + 8 * (end - begin)
                if held and total + cost > chunk_bytes:
                    yield flush()
                    number, held, total = number + 1, [], 0
                rows = pa.Table.from_batches([batch.slice(begin, end - begin)]).select(columns)
                held.append((*text_stream(data, offsets[begin : end + 1]), rows))
                total += cost
        if held:
            yield flush()

    return batches


def _stream(value: pa.Scalar, size: np.ndarray) -> np.ndarray:
    length = int(size.sum()) + len(HEAD) * len(size)
    return np.frombuffer(pa.Codec(_CODEC).decompress(value.as_buffer(), length, asbytes=True), np.uint8)


def part_windows(stream: np.ndarray, size: np.ndarray, kind: np.ndarray, classes: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Class, distinct windows and their counts, by parts of a chunk."""
    at = np.zeros(len(size) + 1, np.int64)
    np.cumsum(size + len(HEAD), out=at[1:])
    for begin, end in slices(at, PART_BYTES):
        keys = stream_windows(stream[at[begin] : at[end]], size[begin:end])
        of = np.repeat(kind[begin:end].astype(np.int8), size[begin:end])
        for c in range(-1, classes):
            yield c, *np.unique(keys[of == c], return_counts=True)


def _asked(classes: int):
    """Distinct windows of each chunk with their training counts, a row for each group."""

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for k in range(len(batch)):
                size = batch.column("size")[k].values.to_numpy()
                kind = batch.column("classes")[k].values.to_numpy()
                found = list(part_windows(_stream(batch.column("stream")[k], size), size, kind, classes))
                known = np.unique(np.concatenate([seen for _, seen, _ in found]))
                counts = np.zeros((len(known), classes), np.uint32)
                for c, seen, n in found:
                    if c >= 0:
                        counts[np.searchsorted(known, seen), c] += n.astype(np.uint32)
                del found
                near = (known >> GROUP).astype(np.int64)
                cuts = np.flatnonzero(np.diff(near, prepend=-1))
                ends = np.append(cuts[1:], len(known))
                blobs = [packed(known[a:b], counts[a:b]) for a, b in zip(cuts, ends, strict=True)]
                number = pa.array(np.full(len(cuts), batch.column("chunk")[k].as_py()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(near[cuts].astype(np.int32)), number, pa.array((ends - cuts).astype(np.int32)), pa.array(blobs, pa.binary())],
                    names=["near", "chunk", "n", "windows"],
                )

    return batches


def _held(source: Iterator[pa.RecordBatch], classes: int):
    """Runs of rows that hold whole groups: rows, sorted windows and counts, place of each asked-for window."""
    held: list[tuple] = []
    total = 0

    def merged():
        parts = [unpacked(w, n, classes) for _, _, n, w in held]
        known, at = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
        all_counts = np.concatenate([c for _, c in parts])
        counts = np.stack([np.bincount(at, weights=c, minlength=len(known)) for c in all_counts.T], axis=1)
        return held, known, counts, at

    for batch in source:
        for row in zip(*(batch.column(c).to_pylist() for c in ("near", "chunk", "n", "windows")), strict=True):
            if total >= HELD_WINDOWS and row[0] != held[-1][0]:
                yield merged()
                held, total = [], 0
            held.append(row)
            total += row[2]
    if held:
        yield merged()


def _sums(classes: int):
    """Of the contexts of two bytes: counts of each following byte (bit 8), and the weights of the contexts below each decision."""
    from millrace.llm.ctw import by_row, tree

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, keys, counts, _ in _held(source, classes):
            below = tree(keys, counts, NEAR + 1, False)[0]
            own = (below.keys >> _U(16) << _U(8)) | (below.keys & _U(0xFF))
            known, up = np.unique(own, return_inverse=True)
            found = [(8, known, by_row(up, below.counts, len(known)))]
            for bit in range(8):
                prefix, row = np.unique(own[below.first[bit]] >> _U(8 - bit), return_inverse=True)
                found.append((bit, prefix, by_row(row, below.log_pw[bit], len(prefix))))
            for bit, prefix, values in found:
                columns = [pa.array(np.full(len(prefix), bit, np.int32)), pa.array(prefix.astype(np.int64))]
                columns += [pa.array(np.ascontiguousarray(v)) for v in values.T]
                yield pa.RecordBatch.from_arrays(columns, names=["bit", "prefix", *(f"v{k}" for k in range(classes))])

    return batches


def near_levels(sums: DataFrame, classes: int) -> list:
    """Levels of two, one and no context bytes, weighed."""
    from millrace.llm.ctw import Level

    names = [f"v{k}" for k in range(classes)]
    rows = checkpointed(sums.groupBy("bit", "prefix").agg(*(F.sum(n).alias(n) for n in names))).toArrow()
    table = np.stack([c.to_numpy().astype(float) for c in rows.columns], axis=1)
    table = table[np.lexsort((table[:, 1], table[:, 0]))]
    of = {bit: table[table[:, 0] == bit] for bit in range(9)}
    if not len(table):
        return []
    levels = [Level(of[8][:, 1].astype(_U), of[8][:, 2:])]
    for bit in range(8):
        levels[0].mix_in(bit, of[bit][:, 2:])
    for _ in range(NEAR):
        levels.append(levels[-1].above()[0])
    return levels


def _answers(classes: int, shared):
    """log10 probability in each class of the windows that a chunk asks for, in their order."""
    from millrace.llm.ctw import _LN10, tree

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held, keys, counts, at in _held(source, classes):
            _, _, bits = tree(keys, counts, NEAR + 1, True)
            for depth, level in zip(range(NEAR, -1, -1), shared.value, strict=True):
                own = (keys >> _U(8 * (8 - depth)) << _U(8)) | (keys & _U(0xFF)) if depth else keys & _U(0xFF)
                row = np.searchsorted(level.keys, own)
                for bit in range(8):
                    one = ((keys >> _U(7 - bit)) & _U(1)).astype(bool)[:, None]
                    bits[bit] = level.estimate(bit, row, one, bits[bit])
            value = np.log(np.where(np.isnan(bits), 0.5, bits)).sum(axis=0) / _LN10
            value = value.astype("<f4")[at]
            ends = np.cumsum([n for _, _, n, _ in held])
            blobs = [_squeezed(value[e - n : e]) for e, (_, _, n, _) in zip(ends, held, strict=True)]
            for a in range(0, len(held), 256):
                some = held[a : a + 256]
                near, chunk, n, _ = zip(*some, strict=True)
                arrays = [pa.array(chunk), pa.array(near, pa.int32()), pa.array(n, pa.int32()), pa.array(blobs[a : a + 256], pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, names=["chunk", "near", "n", "value"])

    return batches


class Places:
    """Place of windows in an array of distinct ones, by hash."""

    def __init__(self, keys: np.ndarray):
        hashed = mix(keys)
        self.order = np.argsort(hashed)
        self.hashed = np.append(hashed[self.order], _U(0))  # the last is never reached from a known window
        self.shift = _U(64 - max(int(len(keys)).bit_length(), 1))
        self.start = np.searchsorted(self.hashed[:-1], np.arange(1 << (64 - int(self.shift)), dtype=_U) << self.shift).astype(np.int32)

    def of(self, keys: np.ndarray) -> np.ndarray:
        hashed = mix(keys)
        at = self.start[(hashed >> self.shift).astype(np.int64)]
        off = np.flatnonzero(self.hashed[at] != hashed)
        while len(off):
            at[off] += 1
            off = off[self.hashed[at[off]] != hashed[off]]
        return self.order[at]


def chunk_sums(chunk: pa.Table, answers: pa.Table, classes: int) -> Iterator[tuple]:
    """For runs of a chunk's texts: their range, streams with blanks for heads, offsets, and sums of the answers (text, class)."""
    size = chunk.column("size")[0].values.to_numpy()
    stream = _stream(chunk.column("stream")[0], size)
    order, n = np.argsort(answers.column("near").to_numpy()), answers.column("n").to_numpy()
    keys = np.unique(np.concatenate([k for _, k, _ in part_windows(stream, size, np.zeros(len(size), np.int8), 1)]))
    value = np.concatenate([_loosened(answers.column("value")[int(k)].as_py(), int(n[k]), classes) for k in order])
    places = Places(keys)
    at = np.zeros(len(size) + 1, np.int64)
    np.cumsum(size + len(HEAD), out=at[1:])
    for begin, end in slices(at):
        part = stream[at[begin] : at[end]]
        found = value[places.of(stream_windows(part, size[begin:end]))].astype(float)
        first = np.cumsum(size[begin:end]) - size[begin:end]
        bounds = at[begin : end + 1] - at[begin]
        part = part.copy()
        part[(bounds[:-1, None] + np.arange(len(HEAD))).ravel()] = CLOSE
        yield begin, end, part, bounds, np.add.reduceat(found, first, axis=0)


def chunked(source: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``source(doc_id, train, class, text)`` as a written table of chunks."""
    id_type = dict(source.dtypes)["doc_id"]
    fields = f"chunk long, stream binary, size array<long>, words array<long>, ids array<{id_type}>, trains array<boolean>, classes array<int>"
    return checkpointed(source.select("doc_id", "train", "class", "text").mapInArrow(chunk_batches(chunk_bytes), fields))


def answered(spark: SparkSession, chunks: DataFrame, classes: int) -> DataFrame:
    """What the trees say of the windows of each chunk: ``(chunk, near, n, value)``. Runs jobs."""
    asked = checkpointed(chunks.select("chunk", "stream", "size", "classes").mapInArrow(_asked(classes), "near int, chunk long, n int, windows binary"))
    parts = max(int(spark.conf.get(SHUFFLES)), 64, wide_partitions(asked, copies=4))
    groups = asked.repartition(parts, "near").sortWithinPartitions("near", "chunk")
    values = ", ".join(f"v{k} double" for k in range(classes))
    shared = spark.sparkContext.broadcast(near_levels(groups.mapInArrow(_sums(classes), f"bit int, prefix long, {values}"), classes))
    return groups.mapInArrow(_answers(classes, shared), "chunk long, near int, n int, value binary")

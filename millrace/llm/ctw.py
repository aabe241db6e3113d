"""Language-model scores by context-tree weighting over the bytes of words.

A token is a word's bytes and a closing space, or the end mark alone. Each byte is eight binary
decisions; the context of a decision is the bits of the byte so far and up to ``DEPTH`` bytes before it in
the token. For every context the tree holds zeros and ones seen in training; weighting mixes the
Krichevsky-Trofimov estimates of all depths by how well each would have coded the training data.
A context that training never reached ends the tree: its parent's estimate stands.

Counts are gathered per distinct word, then per distinct window (context and byte). The tree splits
into independent parts by the byte nearest to the predicted one, so tasks build it in parallel, and
only the root (at most 255 decisions) is joined on the driver. Scores go back the same way: windows
to words, words to documents. The most frequent windows and words are broadcast, a number fixed by
``HEAD``; all others are joined.

Training rows may come in classes (such as languages). Then each class has a tree, and a text's
probability is the mixture of what the trees give it, weighted by the classes' training rows; the
class of the text itself is not looked at.

With ``across``, a token's context goes on into the tokens before it; ``byte_contexts`` then counts and scores the
bytes of whole texts with the levels defined here.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.cluster import checkpointed
from millrace.llm.byte_contexts import CHUNK_BYTES, answered, chunk_sums, chunked
from millrace.llm.words import SPACED, find_words, signed, slices, text_buffers

DEPTH = 7
PIECE = 1 << 15  # windows whose contexts are weighed at once
HEAD = 1 << 19  # entries of a broadcast table
MAX_CLASSES = 8
CLOSE, END = 0x20, 0x0A

_U = np.uint64
_LN10 = np.log(10.0)


def log_gamma(x: np.ndarray) -> np.ndarray:
    """ln Gamma for positive numbers: Stirling's series after a shift by eight."""
    shift = np.zeros_like(x)
    for k in range(8):
        shift += np.log(x + k)
    y = x + 8
    series = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5)
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + series - shift


_N = np.arange(1 << 12, dtype=float)
_HALVES, _WHOLES = log_gamma(_N + 0.5), log_gamma(_N + 1)


def _table(known: np.ndarray, n: np.ndarray, more: float) -> np.ndarray:
    """ln Gamma of whole numbers plus ``more``, from the table of the first ones."""
    value = known[np.minimum(n, len(known) - 1).astype(np.int32)]
    large = n >= len(known)
    if large.any():
        value[large] = log_gamma(n[large] + more)
    return value


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """ln of the Krichevsky-Trofimov probability of so many zeros and ones."""
    return _table(_HALVES, zeros, 0.5) + _table(_HALVES, ones, 0.5) - np.log(np.pi) - _table(_WHOLES, zeros + ones, 1)


def windows(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Window of every byte of the words, closing spaces included, and the word it belongs to.

    A window is the byte (low) and the bytes before it in the word, the nearest highest: a key whose
    prefixes are contexts. A space stands before the word, zeros before that.
    """
    size = end - start + 1
    word = np.repeat(np.arange(len(start)), size)
    at = np.arange(len(word)) - np.repeat(np.cumsum(size) - size, size)
    place = start[word] + at
    longest = np.append(data, np.uint8(0))

    def byte(back: int) -> np.ndarray:
        k = at - back
        value = longest[np.maximum(place - back, 0)].astype(_U)
        value = np.where(k >= 0, value, np.where(k == -1, _U(CLOSE), _U(0)))
        return value

    key = np.where(at == size[word] - 1, _U(CLOSE), byte(0))
    for back in range(1, DEPTH + 1):
        key |= byte(back) << _U(8 * (8 - back))
    return key, word


END_WINDOW = (CLOSE << 56) | END


def by_row(row: np.ndarray, values: np.ndarray, rows: int) -> np.ndarray:
    """Sums of the rows of ``values`` by row number."""
    sums = [np.bincount(row, weights=v, minlength=rows) for v in values.T]
    return np.stack(sums, axis=1).astype(float)  # without any row, the sums are integers


class Level:
    """Decisions of all contexts of one depth; counts have a column for each class."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        self.keys = keys  # (context, byte), sorted
        self.counts = counts
        self.node, self.first, self.zeros, self.ones, self.log_pe, self.log_pw = [], [], [], [], [], []
        for bit in range(8):
            new = np.ones(len(keys), bool)
            prefix = keys >> _U(8 - bit)
            new[1:] = prefix[1:] != prefix[:-1]
            first = np.flatnonzero(new)
            one = ((keys >> _U(7 - bit)) & _U(1)).astype(bool)[:, None]
            ones = np.add.reduceat(np.where(one, counts, 0), first)
            zeros = np.add.reduceat(np.where(one, 0, counts), first)
            self.node.append(np.cumsum(new) - 1)
            self.first.append(first)
            self.zeros.append(zeros)
            self.ones.append(ones)
            self.log_pe.append(log_kt(zeros, ones))
            self.log_pw.append(self.log_pe[-1])

    def mix_in(self, bit: int, product: np.ndarray) -> None:
        """Mix own estimates with the product of the contexts one byte longer."""
        self.log_pw[bit] = np.logaddexp(self.log_pe[bit], product) - np.log(2)

    def weigh(self, below: Level, up: np.ndarray) -> None:
        """Mix with the level of contexts one byte longer (``up``: the row here of each of its keys)."""
        for bit in range(8):
            parent = self.node[bit][up[below.first[bit]]]
            self.mix_in(bit, by_row(parent, below.log_pw[bit], len(self.first[bit])))

    def above(self) -> tuple[Level, np.ndarray]:
        """The level of contexts one byte shorter, weighed, and the row there of each key."""
        known, up = np.unique((self.keys >> _U(16) << _U(8)) | (self.keys & _U(0xFF)), return_inverse=True)
        level = Level(known, by_row(up, self.counts, len(known)))
        level.weigh(self, up)
        return level, up

    @staticmethod
    def joined(pieces: list[Level]) -> Level:
        """One level of pieces that follow each other and share no context."""
        whole = Level.__new__(Level)
        whole.keys, whole.counts = (np.concatenate([getattr(p, n) for p in pieces]) for n in ("keys", "counts"))
        for name, sizes in (("node", "first"), ("first", "keys")):
            merged = []
            for bit in range(8):
                n = [len(p.keys) if sizes == "keys" else len(p.first[bit]) for p in pieces]
                shift = np.cumsum(n) - n
                merged.append(np.concatenate([getattr(p, name)[bit] + k for p, k in zip(pieces, shift, strict=True)]))
            setattr(whole, name, merged)
        for name in ("zeros", "ones", "log_pe", "log_pw"):
            setattr(whole, name, [np.concatenate([getattr(p, name)[bit] for p in pieces]) for bit in range(8)])
        return whole

    def estimate(self, bit: int, row: np.ndarray, one: np.ndarray, deeper: np.ndarray | None) -> np.ndarray:
        """Probability of the actual bits, given what the contexts below say (NaN: no such context)."""
        zeros, ones, node = self.zeros[bit], self.ones[bit], self.node[bit][row]
        seen = zeros + ones
        own = ((ones + 0.5) / (seen + 1))[node]
        np.subtract(1, own, out=own, where=~one)
        if deeper is not None:
            share = np.exp(self.log_pe[bit] - np.log(2) - self.log_pw[bit])[node]
            own = np.where(np.isnan(deeper), own, share * (own - deeper) + deeper)
        own[(seen == 0)[node]] = np.nan
        return own


def tree(keys: np.ndarray, counts: np.ndarray, depth: int, rates: bool) -> tuple[Level, np.ndarray, np.ndarray | None]:
    """Level ``depth`` over sorted windows, weighed; the row there of each window; and, if asked for, the probability
    of the windows' bits (bit, window, class) as mixed from the deepest context up to that depth.

    Many windows pass in pieces of ``PIECE``, or of the contexts one byte longer, level by level.
    """
    bits = np.empty((8, *counts.shape)) if rates else None
    ones = [((keys >> _U(7 - bit)) & _U(1)).astype(bool)[:, None] for bit in range(8)] if rates else []

    def mix_up(level: Level, row: np.ndarray, first: bool) -> None:
        for bit, one in enumerate(ones):
            bits[bit] = level.estimate(bit, row, one, None if first else bits[bit])

    if len(keys) <= PIECE or depth == DEPTH:
        level, row = Level(keys, counts), np.arange(len(keys))
        mix_up(level, row, True)
        for _ in range(DEPTH - depth):
            level, up = level.above()
            row = up[row]
            mix_up(level, row, False)
        return level, row, bits
    starts = np.append(0, np.flatnonzero(np.diff(keys >> _U(8 * (DEPTH - depth)))) + 1)
    cuts = [0]
    for a, b in zip(starts, np.append(starts[1:], len(keys)), strict=True):
        if b - cuts[-1] > PIECE and a > cuts[-1]:
            cuts.append(a)
    cuts.append(len(keys))
    pieces, rows, shift = [], [], 0
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        level, row, some = tree(keys[a:b], counts[a:b], depth + 1, rates)
        pieces.append(level)
        rows.append(row + shift)
        shift += len(level.keys)
        if rates:
            bits[:, a:b] = some
    level, up = Level.joined(pieces).above()
    row = up[np.concatenate(rows)]
    mix_up(level, row, False)
    return level, row, bits


class Root:
    """Depth 0: at most 255 decisions in each class."""

    def __init__(self, classes: int) -> None:
        self.zeros, self.ones, self.below = (np.zeros((8, 256, classes)) for _ in range(3))

    def finish(self) -> None:
        own = log_kt(self.zeros, self.ones)
        self.share = np.exp(own - np.logaddexp(own, self.below))

    def log10(self, byte: np.ndarray, bits: np.ndarray) -> np.ndarray:
        total = np.zeros(bits.shape[1:])
        for bit in range(8):
            prefix = byte >> (8 - bit)
            one = ((byte >> (7 - bit)) & 1)[:, None]
            zeros, ones, share = self.zeros[bit][prefix], self.ones[bit][prefix], self.share[bit][prefix]
            own = (np.where(one, ones, zeros) + 0.5) / (zeros + ones + 1)
            total += np.log(np.where(np.isnan(bits[bit]), own, share * own + (1 - share) * bits[bit]))
        return total / _LN10


def _counts(names: list[str]) -> str:
    return ", ".join(f"{n} long" for n in names)


def _vocabulary(classes: int):
    """Distinct words of each batch with their occurrences in the training rows of each class (-1: none)."""

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            data, offsets = text_buffers(batch.column("text"))
            kind = batch.column("class").to_numpy(zero_copy_only=False).astype(np.int64)
            one_of = np.eye(classes + 1)[:, :classes]  # class -1 counts nowhere
            fps, counts, starts, ends, parts = [], [], [], [], []
            shift = 0
            for begin, end in slices(offsets):
                words = find_words(data, offsets[begin : end + 1], SPACED)
                known, first, inverse = np.unique(words.fp, return_index=True, return_inverse=True)
                cell = inverse * (classes + 1) + kind[begin + words.row] % (classes + 1)
                counted = np.bincount(cell, minlength=len(known) * (classes + 1)).reshape(-1, classes + 1)
                fps.append(known)
                counts.append(counted @ one_of)
                starts.append(words.start[first] + shift)
                ends.append(words.end[first] + shift)
                parts.append(words.data)
                shift += len(words.data)
            if not fps:
                continue
            text = np.concatenate(parts)
            known, first, inverse = np.unique(np.concatenate(fps), return_index=True, return_inverse=True)
            n = by_row(inverse, np.concatenate(counts), len(known)).astype(np.int64)
            start, end = np.concatenate(starts)[first], np.concatenate(ends)[first]
            size = end - start
            at = np.zeros(len(size) + 1, np.int64)
            np.cumsum(size, out=at[1:])
            place = np.repeat(start - at[:-1], size) + np.arange(at[-1])
            binary = pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), len(size), [None, pa.py_buffer(at), pa.py_buffer(text[place])]
            ).cast(pa.binary())
            columns = [pa.array(np.ascontiguousarray(c)) for c in n.T]
            yield pa.RecordBatch.from_arrays(
                [binary, pa.array(signed(known)), *columns], names=["word", "fp", *(f"n{k}" for k in range(classes))]
            )

    return batches


def _word_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8), offsets


def _matrix(batch: pa.RecordBatch | pa.Table, names: list[str]) -> np.ndarray:
    return np.stack([batch.column(n).to_numpy() for n in names], axis=1)


def _window_batches(names: list[str]):
    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            data, offsets = _word_bytes(batch.column("word"))
            key, word = windows(data, offsets[:-1], offsets[1:])
            known, inverse = np.unique(key, return_inverse=True)
            n = by_row(inverse, _matrix(batch, names)[word], len(known)).astype(np.int64)
            columns = [pa.array(np.ascontiguousarray(c)) for c in n.T]
            yield pa.RecordBatch.from_arrays([pa.array(signed(known)), *columns], names=["key", *names])

    return batches


def _parts(source: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Sorted windows and counts of each part of the tree that a partition holds."""
    got = list(source)
    if not sum(map(len, got)):
        return
    table = pa.Table.from_batches(got)
    keys = table.column("key").to_numpy().view(_U)
    by = np.argsort(keys)
    keys, counts = keys[by], _matrix(table, names)[by].astype(float)
    cuts = np.flatnonzero(np.diff((keys >> _U(56)).astype(np.int64), prepend=-1))
    for a, b in zip(cuts, np.append(cuts[1:], len(keys)), strict=True):
        yield keys[a:b], counts[a:b]


def _total_batches(names: list[str]):
    """For each part, zeros, ones and weighted probabilities of its decisions at depth 1."""

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, counts in _parts(source, names):
            top = tree(keys, counts, 1, False)[0]
            totals = np.zeros((3, 8, 256, len(names)))
            for bit in range(8):
                prefix = ((top.keys[top.first[bit]] & _U(0xFF)) >> _U(8 - bit)).astype(np.int64)
                totals[0, bit, prefix] = top.zeros[bit]
                totals[1, bit, prefix] = top.ones[bit]
                totals[2, bit, prefix] = np.where(top.zeros[bit] + top.ones[bit] > 0, top.log_pw[bit], 0.0)
            at = np.array([0, totals.size], np.int32)
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array(at), pa.array(totals.ravel()))], names=["totals"])

    return batches


def _rate_batches(names: list[str], values: list[str], shared):
    """log10 probability of every window in each class."""

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, counts in _parts(source, names):
            value = shared.value.log10((keys & _U(0xFF)).astype(np.int64), tree(keys, counts, 1, True)[2]).astype(np.float32)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(signed(keys)),
                    pa.array(counts.sum(axis=1).astype(np.int64)),
                    *(pa.array(np.ascontiguousarray(v)) for v in value.T),
                ],
                names=["key", "n", *values],
            )

    return batches


def _lookup(known: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(known):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    place = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
    return place, known[place] == wanted


def _head(table: DataFrame, key: str, by: str, values: list[str], size: int):
    """The ``size`` rows with the largest ``by`` as sorted arrays, broadcast."""
    rows = table.orderBy(F.desc(by), key).limit(size).select(key, *values).toArrow()
    keys = rows.column(key).to_numpy()
    order = np.argsort(keys)
    arrays = [keys[order], *(rows.column(v).to_numpy()[order] for v in values)]
    return table.sparkSession.sparkContext.broadcast(arrays)


def _sums(of: np.ndarray, values: np.ndarray, rows: int) -> pa.Array:
    """Sums of class values by row, as a list column."""
    flat = by_row(of, values, rows)
    at = (np.arange(rows + 1) * values.shape[1]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(at), pa.array(flat.ravel()))


def _word_rates(vocabulary: DataFrame, rows: list[int], head: int) -> tuple[DataFrame, np.ndarray]:
    """Of every word its training count and log10 probability in each class; and those of the end mark."""
    spark, classes = vocabulary.sparkSession, len(rows)
    names = [f"n{k}" for k in range(classes)]
    summed = [F.sum(n).alias(n) for n in names]
    values = [f"v{k}" for k in range(classes)]
    value_fields = ", ".join(f"{v} float" for v in values)
    counted = vocabulary.select("word", *names).mapInArrow(_window_batches(names), f"key long, {_counts(names)}")
    end_rows = [F.lit(n).cast("long").alias(f"n{k}") for k, n in enumerate(rows)]
    end_mark = spark.range(1).select(F.lit(END_WINDOW).alias("key"), *end_rows)
    grouped = checkpointed(counted.union(end_mark).groupBy("key").agg(*summed))
    # One part of the tree for each byte before the predicted one; distinct windows only, so none is hot.
    # Parts are built twice, for the root and with it, which is cheaper than to keep what they say bit by bit.
    parts = grouped.repartition(64, F.shiftrightunsigned("key", 56))
    root = Root(classes)
    for row in parts.mapInArrow(_total_batches(names), "totals array<double>").collect():  # at most 256 rows
        zeros, ones, below = np.array(row[0]).reshape(3, 8, 256, classes)
        root.zeros, root.ones, root.below = root.zeros + zeros, root.ones + ones, root.below + below
    root.finish()
    rated = _rate_batches(names, values, spark.sparkContext.broadcast(root))
    rates = checkpointed(parts.mapInArrow(rated, f"key long, n long, {value_fields}"))
    window_head = _head(rates, "key", "n", values, head)
    end_values = np.array(rates.where(F.col("key") == END_WINDOW).select(*values).first())

    def word_values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, *value = window_head.value
        value = np.stack(value, axis=1).astype(float)
        for batch in batches:
            data, offsets = _word_bytes(batch.column("word"))
            key, word = windows(data, offsets[:-1], offsets[1:])
            place, has = _lookup(known, signed(key))
            sums = by_row(word[has], value[place[has]], len(batch))
            missing, of = key[~has], word[~has]
            at = np.searchsorted(of, np.arange(len(batch) + 1)).astype(np.int32)
            rest = pa.ListArray.from_arrays(pa.array(at), pa.array(signed(missing)))
            columns = [pa.array(np.ascontiguousarray(v, np.float32)) for v in sums.T]
            n = _matrix(batch, names).sum(axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("fp"), pa.array(n), *columns, rest], names=["fp", "n", *values, "rest"]
            )

    worded = checkpointed(vocabulary.mapInArrow(word_values, f"fp long, n long, {value_fields}, rest array<long>"))
    more = [F.sum(F.col(v).cast("double")).alias(f"more_{v}") for v in values]
    rare = worded.select("fp", F.explode("rest").alias("key")).join(rates.select("key", *values), "key").groupBy("fp").agg(*more)
    whole = worded.where(F.size("rest") == 0).select("fp", "n", *values).union(
        worded.where(F.size("rest") > 0)
        .join(rare, "fp")
        .select("fp", "n", *((F.col(v) + F.col(f"more_{v}")).cast("float").alias(v) for v in values))
    )
    return checkpointed(whole), end_values


def ctw_scores(
    docs: DataFrame, train: Column, group: Column | None = None, head: int = HEAD, across: bool = False, chunk_bytes: int = CHUNK_BYTES
) -> DataFrame:
    """Scores of every row of ``docs(doc_id, text)``, learnt from the rows where ``train`` holds.

    ``(doc_id, train, n_bytes, n_tokens, n_known, train_tokens, base_score, score)``. Tokens are the words of the
    text (A-Z lower-cased, split at ASCII white space) and one end mark; a null text counts as empty.
    ``base_score`` is the smoothed unigram log10 probability, ``score`` that of the weighted context
    trees; ``-score / (log10(2) * n_bytes)`` is the code length in bits per byte, closing bytes
    included. Values of windows and words are kept in single precision, sums in double. ``group`` names the class of a training row; the ``MAX_CLASSES - 1`` largest have trees of
    their own, all others (and null) share one. Rows repeat as given; other columns are ignored; a
    null ``train`` is false. Without training rows, every bit has probability one half. Runs jobs.

    With ``across``, contexts reach over words: a text is the stream of its tokens, an end mark stands before it
    and zeros before that (``byte_contexts``), so the order of words counts.
    """
    spark = docs.sparkSession
    source = docs.select(
        "doc_id",
        "text",
        F.coalesce(train, F.lit(False)).alias("train"),
        (F.lit("") if group is None else F.coalesce(group.cast("string"), F.lit(""))).alias("group"),
    )
    sizes = source.where("train").groupBy("group").count().orderBy(F.desc("count"), "group").limit(MAX_CLASSES - 1).collect()
    ends = source.where("train").count()
    own_rows = [r["count"] for r in sizes]
    rows = own_rows + ([ends - sum(own_rows)] if ends > sum(own_rows) or not sizes else [])
    classes = len(rows)
    kind = F.lit(classes - 1)
    for k, r in enumerate(sizes):
        kind = F.when(F.col("group") == r["group"], k).otherwise(kind)
    source = source.withColumn("class", F.when(F.col("train"), kind).otherwise(-1).cast("int")).drop("group")
    names = [f"n{k}" for k in range(classes)]
    summed = [F.sum(n).alias(n) for n in names]

    found = source.select("text", "class").mapInArrow(_vocabulary(classes), f"word binary, fp long, {_counts(names)}")
    vocabulary = checkpointed(found.groupBy("fp", "word").agg(*summed))
    seen = sum((F.col(n) for n in names), F.lit(0))
    tokens, types = vocabulary.agg(F.coalesce(F.sum(seen), F.lit(0)), F.count_if(seen > 0)).first()
    total, distinct = tokens + ends, types + (ends > 0)

    values = [f"v{k}" for k in range(classes)]
    if across:
        words, end_values, rated = vocabulary.select("fp", seen.cast("long").alias("n")), np.zeros(classes), []
    else:
        words, end_values = _word_rates(vocabulary, rows, head)
        rated = values
    word_head = _head(words, "fp", "n", ["n", *rated], head)
    bottom = total + 0.5 * (distinct + 1)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, times, *value = word_head.value
        value = np.stack(value, axis=1).astype(float)
        base = np.log10((times + 0.5) / bottom)
        row_id = TaskContext.get().partitionId() << 40
        for batch in batches:
            data, offsets = text_buffers(batch.column("text"))
            for begin, end in slices(offsets):
                words = find_words(data, offsets[begin : end + 1], SPACED)
                n = end - begin
                place, has = _lookup(known, signed(words.fp))
                at, of = place[has], words.row[has]
                missing = signed(words.fp[~has])
                rest_at = np.searchsorted(words.row[~has], np.arange(n + 1)).astype(np.int32)
                size = np.bincount(words.row, weights=words.end - words.start + 1, minlength=n) + 1
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(row_id, row_id + n)),
                        batch.column("doc_id")[begin:end],
                        batch.column("train")[begin:end],
                        pa.array(size.astype(np.int64)),
                        pa.array(words.counts() + 1),
                        pa.array(np.bincount(of, weights=times[at] > 0, minlength=n).astype(np.int64)),
                        pa.array(np.bincount(of, weights=base[at], minlength=n).astype(float)),
                        _sums(of, value[at], n),
                        pa.ListArray.from_arrays(pa.array(rest_at), pa.array(missing)),
                    ],
                    names=["row_id", "doc_id", "train", "n_bytes", "n_tokens", "n_known", "base_score", "sums", "rest"],
                )
                row_id += n

    def scored_chunk(chunk: pa.Table, answers: pa.Table) -> pa.Table:
        known, times, *_ = word_head.value
        base = np.log10((times + 0.5) / bottom)
        number = chunk.column("chunk")[0].as_py() << 21
        tables = []
        for begin, end, stream, at, sums in chunk_sums(chunk, answers, classes):
            n = end - begin
            words = find_words(stream, at, SPACED)
            place, has = _lookup(known, signed(words.fp))
            at_known, of = place[has], words.row[has]
            rest_at = np.searchsorted(words.row[~has], np.arange(n + 1)).astype(np.int32)
            lists = (chunk.column(c)[0].values[begin:end] for c in ("ids", "trains", "size"))
            tables.append(
                pa.Table.from_arrays(
                    [
                        pa.array(np.arange(number + begin, number + end)),
                        *lists,
                        pa.array(words.counts() + 1),
                        pa.array(np.bincount(of, weights=times[at_known] > 0, minlength=n).astype(np.int64)),
                        pa.array(np.bincount(of, weights=base[at_known], minlength=n).astype(float)),
                        pa.ListArray.from_arrays(pa.array((np.arange(n + 1) * classes).astype(np.int32)), pa.array(sums.ravel())),
                        pa.ListArray.from_arrays(pa.array(rest_at), pa.array(signed(words.fp[~has]))),
                    ],
                    names=["row_id", "doc_id", "train", "n_bytes", "n_tokens", "n_known", "base_score", "sums", "rest"],
                )
            )
        return pa.concat_tables(tables)

    fields = f"row_id long, doc_id {dict(source.dtypes)['doc_id']}, train boolean, n_bytes long, n_tokens long"
    fields = f"{fields}, n_known long, base_score double, sums array<double>, rest array<long>"
    if across:
        chunks = chunked(source, chunk_bytes)
        answers = answered(spark, chunks, classes)
        placed = checkpointed(chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(scored_chunk, fields))
    else:
        placed = checkpointed(source.select("doc_id", "text", "train").mapInArrow(scored, fields))
    tail = (
        placed.select("row_id", F.explode("rest").alias("fp"))
        .groupBy("row_id", "fp")
        .agg(F.count("*").alias("times"))
        .join(words, "fp")
        .groupBy("row_id")
        .agg(
            F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("known_more"),
            F.sum(F.col("times") * F.log10((F.col("n") + 0.5) / F.lit(bottom))).alias("base_more"),
            *(F.sum(F.col("times") * F.col(v).cast("double")).alias(v) for v in rated),
        )
    )
    none = F.lit(0)
    by_class = [
        F.col("sums")[k] + (none if across else F.coalesce(v, none)) + float(end_values[k] + np.log10(max(rows[k], 1) / max(ends, 1)))
        for k, v in enumerate(values)
    ]
    best = F.greatest(*by_class) if classes > 1 else by_class[0]
    mixture = best + F.log10(sum((F.pow(F.lit(10.0), c - best) for c in by_class), F.lit(0.0)))
    return placed.join(tail, "row_id", "left").select(
        "doc_id",
        "train",
        "n_bytes",
        "n_tokens",
        (F.col("n_known") + F.coalesce("known_more", none) + int(ends > 0)).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base_score") + F.coalesce("base_more", none) + float(np.log10((ends + 0.5) / bottom))).alias("base_score"),
        mixture.alias("score"),
    )

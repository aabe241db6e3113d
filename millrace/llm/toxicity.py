"""Toxicity by the nearest labelled examples: exact TF-IDF cosine over a block-max inverted index.

The labelled examples are a bounded sample. Terms are words and the first bytes of longer words; the
vocabulary keeps all terms that at least three examples hold and whose presence differs between the classes by a
chi-squared test with a fixed bound, and their document frequencies are counted over all documents. Examples lie in
blocks of like ones; a query opens only the blocks whose bound reaches its k-th nearest example, so the
neighbours are exact.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.cluster import checkpointed, collected
from millrace.llm.words import ALNUM, CODE, SLICE_BYTES, find_words, finished, mix, powers, signed, slices, text_buffers

MAX_EXAMPLES = 20_000  # labelled rows the classifier is fitted on: those with the smallest hashed ids
MIN_CHI2 = 20.0  # vocabulary: all terms in three or more examples whose chi-squared value is as large
PREFIXES = (3, 4, 5, 6)  # bytes
NEIGHBOURS = 25
BLOCK = 32  # examples
FULL = 8  # a term in every eighth block or more has a table of all blocks
FILTER_BITS = 16
LEADING = 4  # heaviest terms that order the examples
ALLOWANCE = 1e-12  # half a unit of the twelfth digit, and the last bits of sums
EVIDENCE = 5
MEMO_BYTES = 32 << 20  # of a worker
PRIOR = 1.0  # votes of the examples as a whole

_U = np.uint64
_FACT = T.StructType().add("doc_id", T.StringType()).add("toxic", T.IntegerType()).add("cosine", T.DoubleType())
_SCORED = (
    T.StructType().add("score", T.DoubleType()).add("predicted", T.IntegerType()).add("evidence", T.ArrayType(_FACT))
)


def _kinds(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row and fingerprint of the words, then of each length of prefix."""
    words = find_words(data, offsets, ALNUM)
    yield words.row, words.fp
    row, start, length = words.row, words.start, words.end - words.start
    power, _ = powers(max(PREFIXES))
    running, done = np.zeros(len(row), _U), 0
    for n in PREFIXES:
        long = np.flatnonzero(length > n)
        row, start, length, running = row[long], start[long], length[long], running[long]
        for j in range(done, n):
            running += CODE[words.data[start + j]] * power[j]
        done = n
        yield row, mix(finished(running, np.full(len(row), n)) + _U(n))


def terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and fingerprint of every term occurrence."""
    rows, values = zip(*_kinds(data, offsets), strict=True)
    return np.concatenate(rows), np.concatenate(values)


def _presence(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of each class that hold a term, summed over each run of rows."""
    for batch in source:
        data, offsets = text_buffers(batch.column("text"))
        toxic = batch.column("toxic").to_numpy(zero_copy_only=False)
        for begin, end in slices(offsets):
            row, term = terms(data, offsets[begin : end + 1])
            by = np.lexsort((row, term))
            row, term = row[by], term[by]
            new = np.ones(len(term), bool)
            new[1:] = (term[1:] != term[:-1]) | (row[1:] != row[:-1])
            known, which = np.unique(term[new], return_inverse=True)
            bad = np.bincount(which, weights=toxic[begin + row[new]], minlength=len(known))
            n = np.bincount(which, minlength=len(known))
            yield pa.RecordBatch.from_arrays(
                [pa.array(signed(known)), pa.array(n.astype(np.int64)), pa.array(bad.astype(np.int64))],
                names=["term", "n", "bad"],
            )


def _holders(vocabulary: np.ndarray):
    """Documents that hold a term of the vocabulary, summed over each run of rows; term -1 counts all rows."""

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            data, offsets = text_buffers(batch.column("text"))
            for begin, end in slices(offsets):
                row, number = _numbered(data, offsets[begin : end + 1], vocabulary)
                held = np.unique(row * len(vocabulary) + number) % max(len(vocabulary), 1)
                n = np.bincount(held, minlength=len(vocabulary))
                number = np.append(np.flatnonzero(n), -1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(number), pa.array(np.append(n[n > 0], end - begin))], names=["number", "n"]
                )

    return batches


def _numbered(data: np.ndarray, offsets: np.ndarray, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and number of every occurrence of a term of the vocabulary."""
    if not len(vocabulary):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    held = np.zeros(1 << FILTER_BITS, bool)  # most terms are none of the vocabulary: their first bits tell
    shift = _U(64 - FILTER_BITS)
    held[vocabulary >> shift] = True
    rows, numbers = [], []
    for row, term in _kinds(data, offsets):
        maybe = np.flatnonzero(held[term >> shift])
        number = np.minimum(np.searchsorted(vocabulary, term[maybe]), len(vocabulary) - 1)
        known = vocabulary[number] == term[maybe]
        rows.append(row[maybe[known]])
        numbers.append(number[known])
    return np.concatenate(rows), np.concatenate(numbers)


@dataclass
class Vectors:
    """Unit TF-IDF vectors of rows: term numbers and weights, row by row."""

    at: np.ndarray
    term: np.ndarray
    weight: np.ndarray


def vectors(data: np.ndarray, offsets: np.ndarray, vocabulary: np.ndarray, idf: np.ndarray) -> Vectors:
    n = len(offsets) - 1
    if not len(vocabulary):
        return Vectors(np.zeros(n + 1, np.int64), np.zeros(0, np.int64), np.zeros(0))
    row, number = _numbered(data, offsets, vocabulary)
    cell, times = np.unique(row * len(vocabulary) + number, return_counts=True)
    row, term = np.divmod(cell, len(vocabulary))
    weight = (1 + np.log(times)) * idf[term]
    norm = np.sqrt(np.bincount(row, weights=weight**2, minlength=n))
    return Vectors(np.searchsorted(row, np.arange(n + 1)), term, weight / norm[row])


def _spread(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers of all ranges ``start .. start + size - 1``, one range after the other."""
    before = np.cumsum(size) - size
    return np.repeat(start - before, size) + np.arange(int(size.sum()))


def _alike(examples: Vectors, toxic: np.ndarray) -> np.ndarray:
    """Examples in an order that puts like ones side by side: by class, then by their heaviest terms, then by number."""
    n = len(toxic)
    row = np.repeat(np.arange(n), np.diff(examples.at))
    by = np.lexsort((examples.term, -examples.weight, row))
    heavy = np.full((LEADING, n), -1)
    for i in range(LEADING):
        has = np.flatnonzero(np.diff(examples.at) > i)
        heavy[i, has] = examples.term[by[examples.at[has] + i]]
    return np.lexsort((np.arange(n), *heavy[::-1], toxic))


class Index:
    """Block-max inverted index over the examples' vectors, and the votes of nearest examples.

    Examples are ordered so that like ones share a block of ``BLOCK``. The postings of a term are parted by block, and
    each part states the largest weight in it. The sum of a query's weights times these maxima bounds every cosine in a
    block, so blocks are opened from the highest bound down, and those that cannot hold one of the k nearest stay closed.
    Terms found in many blocks have their parts and maxima in tables by block, so that bounds are a product of a vector
    and rows of a matrix, and the parts of opened blocks are looked up; the tables hold at most ``FULL`` cells a part.
    """

    def __init__(self, vocabulary: np.ndarray, idf: np.ndarray, examples: Vectors, toxic: np.ndarray, k: int):
        self.vocabulary, self.idf, self.toxic, self.k = vocabulary, idf, toxic.astype(float), k
        n = len(toxic)
        self.blocks = -(-n // BLOCK)
        self.number = _alike(examples, toxic)  # of the example at a place
        place = np.empty(n, np.int64)
        place[self.number] = np.arange(n)
        self.first = np.minimum.reduceat(self.number, np.arange(0, n, BLOCK)) if n else np.zeros(0, np.int64)
        at = np.repeat(place, np.diff(examples.at))
        by = np.lexsort((at, examples.term))
        at, self.weight, term = at[by], examples.weight[by], examples.term[by]
        self.within = (at % BLOCK).astype(np.int32)  # place in its block
        part = term * max(self.blocks, 1) + at // BLOCK
        begin = np.flatnonzero(np.diff(part, prepend=-1))  # where a part of a term's postings starts
        self.part_at, self.part_size = begin, np.diff(np.append(begin, len(part)))
        self.part_block = at[begin] // BLOCK
        self.part_max = np.maximum.reduceat(self.weight, begin) if len(begin) else np.zeros(0)
        self.parts_of = np.searchsorted(term[begin], np.arange(len(vocabulary) + 1))
        full = np.flatnonzero(np.diff(self.parts_of) * FULL >= max(self.blocks, 1))
        self.table = np.full(len(vocabulary), -1)  # row of a term in the tables
        self.table[full] = np.arange(len(full))
        self.full_part = np.full((len(full), self.blocks), -1, np.int32)
        self.full_max = np.zeros((len(full), self.blocks))
        of = np.repeat(self.table, np.diff(self.parts_of))
        own = np.flatnonzero(of >= 0)
        self.full_part[of[own], self.part_block[own]] = own
        self.full_max[of[own], self.part_block[own]] = self.part_max[own]
        self.empty = np.flatnonzero(np.diff(examples.at) == 0)
        self.base = float(self.toxic.mean()) if n else 0.0
        self.curve: tuple[np.ndarray, np.ndarray] | None = None
        self.opened = 0  # blocks, by all queries
        self.memo: dict[bytes, tuple[float, list[int], list[float]]] = {}
        self.memo_bytes = 0

    def nearest(self, term: np.ndarray, weight: np.ndarray, without: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """The k examples of the largest positive cosine (ties: the smaller number), best first.

        Cosines are compared by twelve digits, and bounds with an allowance for the last bits of sums. A block at the k-th
        cosine itself opens only if it has a smaller number than the k-th example.
        """
        row = self.table[term]
        full, rare = np.flatnonzero(row >= 0), np.flatnonzero(row < 0)
        row = row[full]
        bound = weight[full] @ self.full_max[row]
        size = self.parts_of[term[rare] + 1] - self.parts_of[term[rare]]
        rare_part = _spread(self.parts_of[term[rare]], size)
        rare_factor, rare_block = np.repeat(weight[rare], size), self.part_block[rare_part]
        if len(rare):
            bound += np.bincount(rare_block, weights=rare_factor * self.part_max[rare_part], minlength=self.blocks)
        order = np.argsort(-bound, kind="stable")[: np.count_nonzero(bound > 0)]
        found, cosine = np.zeros(0, np.int64), np.zeros(0)
        slot = np.full(self.blocks, -1)
        batch = 1 + -(-self.k // BLOCK)
        while len(order):
            opened, order = order[:batch], order[batch:]
            batch *= 4
            self.opened += len(opened)
            slot[:] = -1
            slot[opened] = np.arange(len(opened)) * BLOCK
            looked = self.full_part[row[:, None], opened]
            which, column = np.nonzero(looked >= 0)
            use = np.flatnonzero(slot[rare_block] >= 0)
            part = np.append(looked[which, column], rare_part[use])
            size = self.part_size[part]
            posting = _spread(self.part_at[part], size)
            score = np.bincount(
                np.repeat(np.append(slot[opened[column]], slot[rare_block[use]]), size) + self.within[posting],
                weights=self.weight[posting] * np.repeat(np.append(weight[full][which], rare_factor[use]), size),
                minlength=len(opened) * BLOCK,
            )
            near = np.flatnonzero(score > (cosine[-1] - 2 * ALLOWANCE if len(found) == self.k else 0))
            number = self.number[opened[near // BLOCK] * BLOCK + near % BLOCK]
            near, number = near[number != without], number[number != without]
            found = np.append(found, number)
            cosine = np.append(cosine, np.round(score[near], 12))
            best = np.lexsort((found, -cosine))[: self.k]
            found, cosine = found[best], cosine[best]
            if len(found) == self.k:
                high = bound[order]
                order = order[(high > cosine[-1] + ALLOWANCE) | ((high > cosine[-1] - ALLOWANCE) & (self.first[order] < found[-1]))]
        return found, cosine

    def vote(self, term: np.ndarray, weight: np.ndarray, without: int = -1) -> tuple[float, list[int], list[float]]:
        """Votes weighted by 1 / (distance + a little); no shared term: the examples without terms vote."""
        if not len(term):
            bad = self.toxic[self.empty].sum() - (self.toxic[without] if without >= 0 else 0)
            n = len(self.empty) - (without >= 0)
            return float((bad + PRIOR * self.base) / (n + PRIOR)), [], []
        found, cosine = self.nearest(term, weight, without)
        power = 0.1 / (1.1 - cosine)  # 1 for the same direction, 1/11 for none in common
        share = (float(power @ self.toxic[found]) + PRIOR * self.base) / (float(power.sum()) + PRIOR)
        return share, found.tolist(), cosine.tolist()

    def calibrate(self, shares: np.ndarray) -> None:
        """Turn vote shares into rates: isotonic regression on leave-one-out votes of the examples, by number."""
        if not len(shares):
            return
        x, inverse = np.unique(np.round(shares, 3), return_inverse=True)
        size = np.bincount(inverse).astype(float)
        bad = np.bincount(inverse, weights=self.toxic)
        groups: list[list[float]] = []  # pooled neighbours: first x, last x, rows, toxic rows
        for xi, s, t in zip(x, size, bad, strict=True):
            groups.append([xi, xi, s, t])
            while len(groups) > 1 and groups[-2][3] * groups[-1][2] >= groups[-1][3] * groups[-2][2]:
                low, high = groups[-2], groups.pop()
                low[1], low[2], low[3] = high[1], low[2] + high[2], low[3] + high[3]
        rate = [(t + PRIOR * self.base) / (s + PRIOR) for _, _, s, t in groups]
        rate = np.maximum.accumulate(rate)
        self.curve = np.ravel([(g[0], g[1]) for g in groups]), np.repeat(rate, 2)

    def score(self, term: np.ndarray, weight: np.ndarray) -> tuple[float, list[int], list[float]]:
        """Calibrated share, and the first examples with their cosines."""
        key = term.tobytes() + weight.tobytes()
        if key not in self.memo:
            share, found, cosine = self.vote(term, weight)
            if self.curve is not None:
                share = float(np.interp(share, *self.curve))
            if self.memo_bytes > MEMO_BYTES:
                self.memo.clear()
                self.memo_bytes = 0
            self.memo[key] = share, found[:EVIDENCE], cosine[:EVIDENCE]
            self.memo_bytes += len(key) + 800  # the entry's own objects
        return self.memo[key]


def leave_one_out(spark: SparkSession, index: Index, examples: Vectors) -> np.ndarray:
    """Vote share of each example without itself, found in tasks. Runs a job."""
    n = len(index.toxic)
    shared = spark.sparkContext.broadcast((index, examples))  # at most ``MAX_EXAMPLES`` vectors

    def votes(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, ex = shared.value
        for batch in source:
            numbers = batch.column(0).to_numpy()
            shares = []
            for i in numbers.tolist():
                own = slice(ex.at[i], ex.at[i + 1])
                shares.append(model.vote(ex.term[own], ex.weight[own], i)[0])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(shares, pa.float64())], names=["id", "share"])

    rows = spark.range(n).mapInArrow(votes, "id long, share double").collect()
    shares = np.empty(n)
    for i, share in rows:
        shares[i] = share
    shared.unpersist()
    return shares


def labelled_examples(docs: DataFrame, labels: DataFrame, limit: int) -> DataFrame:
    """At most ``limit`` rows ``(example, text, toxic)`` with a label 0 or 1: the smallest hashes of the id."""
    known = (
        labels.select("doc_id", F.col("toxic").cast("int").alias("toxic"))
        .where("doc_id IS NOT NULL AND toxic IN (0, 1)")
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(limit)
    )
    texts = docs.select("doc_id", "text").where("doc_id IS NOT NULL")
    return (
        texts.join(F.broadcast(known), "doc_id")  # at most ``limit`` rows
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"), F.max(F.coalesce("text", F.lit(""))).alias("text"))
    )


def fit(docs: DataFrame, labels: DataFrame, limit: int = MAX_EXAMPLES, k: int = NEIGHBOURS) -> Index:
    """Vocabulary, index and calibration from at most ``limit`` labelled rows, document frequencies from all. Runs jobs."""
    examples = checkpointed(labelled_examples(docs, labels, limit))
    n, bad = (examples.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first())[:2]
    counted = (
        examples.select("text", "toxic").mapInArrow(_presence, "term long, n long, bad long").groupBy("term")
        .agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    )
    c = F.col
    top = c("n") * (n - c("n")) * float(bad * (n - bad))
    chi2 = float(n) * F.pow(c("bad") * float(n) - c("n") * float(bad), 2) / top
    chosen = collected(counted.where((c("n") >= 3) & (top > 0)).where(chi2 >= MIN_CHI2).select("term"))  # of bounded examples
    vocabulary = np.array([r["term"] for r in chosen], np.int64).view(_U)
    vocabulary = np.sort(vocabulary)
    idf = np.zeros(0)
    if len(vocabulary):
        held = docs.select("text").mapInArrow(_holders(vocabulary), "number long, n long").groupBy("number").agg(F.sum("n").alias("n"))
        count = dict(collected(held))  # a row per term
        frequency = np.array([count.get(i, 0) for i in range(len(vocabulary))], float)
        idf = np.log((1 + count.get(-1, 0)) / (1 + frequency)) + 1

    def vectorised(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            data, offsets = text_buffers(batch.column("text"))
            for begin, end in slices(offsets):
                v = vectors(data, offsets[begin : end + 1], vocabulary, idf)
                at = pa.array(v.at.astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(begin, end - begin),
                        batch.column("toxic").slice(begin, end - begin),
                        pa.ListArray.from_arrays(at, pa.array(v.term)),
                        pa.ListArray.from_arrays(at, pa.array(v.weight)),
                    ],
                    names=["doc_id", "toxic", "term", "weight"],
                )

    kind = dict(examples.dtypes)["doc_id"]
    rows = examples.mapInArrow(vectorised, f"doc_id {kind}, toxic int, term array<bigint>, weight array<double>")
    rows = collected(rows.orderBy("doc_id"))  # at most ``limit`` short vectors
    at = np.cumsum([0, *(len(r["term"]) for r in rows)])
    ex = Vectors(
        at,
        np.array([t for r in rows for t in r["term"]], np.int64),
        np.array([w for r in rows for w in r["weight"]], float),
    )
    index = Index(vocabulary, idf, ex, np.array([r["toxic"] for r in rows]), k)
    index.calibrate(leave_one_out(docs.sparkSession, index, ex))
    index.names = [r["doc_id"] for r in rows]
    return index


def toxicity_rate(spark: SparkSession, index: Index, text: str = "text") -> Column:
    """The score of ``score_toxicity`` as a column, without evidence: only the text goes to the workers, only a number comes back."""
    shared = spark.sparkContext.broadcast(index)

    def rates(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model: Index = shared.value
        for column in batches:
            data, offsets = text_buffers(column)
            scores = []
            for begin, end in slices(offsets, SLICE_BYTES):
                v = vectors(data, offsets[begin : end + 1], model.vocabulary, model.idf)
                scores += [model.score(v.term[a:b], v.weight[a:b])[0] for a, b in zip(v.at[:-1], v.at[1:], strict=True)]
            yield pa.array(scores, pa.float64())

    return F.arrow_udf(rates, T.DoubleType())(F.col(text))


def score_toxicity(docs: DataFrame, index: Index, carry: Sequence[str] = ()) -> DataFrame:
    """``(doc_id, score, predicted, evidence)`` per row of ``docs(doc_id, text)``.

    ``score`` is the calibrated share of toxic votes among the nearest examples, ``evidence`` the first
    five of them with label and cosine. A text without any term of the vocabulary (also empty or null)
    gets the rate of such examples; without any examples all scores are 0. Rows repeat as given; other
    columns are ignored but for those named in ``carry``, which stay beside the result. The index holds at most ``MAX_EXAMPLES`` short vectors and is broadcast.
    """
    source = docs.select("doc_id", "text", *(c for c in carry if c not in ("doc_id", "text")))
    shared = docs.sparkSession.sparkContext.broadcast(index)
    fact = pa.struct([("doc_id", pa.string()), ("toxic", pa.int32()), ("cosine", pa.float64())])

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Index = shared.value
        for batch in batches:
            data, offsets = text_buffers(batch.column("text"))
            scores, evidence = [], []
            for begin, end in slices(offsets, SLICE_BYTES):
                v = vectors(data, offsets[begin : end + 1], model.vocabulary, model.idf)
                for i in range(end - begin):
                    a, b = v.at[i], v.at[i + 1]
                    share, found, cosine = model.score(v.term[a:b], v.weight[a:b])
                    scores.append(share)
                    evidence.append(
                        [
                            {"doc_id": str(model.names[j]), "toxic": int(model.toxic[j]), "cosine": s}
                            for j, s in zip(found, cosine, strict=True)
                        ]
                    )
            values = np.array(scores)
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in kept),
                    pa.array(values, pa.float64()),
                    pa.array((values >= 0.5).astype(np.int32)),
                    pa.array(evidence, pa.list_(fact)),
                ],
                names=[*kept, "score", "predicted", "evidence"],
            )

    kept = list(carry) or ["doc_id"]
    return source.mapInArrow(scored, T.StructType([source.schema[c] for c in kept] + _SCORED.fields))

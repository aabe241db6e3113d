"""Hard negatives by an inverted multi-index over integer embeddings.

Each half of a vector is coded by the nearest word of its own codebook; a pair of words is a cell. Rows
are laid out by cell. A search takes the cells of a run of rows in the order of the sum of two half-score
bounds (inner product with the word plus norm times the radius of the rows coded by it), from a heap
over the two sorted lists, and stops when no cell left can change what was found, so results are exact.

Anchors pass in blocks of bounded size. For each block the best rows of every task are merged, first
for the positives, then for the windows that the positives' scores open.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.cluster import checkpointed
from millrace.llm.whiten import MAX_LONG, _matrix, _packed, unpacked

WORDS = 16  # of a half's codebook
SAMPLE = 4_096  # rows the codebooks are fitted on: those with the smallest hashed ids; every row is indexed
STEPS = 8
RUN_ROWS = 32_768  # rows searched at once by a task
BLOCK_BYTES = 8 << 20  # of anchors sent to the tasks at once
FIRST_LOOK = 512  # rows scored before results are looked at; doubles
RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"

Half = np.ndarray
Books = tuple[Half, Half]


def codebook(points: np.ndarray, words: int = WORDS, steps: int = STEPS) -> np.ndarray:
    """Means of clusters of ``points``, started from rows spread over them."""
    if not len(points):
        return np.zeros((1, points.shape[1]))
    distinct = np.unique(points, axis=0)
    book = distinct[np.linspace(0, len(distinct) - 1, min(words, len(distinct))).astype(int)]
    for _ in range(steps):
        own = nearest_word(points, book)
        for w in np.unique(own):
            book[w] = points[own == w].mean(axis=0)
    return book


def nearest_word(points: np.ndarray, book: np.ndarray) -> np.ndarray:
    return np.argmin((book**2).sum(axis=1) - 2 * (points @ book.T), axis=1)


def cells_of(x: np.ndarray, books: Books) -> np.ndarray:
    h = x.shape[1] // 2
    return nearest_word(x[:, :h].astype(float), books[0]) * len(books[1]) + nearest_word(x[:, h:].astype(float), books[1])


@dataclass
class Run:
    """Rows of a task, by cell, with the radius of each word."""

    ids: np.ndarray
    labels: np.ndarray
    x: np.ndarray
    books: Books
    start: np.ndarray = field(init=False)
    radius: tuple[np.ndarray, np.ndarray] = field(init=False)

    def __post_init__(self) -> None:
        cell = cells_of(self.x, self.books)
        by = np.argsort(cell, kind="stable")
        cell, self.ids, self.labels, x = cell[by], self.ids[by], self.labels[by], self.x[by]
        k = len(self.books[1])
        self.start = np.searchsorted(cell, np.arange(len(self.books[0]) * k + 1))
        h, radii = x.shape[1] // 2, []
        for book, word, part in ((self.books[0], cell // k, x[:, :h]), (self.books[1], cell % k, x[:, h:])):
            away = np.sqrt(((part.astype(float) - book[word]) ** 2).sum(axis=1))
            radius = np.full(len(book), -np.inf)  # a word of no row
            np.maximum.at(radius, word, away)
            radii.append(radius)
        self.radius = radii[0], radii[1]
        # Sums of products below 2^53 are exact in doubles; otherwise whole numbers of any size are used.
        self.largest = float(np.abs(x.astype(float)).max(initial=0.0))
        self.whole = x
        self.x = x.astype(float)

    def scores(self, q: np.ndarray, a: int, b: int) -> np.ndarray:
        if self.largest * float(np.abs(q.astype(float)).max(initial=0.0)) * len(q) < 2.0**53:
            return (self.x[a:b] @ q.astype(float)).astype(np.int64)
        exact = self.whole[a:b].astype(object) @ q.astype(object)
        return np.array([min(max(int(s), -MAX_LONG - 1), MAX_LONG) for s in exact], np.int64)

    def cells(self, q: np.ndarray) -> Iterator[tuple[float, int, int]]:
        """``(bound, from row, to row)`` of the cells with rows, by falling bound on the scores inside."""
        h, order, bounds = len(q) // 2, [], []
        for book, radius, part in zip(self.books, self.radius, (q[:h].astype(float), q[h:].astype(float)), strict=True):
            bound = np.where(np.isinf(radius), -np.inf, book @ part + np.linalg.norm(part) * np.where(np.isinf(radius), 0, radius))
            by = np.argsort(-bound, kind="stable")
            by = by[np.isfinite(bound[by])]
            order.append(by.tolist())
            bounds.append(bound[by].tolist())
        (rows, columns), (u, v), k = order, bounds, len(self.books[1])
        if not u or not v:
            return
        heap = [(-(u[0] + v[0]), 0, 0)]
        while heap:
            low, i, j = heapq.heappop(heap)
            if j == 0 and i + 1 < len(u):
                heapq.heappush(heap, (-(u[i + 1] + v[0]), i + 1, 0))
            if j + 1 < len(v):
                heapq.heappush(heap, (-(u[i] + v[j + 1]), i, j + 1))
            cell = rows[i] * k + columns[j]
            a, b = int(self.start[cell]), int(self.start[cell + 1])
            if a < b:
                yield -low + 1 + 1e-9 * abs(low), a, b  # one for rounding: scores are whole numbers


class Best:
    """The first ``k`` rows of a score window: higher scores first, ties by the smaller id."""

    def __init__(self, k: int, low: int = -MAX_LONG - 1, high: int = MAX_LONG):
        self.k, self.low, self.high = k, low, high
        self.ids, self.scores = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def need(self) -> int:
        """The least score that can still change the result."""
        return max(self.low, int(self.scores[-1])) if len(self.scores) == self.k else self.low

    def add(self, ids: np.ndarray, scores: np.ndarray) -> None:
        inside = (scores >= self.need()) & (scores <= self.high)
        if not inside.any():
            return
        ids, scores = np.concatenate([self.ids, ids[inside]]), np.concatenate([self.scores, scores[inside]])
        if len(scores) > self.k:
            least = np.partition(scores, len(scores) - self.k)[len(scores) - self.k]
            ids, scores = ids[scores >= least], scores[scores >= least]
        by = np.lexsort((ids, -scores))[: self.k]
        self.ids, self.scores = ids[by], scores[by]


def search(run: Run, q: np.ndarray, best: list[Best], wanted) -> int:
    """Add the rows of ``run`` to all of ``best``, those that ``wanted(from, to)`` marks; returns the rows scored."""
    seen, look, pending = 0, FIRST_LOOK, []

    def add() -> None:
        if pending:
            where = np.concatenate([np.flatnonzero(wanted(a, b)) + a for a, b, _ in pending])
            scores = np.concatenate([s[wanted(a, b)] for a, b, s in pending])
            for window in best:
                window.add(run.ids[where], scores)
            pending.clear()

    since, need = 0, min(w.need() for w in best)
    for bound, a, b in run.cells(q):
        if bound < need:
            break
        pending.append((a, b, run.scores(q, a, b)))
        seen, since = seen + b - a, since + b - a
        if since >= look:
            add()
            need, since, look = min(w.need() for w in best), 0, 2 * look
    add()
    return seen


@dataclass
class Anchor:
    id: int
    label: int
    x: np.ndarray
    windows: list[tuple[int, int]] = field(default_factory=list)  # positives and their scores


def _runs(source: Iterator[pa.RecordBatch], d: int, books: Books, most: int) -> Iterator[Run]:
    held: list[pa.RecordBatch] = []
    limit = max(1, min(most, (64 << 20) // (16 * d)))
    for batch in source:
        for at in range(0, len(batch), limit):
            held.append(batch.slice(at, limit))
            if sum(map(len, held)) >= limit:
                yield _run(held, d, books)
                held = []
    if sum(map(len, held)):
        yield _run(held, d, books)


def _run(held: list[pa.RecordBatch], d: int, books: Books) -> Run:
    table = pa.Table.from_batches(held).combine_chunks()
    x = np.concatenate([unpacked(chunk, d) for chunk in table.column("x").chunks])
    return Run(table.column("vec_id").to_numpy(), table.column("label").to_numpy(), x, books)


def _positive_batches(shared, d: int, books: Books, most: int, k: int):
    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors: list[Anchor] = shared.value
        best = [Best(k) for _ in anchors]
        for run in _runs(source, d, books, most):
            for anchor, own in zip(anchors, best, strict=True):
                search(run, anchor.x, [own], lambda a, b, w=anchor, r=run: (r.labels[a:b] == w.label) & (r.ids[a:b] != w.id))
        yield _rows([[a.id] * len(b.ids) for a, b in zip(anchors, best, strict=True)], best, ["anchor_id"], [])

    return batches


def _negative_batches(shared, d: int, books: Books, most: int, k: int, low: int, high: int):
    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors: list[Anchor] = shared.value
        # Whole-number limits of low * p <= 100 * n <= high * p.
        best = [[Best(k, -(-low * p // 100), high * p // 100) for _, p in a.windows] for a in anchors]
        for run in _runs(source, d, books, most):
            for anchor, own in zip(anchors, best, strict=True):
                open_windows = [w for w in own if w.low <= w.high]
                if open_windows:
                    search(run, anchor.x, open_windows, lambda a, b, w=anchor, r=run: r.labels[a:b] != w.label)
        flat = [(a, p, s, b) for a, own in zip(anchors, best, strict=True) for (p, s), b in zip(a.windows, own, strict=True)]
        yield _rows(
            [[a.id] * len(b.ids) for a, _, _, b in flat],
            [b for *_, b in flat],
            ["anchor_id", "positive_id", "positive_score"],
            [[[p] * len(b.ids) for _, p, _, b in flat], [[s] * len(b.ids) for _, _, s, b in flat]],
        )

    return batches


def _rows(ids: list, best: list[Best], names: list[str], more: list) -> pa.RecordBatch:
    flat = [[v for part in column for v in part] for column in [ids, *more]]
    found = [np.concatenate([np.zeros(0, np.int64), *(getattr(b, c) for b in best)]) for c in ("ids", "scores")]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in [*flat, *found]], names=[*names, "id", "score"])


def _coded(d: int, books: Books):
    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            rows, x = _matrix(batch.column("embedding"), d)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(pa.array(rows)),
                    batch.column("label").take(pa.array(rows)),
                    pa.array(_packed(x), pa.binary()),
                    pa.array(cells_of(x, books).astype(np.int32)),
                ],
                names=["vec_id", "label", "x", "cell"],
            )

    return batches


def hard_negatives(
    rows: DataFrame,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
    run_rows: int = RUN_ROWS,
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)`` of ``rows(vec_id, embedding, label)``.

    Scores are inner products of ``floor(256 * x)``. Anchors are the rows with ``is_anchor`` (over ``vec_id``); positives the
    first rows of the same label, negatives the first of other labels with ``low`` to ``high`` per cent of the
    positive's score (none, if that is negative). Ties go to the smaller ``vec_id``.

    Rows with a null id, label or vector, or a null or non-finite entry take no part, nor do vectors of another
    length than the most frequent one (ties: the longer). Of several rows with one id, that with the largest label and
    vector counts. Scores beyond the long range count as its ends. An empty table, or no anchors, gives no rows;
    other columns are ignored. Runs jobs; a block of anchors is sent to all tasks at once.
    """
    spark = rows.sparkSession
    known = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), "embedding").where(
        F.col("vec_id").isNotNull()
        & F.col("label").isNotNull()
        & F.col("embedding").isNotNull()
        & F.forall("embedding", lambda c: c.isNotNull() & (F.abs(c) < float("inf")))
    )
    top = known.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    d = int(top["d"]) if top else 0
    if not d:
        return spark.createDataFrame([], RESULT)
    sample = known.where(F.size("embedding") == d).orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("embedding")
    points = np.floor(256 * np.array([r["embedding"] for r in sample.collect()], float).reshape(-1, d))
    books = codebook(points[:, : d // 2]), codebook(points[:, d // 2 :])
    coded = known.mapInArrow(_coded(d, books), "vec_id long, label long, x binary, cell int")
    single = coded.groupBy("vec_id").agg(F.max(F.struct("label", "x", "cell")).alias("r")).select("vec_id", "r.*")
    index = checkpointed(checkpointed(single).repartitionByRange("cell", "vec_id"))

    asked = checkpointed(index.where(is_anchor).select("vec_id", "label", "x"))
    n = asked.count()
    blocks = max(1, -(-n * 8 * d // BLOCK_BYTES))
    done = []
    for block in range(blocks if n else 0):
        part = asked.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == block).collect()  # about BLOCK_BYTES
        xs = unpacked(pa.array([bytes(r["x"]) for r in part], pa.binary()), d)
        anchors = {r["vec_id"]: Anchor(r["vec_id"], r["label"], x) for r, x in zip(part, xs, strict=True)}
        shared = spark.sparkContext.broadcast(list(anchors.values()))
        best = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "id")  # a few rows a task and anchor
        near = index.mapInArrow(_positive_batches(shared, d, books, run_rows, positives), "anchor_id long, id long, score long")
        near = near.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= positives)
        for r in near.orderBy("anchor_id", "rank").collect():  # as many as the block's anchors, times ``positives``
            anchors[r["anchor_id"]].windows.append((r["id"], r["score"]))
        windows = spark.sparkContext.broadcast(list(anchors.values()))
        far = index.mapInArrow(
            _negative_batches(windows, d, books, run_rows, negatives, low, high),
            "anchor_id long, positive_id long, positive_score long, id long, score long",
        )
        best = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("score"), "id")
        far = far.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= negatives)
        done.append(
            checkpointed(
                far.select(
                    "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
                )
            )
        )
        shared.unpersist()
        windows.unpersist()
    if not done:
        return spark.createDataFrame([], RESULT)
    # One table a block; they are read back as one.
    out = done[0]
    for more in done[1:]:
        out = out.union(more)
    return out

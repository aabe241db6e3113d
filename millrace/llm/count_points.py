"""Sets as points of counts by group, in small trees: shared by the similarity joins.

Two sets share at most the sum of the smaller counts, and points under two tree nodes at most the sum of the
smaller upper corners.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.cluster import checkpointed, narrowed

GROUPS = 64  # of the trees' points; a larger set is also counted in more, for a closer bound on a pair
MOST_GROUPS = 4_096
NODE = 8  # points
PAGE = 128  # points
WIDTH = 20_000  # point pairs compared at once

def least_overlap(sizes: np.ndarray, percent: int) -> np.ndarray:
    """Shared elements that two sets with this sum of sizes need."""
    return -(-percent * sizes // (100 + percent))


def groups_of(n: int) -> int:
    """Groups in which a set of ``n`` is counted: a power of two from half its size."""
    return min(max(GROUPS, 1 << max(n - 1, 0).bit_length() - 1), MOST_GROUPS) if n > 1 else GROUPS


def pack(group: np.ndarray, groups: int = GROUPS) -> bytes:
    """Counts by the low bits of ``group``, one byte each where that is enough."""
    counts = np.bincount(group & (groups - 1), minlength=groups)
    return counts.astype("<u1" if counts.max() < 256 else "<u4").tobytes()


def pack_fine(group: np.ndarray) -> bytes | None:
    """Counts of a larger set by more groups."""
    groups = groups_of(len(group))
    return pack(group, groups) if groups > GROUPS else None


def unpack(blob: bytes, n: int, groups: int) -> np.ndarray:
    """Counts by ``groups``, at most those packed: groups with equal low bits are added."""
    counts = np.frombuffer(blob, "<u1" if len(blob) == groups_of(n) else "<u4")
    return counts.reshape(-1, groups).sum(axis=0, dtype=np.int64)


def vectors(blobs: list[bytes]) -> np.ndarray:
    """The points: counts by ``GROUPS`` groups."""
    out = np.empty((len(blobs), GROUPS), np.int32)
    length = np.array([len(b) for b in blobs], np.int64)
    for size in set(length.tolist()):
        rows = np.flatnonzero(length == size)
        joined = b"".join([blobs[i] for i in rows.tolist()])
        out[rows] = np.frombuffer(joined, "<u1" if size == GROUPS else "<u4").reshape(-1, GROUPS)
    return out


def fine_bound(x: bytes | None, n: int, y: bytes | None, m: int) -> int | None:
    """Bound on the overlap of two larger sets by all the groups that both are counted in; null if one is not."""
    if x is None or y is None:
        return None
    groups = min(groups_of(n), groups_of(m))
    return int(np.minimum(unpack(x, n, groups), unpack(y, m, groups)).sum())


def split(counts: np.ndarray, rows: np.ndarray) -> list[np.ndarray]:
    """Tree nodes of some points: halves at the median of the widest group, down to ``NODE`` points."""
    if len(rows) <= NODE:
        return [rows]
    own = counts[rows]
    by = rows[np.argsort(own[:, (own.max(axis=0) - own.min(axis=0)).argmax()], kind="stable")]
    half = (len(by) // 2 + NODE - 1) // NODE * NODE
    return split(counts, by[:half]) + split(counts, by[half:])


class Tree:
    """Points of some pages, their nodes and the nodes' upper corners."""

    def __init__(self, blobs: list[bytes], sizes: np.ndarray, pages: np.ndarray, fine: list[bytes | None] | None = None):
        """``pages``: where each page begins, and the end. With ``fine``, pairs get the closer bound too."""
        counts = vectors(blobs)
        self.first = []  # number of each page's first node
        nodes: list[np.ndarray] = []
        for a, b in zip(pages[:-1].tolist(), pages[1:].tolist(), strict=True):
            self.first.append(len(nodes))
            nodes += split(counts, np.arange(a, b)) if b - a > NODE else [np.arange(a, b)]
        self.first.append(len(nodes))
        self.rows = np.concatenate([*nodes, np.zeros(0, np.int64)]).astype(np.int64)
        self.counts, self.sizes, self.fine = counts[self.rows], sizes[self.rows], fine
        self.length = np.array([len(n) for n in nodes], np.int64)
        self.start = np.cumsum(self.length) - self.length
        if len(nodes):
            self.corner = np.maximum.reduceat(self.counts, self.start)
            self.least, self.most = np.minimum.reduceat(self.sizes, self.start), np.maximum.reduceat(self.sizes, self.start)


def _shares(x: np.ndarray, y: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Sums of the smaller counts of rows ``i`` of ``x`` and ``j`` of ``y``."""
    out = np.empty(len(i), np.int64)
    for at in range(0, len(i), WIDTH):
        out[at : at + WIDTH] = np.minimum(x[i[at : at + WIDTH]], y[j[at : at + WIDTH]]).sum(axis=1)
    return out


def surviving(x: Tree, y: Tree, a: np.ndarray, b: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Point pairs (positions in ``x.rows``, ``y.rows``) of node pairs whose bound allows a link, with bound over least overlap.

    If ``x is y``, a pair comes once.
    """
    open_ = (x.most[a] * 100 >= y.least[b] * percent) & (y.most[b] * 100 >= x.least[a] * percent)
    a, b = a[open_], b[open_]
    open_ = _shares(x.corner, y.corner, a, b) >= least_overlap(x.least[a] + y.least[b], percent)
    a, b = a[open_], b[open_]
    n = x.length[a] * y.length[b]
    pair = np.repeat(np.arange(len(a)), n)
    inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    i = x.start[a][pair] + inside // y.length[b][pair]
    j = y.start[b][pair] + inside % y.length[b][pair]
    good = (x.sizes[i] * 100 >= y.sizes[j] * percent) & (y.sizes[j] * 100 >= x.sizes[i] * percent)
    if x is y:
        good &= (a[pair] != b[pair]) | (i < j)
    i, j = i[good], j[good]
    need = least_overlap(x.sizes[i] + y.sizes[j], percent)
    bound = _shares(x.counts, y.counts, i, j)
    good = bound >= need
    i, j, bound, need = i[good], j[good], bound[good], need[good]
    if x.fine is not None and y.fine is not None:
        for at in np.flatnonzero(np.minimum(x.sizes[i], y.sizes[j]) > 2 * GROUPS).tolist():
            p, q = int(i[at]), int(j[at])
            closer = fine_bound(x.fine[x.rows[p]], int(x.sizes[p]), y.fine[y.rows[q]], int(y.sizes[q]))
            bound[at] = bound[at] if closer is None else closer
    good = bound >= need
    return i[good], j[good], bound[good] / need[good]


def grouped(source: Iterator[pa.RecordBatch], page: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Runs of sorted rows with whole pages only, and where the pages begin, and the end."""
    held: list[pa.RecordBatch] = []

    def cut(table: pa.Table) -> np.ndarray:
        key = table.column("key").to_numpy()
        new = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        length = np.diff(np.r_[new, len(key)])
        parts = -(-length // page)
        within = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        return np.r_[np.repeat(new, parts) + page * within, len(key)]

    for batch in source:
        if not len(batch):
            continue
        held.append(batch)
        table = pa.Table.from_batches(held).combine_chunks()
        pages = cut(table)
        if len(pages) > 2:  # the last page may go on in the next batch
            yield table.slice(0, int(pages[-2])).combine_chunks().to_batches()[0], pages[:-1]
            held = table.slice(int(pages[-2])).combine_chunks().to_batches()
        else:
            held = table.to_batches()
    if held:
        table = pa.Table.from_batches(held).combine_chunks()
        yield table.to_batches()[0], cut(table)


def page_batches(page_size: int):
    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, pages in grouped(source, page_size):
            at = pa.array(pages.astype(np.int32))
            lists = [pa.ListArray.from_arrays(at, batch.column(c)) for c in ("id", "component", "n_shingles", "counts", "fine")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key").take(pa.array(pages[:-1])), *lists],
                names=["key", "ids", "parts", "sizes", "counts", "fine"],
            )

    return batches


def between_batches(percent: int):
    """Pairs of points of two pages, in different components, that may link."""

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def tree(row: dict, side: str) -> Tree:
            sizes = np.array(row[f"{side}_sizes"], np.int64)
            return Tree(row[f"{side}_counts"], sizes, np.array([0, len(sizes)]), row[f"{side}_fine"])

        for batch in source:
            for at in range(len(batch)):
                row = batch.slice(at, 1).to_pylist()[0]
                x, y = tree(row, "x"), tree(row, "y")
                a, b = (v.ravel() for v in np.meshgrid(np.arange(len(x.length)), np.arange(len(y.length))))
                i, j, _ = surviving(x, y, a, b, percent)
                i, j = x.rows[i], y.rows[j]
                other = np.array(row["x_parts"])[i] != np.array(row["y_parts"])[j]
                p, q = np.array(row["x_ids"])[i[other]], np.array(row["y_ids"])[j[other]]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(p, q)), pa.array(np.maximum(p, q))], names=["a", "b"])

    return batches


def sorted_points(rows: DataFrame, whole: bool = False) -> DataFrame:
    """``rows(key, id, component, n_shingles, counts)``, maybe with ``fine``, by key and size; the rows of a key are ``whole`` in a task or cut by range."""
    order = ["key", "n_shingles", "id"]
    placed = rows.select(*order, "component", *(c for c in ("counts", "fine") if c in rows.columns))
    if whole:
        return placed.repartition("key").sortWithinPartitions(*order)
    return checkpointed(placed).repartitionByRange(*order).sortWithinPartitions(*order)


def _closer_batches(percent: int):
    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            good = np.ones(len(batch), bool)
            n, m = batch.column("n").fill_null(0).to_numpy(), batch.column("m").fill_null(0).to_numpy()
            need = least_overlap(n + m, percent)
            for at, (x, y) in enumerate(zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True)):
                bound = fine_bound(x, int(n[at]), y, int(m[at]))
                good[at] = bound is None or bound >= need[at]
            yield batch.select(["a", "b"]).filter(pa.array(good))

    return batches


def closer_pairs(pairs: DataFrame, points: DataFrame, percent: int) -> DataFrame:
    """Those of ``pairs(a, b)`` that the closer bound allows, by ``points(id, n_shingles, fine)``; others without ``fine`` stay.

    ``pairs`` is a written table.
    """
    large = narrowed(points.where("fine IS NOT NULL"), "id", pairs.select("a").union(pairs.select("b")))
    x = large.select(F.col("id").alias("a"), F.col("n_shingles").alias("n"), F.col("fine").alias("x"))
    y = large.select(F.col("id").alias("b"), F.col("n_shingles").alias("m"), F.col("fine").alias("y"))
    return pairs.join(x, "a", "left").join(y, "b", "left").mapInArrow(_closer_batches(percent), "a long, b long")


def pairs_with_outsiders(rows: DataFrame, percent: int, page: int = PAGE) -> DataFrame:
    """Pairs ``(a, b)`` that may link, of rows of one key in different components.

    ``rows`` as in ``sorted_points``, with ``fine``. Every key's rows outside its largest component meet all its rows, page by page, so
    a key of any size is spread over tasks, and pairs inside one component, which change nothing, are never made.
    """
    rows = checkpointed(rows)
    parts = checkpointed(rows.groupBy("key", "component").agg(F.count("*").alias("n")))
    mains = parts.groupBy("key").agg(F.max_by("component", F.struct("n", "component")).alias("main"), F.count("*").alias("parts"))
    open_ = rows.join(checkpointed(mains.where("parts > 1").select("key", "main")), "key")
    fields = "key long, ids array<long>, parts array<long>, sizes array<long>, counts array<binary>, fine array<binary>"

    def paged(rows_of: DataFrame, side: str) -> DataFrame:
        pages = sorted_points(rows_of).mapInArrow(page_batches(page), fields)
        return checkpointed(pages.select("key", *(F.col(c).alias(f"{side}_{c}") for c in ("ids", "parts", "sizes", "counts", "fine"))))

    outside, everyone = paged(open_.where("component <> main"), "x"), paged(open_, "y")
    overlap = (F.array_max("x_sizes") * 100 >= F.array_min("y_sizes") * percent) & (
        F.array_max("y_sizes") * 100 >= F.array_min("x_sizes") * percent
    )
    met = outside.join(everyone, "key").where(overlap).mapInArrow(between_batches(percent), "a long, b long")
    return met.distinct()

"""Whitening of embeddings on the largest principal components.

Entries become integers; the fit list holds each distinct integer vector once. Counts, sums and
centred products are summed in tasks and by Spark; the driver sees tables by dimension only, and
finds the components by contour integration (``feast``).
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.cluster import checkpointed
from millrace.llm.feast import largest_eigenpairs

COMPONENTS = 4
SCALE = 256
MAX_LONG = (1 << 63) - 1


def finite_rows(column: pa.Array, d: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of a list column without nulls and non-finite entries (of ``d`` entries, if given): number, entries, offsets."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    size = np.asarray(column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), np.int64)
    values = column.flatten()  # a null row has no entries here
    entries = values.cast(pa.float64()).to_numpy(zero_copy_only=False)  # null: not a number
    at = np.zeros(len(size) + 1, np.int64)
    np.cumsum(size, out=at[1:])
    bad = np.zeros(len(entries) + 1, np.int64)
    np.cumsum(~np.isfinite(entries), out=bad[1:])
    good = (bad[at[1:]] == bad[at[:-1]]) & column.is_valid().to_numpy(zero_copy_only=False)
    if d is not None:
        good &= size == d
    return np.flatnonzero(good), entries, at


def integers(entries: np.ndarray) -> np.ndarray:
    """``floor(256 * c)`` as 64-bit integers; beyond their range, the nearest of them."""
    scaled = np.floor(SCALE * entries)
    inside = np.clip(scaled, -(2.0**63), 2.0**63 - 1024).astype(np.int64)  # the largest double below the range's end
    return np.where(scaled >= 2.0**63, MAX_LONG, inside)


def _packed(matrix: np.ndarray) -> list[bytes]:
    """One value per distinct vector: 16-bit entries where all fit, else 64-bit ones after a mark."""
    small = (np.abs(matrix.astype(float)).max(axis=1, initial=0) < 32_000).tolist()
    narrow, wide = matrix.astype("<i2"), matrix.astype("<i8")
    return [narrow[i].tobytes() if s else b"\x01" + wide[i].tobytes() for i, s in enumerate(small)]


def unpacked(blobs: pa.Array, d: int) -> np.ndarray:
    out = np.empty((len(blobs), d), np.int64)
    for i, blob in enumerate(blobs):
        raw = blob.as_buffer().to_pybytes()
        out[i] = np.frombuffer(raw, "<i2") if len(raw) == 2 * d else np.frombuffer(raw[1:], "<i8")
    return out


def _matrix(column: pa.Array, d: int) -> tuple[np.ndarray, np.ndarray]:
    rows, entries, at = finite_rows(column, d)
    return rows, integers(entries[at[rows][:, None] + np.arange(d)])


def _fit_batches(d: int):
    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            _, x = _matrix(batch.column("embedding"), d)
            yield pa.RecordBatch.from_arrays([pa.array(_packed(x), pa.binary())], names=["x"])

    return batches


def _sum_batches(d: int):
    """Sums per dimension over the task's rows; dimension -1 counts them."""

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, [0] * d
        for batch in source:
            x = unpacked(batch.column("x"), d)
            exact = len(x) * float(np.abs(x.astype(float)).max(initial=0)) < 2.0**62
            n += len(x)
            own = x.sum(axis=0) if exact else x.astype(object).sum(axis=0)
            sums = [a + int(b) for a, b in zip(sums, own, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(-1, d), pa.int32()), pa.array([Decimal(v) for v in [n, *sums]], pa.decimal128(38, 0))],
            names=["dim", "s"],
        )

    return batches


def _upper(products: np.ndarray) -> pa.RecordBatch:
    i, j = np.triu_indices(len(products))
    arrays = [pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(products[i, j])]
    return pa.RecordBatch.from_arrays(arrays, names=["i", "j", "v"])


def _product_batches(mean: np.ndarray, axes: np.ndarray | None):
    """Products of centred entries (with ``axes``, of the projections on them), summed over the task's rows."""

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((0, 0))
        for batch in source:
            y = unpacked(batch.column("x"), len(mean)) - mean
            y = y if axes is None else y @ axes
            total = total + y.T @ y if total.size else y.T @ y
        if total.size:
            yield _upper(total)

    return batches


def _covariance(fit: DataFrame, n: int, mean: np.ndarray, axes: np.ndarray | None, order: int) -> np.ndarray:
    sums = fit.mapInArrow(_product_batches(mean, axes), "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v"))
    out = np.zeros((order, order))
    for i, j, v in sums.collect():  # a row per pair of dimensions
        out[i, j] = out[j, i] = v / n
    return out


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Exact sums of ``(n * x - S)^2``; null where one does not fit a long."""
    if not x.size:
        return [0] * len(x)
    largest = n * float(np.abs(x.astype(float)).max()) + float(max(map(abs, sums)))
    if largest < 2.0**62 and largest**2 * x.shape[1] < 2.0**62:
        return ((n * x - np.array(sums, np.int64)) ** 2).sum(axis=1).tolist()
    far = ((n * x.astype(object) - np.array(sums, object)) ** 2).sum(axis=1)
    return [int(v) if v <= MAX_LONG else None for v in far]


def _result_batches(d: int, n: int, sums: list[int], axes: np.ndarray, known: list[bool], explained: list[float | None], error: float | None):
    mean, k = np.array([s / n for s in sums]), axes.shape[1]

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            rows, x = _matrix(batch.column("embedding"), d)
            white = (x - mean) @ axes
            white[:, ~np.array(known, bool)] = np.nan
            m = len(rows)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(pa.array(np.repeat(rows, k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, n, np.int64)),
                    pa.array([v for v in deviations(x, n, sums) for _ in range(k)], pa.int64()),
                    pa.array(white.ravel(), pa.float64(), mask=np.isnan(white.ravel())),
                    pa.array(explained * m, pa.float64()),
                    pa.array([error] * (m * k), pa.float64()),
                ],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return batches


def whitened(rows: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """``(vec_id, component, n, deviation, whitened, explained, identity_error)`` per row of ``rows(vec_id, embedding)`` and component.

    Rows whose vector is null or holds a null or non-finite entry are dropped; so are vectors of another length than
    the most frequent one (ties: the longer). Equal vectors count once in the fit, but all their rows are returned;
    a null ``vec_id`` stays null. Entries become ``floor(256 * c)``, at the ends of the long range beyond it.
    A component without variance has ``whitened`` null and is left out of ``identity_error``; ``explained`` is
    null if nothing varies. ``deviation`` is null where it does not fit a long. An empty table gives no rows;
    other columns are ignored. The driver and the broadcast values hold tables by dimension only. Runs jobs.
    """
    source = rows.select("vec_id", "embedding")
    kind = source.schema["vec_id"].dataType
    out = T.StructType().add("vec_id", kind).add("component", "integer").add("n", "long").add("deviation", "long")
    for name in ("whitened", "explained", "identity_error"):
        out = out.add(name, "double")
    # The lengths of usable vectors: a few numbers, except in broken tables, where the most frequent is asked for.
    usable = F.forall("embedding", lambda c: c.isNotNull() & (F.abs(c) < float("inf")))
    lengths = source.where(F.col("embedding").isNotNull() & usable).groupBy(F.size("embedding").alias("d")).count()
    top = lengths.orderBy(F.desc("count"), F.desc("d")).first()
    if top is None or not top["d"]:
        return source.limit(0).select(*(F.lit(None).cast(f.dataType).alias(f.name) for f in out.fields))
    d = int(top["d"])
    fit = checkpointed(source.select("embedding").mapInArrow(_fit_batches(d), "x binary").distinct())
    counted = dict(fit.mapInArrow(_sum_batches(d), "dim int, s decimal(38,0)").groupBy("dim").agg(F.sum("s").alias("s")).collect())
    n, sums = int(counted[-1]), [int(counted[i]) for i in range(d)]
    mean = np.array([s / n for s in sums])
    covariance = _covariance(fit, n, mean, None, d)
    values, vectors = largest_eigenpairs(covariance, components)
    trace = float(np.trace(covariance))
    known = [bool(e > d * 1e-14 * trace) for e in values]
    axes = vectors / np.sqrt(np.where(known, values, 1.0))
    spread = _covariance(fit, n, mean, axes, len(values))
    error = float(np.abs(spread - np.eye(len(values)))[np.ix_(known, known)].max()) if any(known) else None
    explained = [max(float(e), 0.0) / trace if trace else None for e in values]
    return source.mapInArrow(_result_batches(d, n, sums, axes, known, explained, error), out)

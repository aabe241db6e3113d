"""Spreading regions of unequal size over tasks, and running a function per region."""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.cluster import checkpointed, small_side


def region_assignment(weights: DataFrame, tasks: int) -> DataFrame:
    """Longest-first greedy balancing of ``key, n``: ``key, n, task``.

    Regions go by (n, key) descending to the least loaded task, the lowest one on
    ties. The rule is sequential, so one row per region streams in order past a
    heap of the tasks' loads; memory is the number of tasks.
    """
    weights = weights.select("key", F.col("n").cast("bigint").alias("n"))
    in_order = weights.repartition(1).sortWithinPartitions(F.desc("n"), F.desc("key"))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loads = [(0, task) for task in range(tasks)]
        for batch in batches:
            picks = []
            for n in batch.column("n").to_pylist():
                load, task = loads[0]
                heapq.heapreplace(loads, (load + (n or 0), task))
                picks.append(task)
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("n"), pa.array(picks, pa.int32())], names=["key", "n", "task"]
            )

    return in_order.mapInArrow(assign, T.StructType([*weights.schema.fields, T.StructField("task", T.IntegerType())]))


def balanced_repartition(
    rows: DataFrame, key: str, assignment: DataFrame, order_by: Sequence[str] = ()
) -> DataFrame:
    """Add each row's ``task`` as a label and lay rows out by it, in order.

    Range partitioning cuts a heavy task into several partitions that follow one
    another, and may put light ones together; equal ``order_by`` values are what stays together. The
    assignment is written first (a job) and broadcast if it is small.
    """
    routes = small_side(assignment.select(F.col("key").alias(key), "task"))
    layout = ["task", key, *order_by]
    return rows.join(routes, key).repartitionByRange(*layout).sortWithinPartitions(*layout)


def placed_by_task(
    rows: DataFrame, key: str, assignment: DataFrame, partitions: int, spread_by: Sequence[str] = ()
) -> DataFrame:
    """Rows with their ``task``, in partitions that hold one task's rows each. Runs jobs.

    A task gets partitions in proportion to its load, at least one, and its rows go to them by the hash of
    ``spread_by`` (all columns by default). About ``partitions`` are used: none has a much larger load than its share,
    and there are fewer than ``partitions`` + tasks. Rows that agree in all of ``spread_by`` stay together; rows whose
    key has no task go.
    """
    assignment = checkpointed(assignment)
    everything, before = W.partitionBy(), W.orderBy("task").rowsBetween(W.unboundedPreceding, -1)
    # One row per task.
    loads = assignment.groupBy("task").agg(F.sum("n").alias("load"))
    share = F.ceil(F.try_divide(F.col("load") * partitions, F.sum("load").over(everything)))
    tasks = loads.withColumn("_slots", F.greatest(F.coalesce(share, F.lit(1)), F.lit(1)))
    tasks = checkpointed(tasks.withColumn("_first", F.coalesce(F.sum("_slots").over(before), F.lit(0))))
    used = tasks.agg(F.sum("_slots")).first()[0] or 1
    routes = small_side(
        assignment.join(tasks, "task").select(F.col("key").alias(key), "task", "_slots", "_first")
    )
    slot = F.col("_first") + F.pmod(F.xxhash64(*(spread_by or rows.columns)), F.col("_slots"))
    placed = rows.join(routes, key).withColumn("_at", slot.cast("int"))
    return placed.repartitionById(used, F.col("_at")).drop("_slots", "_first", "_at")


def grouped_region_apply(
    rows: DataFrame,
    fn: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]],
    schema: str,
    by: Sequence[str] = ("ref_index",),
    tile_width: int = 1 << 14,
    start: str = "pos",
    end: str = "end",
) -> DataFrame:
    """Run ``fn`` per region tile; it sees ``by, tile, tile_width`` and the tile's rows in batches.

    A region is cut into tiles of ``tile_width`` positions and a row joins every
    tile it touches, so no task holds a whole region, and batches stream through
    ``fn``, so no tile has to fit in memory. Reduce ``rows`` first where many
    share a position.
    """
    tiles = F.sequence(F.floor(F.col(start) / tile_width), F.floor(F.col(end) / tile_width))
    tiled = rows.withColumns({"tile": F.explode(tiles), "tile_width": F.lit(tile_width)})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from fn(batches)

    return tiled.groupBy(*by, "tile").applyInPandas(run, schema)


TILE_DEPTH_SCHEMA = "ref_index int, tile bigint, covered bigint, max_depth bigint"


def tile_depth(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Covered positions and greatest depth inside a tile, from ``pos, end, n`` rows."""
    steps: np.ndarray | None = None
    for batch in batches:
        if steps is None:
            ref_index, tile, width = (batch[c].iloc[0] for c in ("ref_index", "tile", "tile_width"))
            first = int(tile) * int(width)
            steps = np.zeros(int(width) + 1, dtype=np.int64)
        low = np.clip(batch["pos"].to_numpy() - first, 0, width)
        high = np.clip(batch["end"].to_numpy() + 1 - first, 0, width)
        weight = batch["n"].to_numpy()
        np.add.at(steps, low, weight)
        np.add.at(steps, high, -weight)
    if steps is not None:
        depth = np.cumsum(steps[:-1])
        yield pd.DataFrame(
            {
                "ref_index": [ref_index],
                "tile": [tile],
                "covered": [int((depth > 0).sum())],
                "max_depth": [int(depth.max())],
            }
        )


def region_depth(reads: DataFrame, tile_width: int = 1 << 14) -> DataFrame:
    """Covered positions and greatest depth per region.

    Reads with the same extent are counted before they reach a tile.
    """
    extents = reads.groupBy("ref_index", "pos", "end").agg(F.count("*").alias("n")).where("end >= pos")
    tiles = grouped_region_apply(extents, tile_depth, TILE_DEPTH_SCHEMA, tile_width=tile_width)
    return tiles.groupBy("ref_index").agg(F.sum("covered").alias("covered"), F.max("max_depth").alias("max_depth"))

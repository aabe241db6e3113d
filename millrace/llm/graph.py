"""Connected components of an edge table, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.cluster import checkpointed


def compact(df: DataFrame, rows: int, per_task: int = 100_000) -> DataFrame:
    """Written table of a result that has about ``rows`` rows: tasks by rows, where there are more partitions than that."""
    return checkpointed(df.coalesce(max(1, -(-rows // per_task))))


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``edges(a, b)``: the smallest node it reaches.

    Each round gives a node the smallest label among itself and its neighbours, then follows labels
    once more, so chains shrink geometrically. Rounds end when no label changes. The minimum is
    combined before each shuffle, so a node with very many edges is no hot key. Runs jobs.
    """
    size = 2 * edges.count()
    both = compact(edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).where("a <> b").distinct(), size)
    labels = compact(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("label")), size)
    while True:
        seen = (
            both.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("near"))
        )
        hooked = labels.join(seen.withColumnRenamed("a", "node"), "node").select(
            "node", F.col("label").alias("old"), F.least("label", "near").alias("new")
        )
        jump = labels.select(F.col("node").alias("new"), F.col("label").alias("beyond"))
        moved = compact(
            hooked.join(jump, "new", "left").select(
                "node", F.least("new", F.coalesce("beyond", "new")).alias("label"), "old"
            ),
            size,
        )
        labels = moved.select("node", "label")
        if not moved.where("label <> old").take(1):
            return labels.withColumnRenamed("label", "component")


def name_rows(rows: DataFrame, known: DataFrame, members: DataFrame, digest: list[str], size: int) -> DataFrame:
    """``rows`` columns doc_id and n_shingles with ``component_id``, the smallest ``doc_id`` of their component.

    ``known`` are the rows with an id and a set; ``members`` gives each set (by its ``digest`` columns) a component.
    Rows of one ``doc_id`` are one node, whatever their sets; rows without a set are alone.
    """
    named = known.select("doc_id", *digest).join(members, digest)
    split = named.groupBy("doc_id").agg(F.min("component").alias("a"), F.max("component").alias("b")).where("a <> b")
    by_id = compact(named.groupBy("doc_id").agg(F.min("component").alias("component_id")), size)
    if split.take(1):
        joined = components(named.select(F.col("doc_id").alias("a"), F.col("component").alias("b")))
        by_id = joined.select(F.col("node").alias("doc_id"), F.col("component").alias("component_id"))
    return (
        rows.select("doc_id", "n_shingles")
        .join(by_id, "doc_id", "left")
        .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
    )

"""Dense numbers in a global order without sorting in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.cluster import checkpointed, small_side


def with_ordinal(
    df: DataFrame,
    order_by: Sequence[str | Column],
    name: str = "ordinal",
    within: Sequence[str] = (),
) -> DataFrame:
    """Number rows from 0 by ``order_by``; restart per ``within`` group.

    ``order_by`` must begin with the ``within`` columns and should break all
    ties. Rows are range-partitioned and sorted, so a group of any size spreads
    over many tasks; the sorted result is written once to fix partition
    boundaries, then each partition's numbers start after the sizes before it.
    """
    order = list(order_by)
    placed = checkpointed(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_slot", F.spark_partition_id())
        .withColumn("_seq", F.monotonically_increasing_id())
    )
    sizes = placed.groupBy("_slot").agg(F.count("*").alias("_n"), F.min("_seq").alias("_first"))
    earlier = W.orderBy("_slot").rowsBetween(W.unboundedPreceding, -1)  # one row per partition
    offsets = sizes.select("_slot", "_first", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    numbered = placed.join(small_side(offsets), "_slot").withColumn(
        name, F.col("_before") + F.col("_seq") - F.col("_first")
    )
    if within:
        firsts = numbered.groupBy(*within).agg(F.min(name).alias("_group_first"))
        numbered = numbered.join(small_side(firsts), list(within)).withColumn(name, F.col(name) - F.col("_group_first"))
    return numbered.select(*df.columns, name)

"""Text files with dense line numbers, without moving the text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.cluster import small_side

# More splits than this and the offsets are joined by shuffle instead; each has some tens of bytes.
MAX_BROADCAST_SPLITS = 1_000_000


def placed_lines(spark: SparkSession, path: str, line_sep: str | None = None) -> DataFrame:
    """``value, file, block, seq``: lines with the split they lie in; ``seq`` rises without gaps inside a split."""
    reader = spark.read if line_sep is None else spark.read.option("lineSep", line_sep)
    return reader.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"),
    )


def split_offsets(splits: DataFrame, per_file: bool = True) -> DataFrame:
    """``file, block, n, first_seq`` of each split, with the number of lines ``before`` it."""
    scope = W.partitionBy("file").orderBy("block") if per_file else W.orderBy("file", "block")
    # One row per input split, never one per line.
    return splits.withColumn(
        "before", F.coalesce(F.sum("n").over(scope.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    )


def line_number(seq: Column) -> Column:
    """Number of a line joined with the offset of its split."""
    within = seq - F.col("first_seq")
    matched = F.col("n").isNotNull() & within.between(0, F.col("n") - 1)
    return F.when(matched, F.col("before") + within).otherwise(
        F.raise_error(F.lit("input splits changed while numbering lines")).cast("bigint")
    )


def numbered_lines(
    spark: SparkSession, path: str, per_file: bool = True, line_sep: str | None = None
) -> DataFrame:
    """``file, line_no (from 0), value``; numbers restart per file or run on in path order.

    Every split reports how many lines it holds; a running sum over the splits
    gives each one its first number, and within a split lines are counted by
    ``monotonically_increasing_id``. Both passes must cut the files alike, so a
    row whose split is unknown or too long stops the job instead of being lost.
    """
    placed = placed_lines(spark, path, line_sep)
    splits = placed.groupBy("file", "block").agg(F.count("*").alias("n"), F.min("seq").alias("first_seq"))
    offsets = small_side(split_offsets(splits, per_file), MAX_BROADCAST_SPLITS)
    return placed.join(offsets, ["file", "block"], "left").select("file", line_number(F.col("seq")).alias("line_no"), "value")

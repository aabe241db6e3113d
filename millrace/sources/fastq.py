"""Sequencer reads: four lines each."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.sources.lines import numbered_lines


def scan_fastq(spark: SparkSession, path: str) -> DataFrame:
    """``record (from 0, files in path order), name, seq, qual``."""
    lines = numbered_lines(spark, path, per_file=False).select(
        F.floor(F.col("line_no") / 4).alias("record"), (F.col("line_no") % 4).alias("part"), "value"
    )
    piece = lambda i: F.max(F.when(F.col("part") == i, F.col("value")))
    return lines.groupBy("record").agg(
        F.substring(piece(0), 2, 2_000_000_000).alias("name"), piece(1).alias("seq"), piece(3).alias("qual")
    )

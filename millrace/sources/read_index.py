"""Looking up a region in coordinate-sorted reads, by an index of windows, files and row ranges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.cigar import alignment_end

# Positions of an index window: 16 kb.
WINDOW_BITS = 14


def _last(pos: Column, cigar: Column) -> Column:
    """Last position of a read; reads that cover no base lie at their position."""
    return F.greatest(alignment_end(pos, cigar), pos)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """``ref_index, window, file, first_row, last_row, reads``: where the reads that touch a window are stored.

    Reads without a reference or position are in no window. Files sorted by coordinate give short row ranges.
    """
    placed = spark.read.parquet(path).select(
        "ref_index",
        F.col("pos"),
        _last(F.col("pos"), F.col("cigar")).alias("last"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.row_index").alias("row"),
    )
    window = lambda c: F.call_function("shiftright", F.col(c), F.lit(WINDOW_BITS))
    touched = placed.where("ref_index IS NOT NULL AND pos IS NOT NULL").withColumn(
        "window", F.explode(F.sequence(window("pos"), window("last")))
    )
    return touched.groupBy("ref_index", "window", "file").agg(
        F.min("row").alias("first_row"), F.max("row").alias("last_row"), F.count("*").alias("reads")
    )


def write_read_index(spark: SparkSession, path: str, index_path: str) -> None:
    """Index the Parquet reads at ``path``, laid out by window."""
    index = read_index(spark, path)
    index.repartitionByRange("ref_index", "window", "file").write.mode("overwrite").parquet(index_path)


def reads_in_region(spark: SparkSession, path: str, index_path: str, ref_index: int, start: int, end: int) -> DataFrame:
    """Reads that touch ``start`` to ``end`` (closed) of a reference; only files the index names are opened. Runs a job.

    The names of the region's files come to the driver, as the paths of any scan do.
    """
    index = spark.read.parquet(index_path).where(F.col("ref_index") == ref_index)
    near = index.where(F.col("window").between(start >> WINDOW_BITS, end >> WINDOW_BITS))
    ranges = near.groupBy("file").agg(F.min("first_row").alias("_first"), F.max("last_row").alias("_end"))
    files = [r.file for r in ranges.select("file").collect()]
    schema = spark.read.parquet(path).schema
    if not files:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).parquet(*files)
    placed = rows.select("*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("_row"))
    # One row per opened file.
    found = placed.join(F.broadcast(ranges), "file").where(F.col("_row").between(F.col("_first"), F.col("_end")))
    touches = (F.col("ref_index") == ref_index) & (F.col("pos") <= end) & (_last(F.col("pos"), F.col("cigar")) >= start)
    return found.where(touches).select(*schema.names)

"""Unbounded status stream read from a folder of Parquet or JSON files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def stream_source(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    file_format: str = "parquet",
    max_files_per_batch: int | None = None,
) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if max_files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    return reader.format(file_format).load(path)

"""Page-view counts: ``project title views size`` separated by single blanks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def parse_pageviews(lines: DataFrame) -> DataFrame:
    """Positional parse of ``value``; a missing or non-numeric count is an error.

    Plain split, not the CSV reader: titles may hold quotes.
    """
    part = F.split("value", " ")
    return lines.select(
        part[0].alias("project"),
        part[1].alias("title"),
        part[2].cast("bigint").alias("views"),
        F.try_element_at(part, F.lit(4)).try_cast("bigint").alias("size"),
    )


def scan_pageviews(spark: SparkSession, path: str) -> DataFrame:
    return parse_pageviews(spark.read.text(path))

"""The trend log: nine comma-separated fields, text last."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The log's header fields.
LOG_HEADER = "Seconds,Language,Language-code,TotalLangCount,ID,MaxCount,MinCount,Count,Text"


def parse_retweet_log(lines: DataFrame) -> DataFrame:
    """Drop headers and rows with fewer than nine fields; ``text`` is field nine only.

    Trailing empty fields do not count, so a row with an empty text is dropped,
    and text after its first comma is not kept.
    """
    part = F.split(F.regexp_replace("value", ",+$", ""), ",")
    complete = (part[0] != "Seconds") & (F.size(part) >= 9)
    rows = lines.where(complete).select(F.when(complete, part).alias("part"))
    at = lambda i: F.col("part")[i]
    return rows.select(
        at(0).alias("seconds"),
        at(1).alias("language"),
        at(2).alias("language_code"),
        at(3).cast("bigint").alias("total_lang_count"),
        at(4).cast("bigint").alias("id"),
        at(5).cast("bigint").alias("max_count"),
        at(6).cast("bigint").alias("min_count"),
        at(7).cast("bigint").alias("count"),
        at(8).alias("text"),
    )


def scan_retweet_log(spark: SparkSession, path: str) -> DataFrame:
    return parse_retweet_log(spark.read.text(path))

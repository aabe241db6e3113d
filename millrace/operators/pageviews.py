"""Views per language and each language's most viewed page."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.cluster import small_side
from millrace.functions.languages import with_language_name


def language_pageviews(views: DataFrame) -> DataFrame:
    """``project, title, views`` → one row per language.

    The language is the project up to its first dot; rows whose title is just
    the language are skipped. Totals and the highest views are fixed-width sums,
    hash-aggregated before the one shuffle, so a dominant language costs one row per task; the
    titles that reach the maximum are then picked by a join with one row per language. Ties for
    the top page go to the smaller title. Runs a job and reads ``views`` twice.
    """
    cleaned = views.select(
        F.substring_index("project", ".", 1).alias("language_code"), "title", "views"
    ).where(F.col("language_code") != F.col("title"))
    per_language = small_side(
        cleaned.groupBy("language_code").agg(F.sum("views").alias("total_views"), F.max("views").alias("top_views"))
    )
    reaching = cleaned.join(per_language.withColumnRenamed("top_views", "views"), ["language_code", "views"])
    titles = reaching.groupBy("language_code").agg(F.min("title").alias("top_title"))
    joined = per_language.join(titles, "language_code", "left")
    return with_language_name(joined, "language_code").select(
        "language", "language_code", "total_views", "top_title", "top_views"
    )


def ranked_pageviews(views: DataFrame) -> DataFrame:
    return language_pageviews(views).orderBy(F.desc("total_views"), "language_code")


def report_line() -> Column:
    """Comma-and-blank separated text form with the title quoted."""
    title = F.concat(F.lit('"'), "top_title", F.lit('"'))
    return F.concat_ws(", ", "language", "language_code", "total_views", title, "top_views")

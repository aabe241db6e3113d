"""Trending posts per language: sliding windows, totals, ranks, log analysis.

Statuses are ``ts, is_retweet, id, retweet_count, lang, text``. Where a post
shows several languages or texts, the earliest sighting wins, then the smaller
language and text.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.cluster import checkpointed, small_side
from millrace.functions.counts import count_growth
from millrace.functions.languages import with_language_name
from millrace.functions.text import one_line
from millrace.operators.ordering import with_ordinal


def retweet_filter(statuses: DataFrame) -> DataFrame:
    """Retweets only, as a first sighting whose highest and lowest count coincide."""
    return statuses.where("is_retweet").select(
        "ts",
        "id",
        F.col("retweet_count").alias("max_count"),
        F.col("retweet_count").alias("min_count"),
        F.struct(F.col("ts").alias("seen_at"), "lang", "text").alias("first_seen"),
    )


def _merge() -> list[Column]:
    return [
        F.max("max_count").alias("max_count"),
        F.min("min_count").alias("min_count"),
        F.min("first_seen").alias("first_seen"),
    ]


def interval_micros(spark: SparkSession, *intervals: str) -> list[int]:
    zero = "timestamp '1970-01-01 00:00:00 UTC'"
    micros = [F.expr(f"unix_micros({zero} + interval {d}) - unix_micros({zero})").alias(f"i{n}") for n, d in enumerate(intervals)]
    return list(spark.range(1).select(*micros).first())


def pane_width(spark: SparkSession, window: str, slide: str) -> str:
    """The longest interval that both the window and the slide are whole multiples of."""
    return f"{math.gcd(*interval_micros(spark, window, slide))} microseconds"


def pane_counts(sightings: DataFrame, window: str, slide: str) -> DataFrame:
    """Combine sightings of a post inside one pane.

    Windows then expand each post-and-pane row instead of every status. A pane lies
    wholly inside or outside any window, since both its width and the slide's are multiples of the pane's.
    ``ts`` becomes the start of the pane; ``newest`` is the time of the last sighting.
    """
    width = pane_width(sightings.sparkSession, window, slide)
    return (
        sightings.groupBy(F.window("ts", width).alias("pane"), "id")
        .agg(*_merge(), F.max("ts").alias("newest"))
        .select(F.col("pane.start").alias("ts"), "id", "max_count", "min_count", "first_seen", "newest")
    )


def build_windows(sightings: DataFrame, window: str, slide: str) -> DataFrame:
    """Per window and post: highest and lowest count, language, text. Batch and stream."""
    return (
        sightings.groupBy(F.window("ts", window, slide).alias("window"), "id")
        .agg(*_merge())
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "id",
            "max_count",
            "min_count",
            F.col("first_seen.lang").alias("language_code"),
            F.col("first_seen.text").alias("text"),
        )
    )


def add_growth(windowed: DataFrame, mode: str = "floor_one") -> DataFrame:
    growth = count_growth(F.col("max_count"), F.col("min_count"), mode)
    return windowed.withColumn("count", growth)


def language_totals(counted: DataFrame) -> DataFrame:
    """Growth per window and language."""
    return counted.groupBy("window_end", "language_code").agg(F.sum("count").alias("total_lang_count"))


def with_language_totals(counted: DataFrame, totals: DataFrame | None = None) -> DataFrame:
    """Language total back on every row.

    The totals are few unless there are many windows; few ones are broadcast, so
    no language of a window is gathered in one task, and many spread by window.
    ``counted`` is read twice, so pass a table.
    """
    if totals is None:
        totals = small_side(language_totals(counted))
    joined = counted.join(totals, ["window_end", "language_code"])
    return with_language_name(joined, "language_code").select(
        "window_start",
        "window_end",
        "language",
        "language_code",
        "total_lang_count",
        "id",
        "max_count",
        "min_count",
        "count",
        "text",
    )


def window_table(statuses: DataFrame, window: str, slide: str, mode: str) -> DataFrame:
    """Every window of a bounded set of statuses, written once: statuses are scanned once."""
    panes = pane_counts(retweet_filter(statuses), window, slide)
    return checkpointed(add_growth(build_windows(panes, window, slide), mode))


def retweet_windows(
    statuses: DataFrame, window: str = "60 seconds", slide: str = "5 seconds", mode: str = "floor_one"
) -> DataFrame:
    """Batch form of the trend job: every window, including those still open at the end."""
    return with_language_totals(window_table(statuses, window, slide, mode))


def window_order() -> list[Column]:
    """Inside a window: language total, then plain max−min, both descending; then language and id."""
    return [
        F.desc("total_lang_count"),
        F.desc(F.col("max_count") - F.col("min_count")),
        F.asc("language_code"),
        F.asc("id"),
    ]


def ranked_language_totals(statuses: DataFrame, window: str, slide: str, mode: str = "floor_one") -> DataFrame:
    """Languages of each window ranked from 0 by total.

    One window holds as many rows as there are languages, so ``row_number`` is safe.
    """
    panes = pane_counts(retweet_filter(statuses), window, slide)
    totals = language_totals(add_growth(build_windows(panes, window, slide), mode))
    order = W.partitionBy("window_end").orderBy(F.desc("total_lang_count"), "language_code")
    return with_language_name(totals, "language_code").select(
        "window_end",
        (F.row_number().over(order) - 1).alias("rank"),
        "language",
        "language_code",
        "total_lang_count",
    )


def ranked_posts(windows: DataFrame) -> DataFrame:
    """Posts of each window ranked from 0; a window of any size is sorted across tasks."""
    return with_ordinal(windows, [F.asc("window_end"), *window_order()], name="rank", within=["window_end"])


def skip_warmup(windows: DataFrame, first_end: Column, window: str) -> DataFrame:
    """Keep windows that end at least one window length after the first slide boundary.

    ``seconds`` is the time passed since that boundary.
    """
    length = F.expr(f"interval {window}")
    return windows.where(F.col("window_end") >= first_end + length).withColumn(
        "seconds", F.timestamp_diff("SECOND", first_end, F.col("window_end"))
    )


def log_after_warmup(statuses: DataFrame, window: str, slide: str, mode: str = "floor_one") -> DataFrame:
    """Batch form of the trend log; the smallest window end is the first slide boundary."""
    counted = window_table(statuses, window, slide, mode)
    first_end = counted.agg(F.min("window_end")).scalar()
    return skip_warmup(with_language_totals(counted), first_end, window)


def log_lines(logged: DataFrame) -> DataFrame:
    """One comma-separated line per row; the seconds stand in brackets, the text on one line."""
    return logged.select(
        "window_end",
        F.concat_ws(
            ",",
            F.concat(F.lit("("), F.col("seconds").cast("string"), F.lit(")")),
            "language",
            "language_code",
            "total_lang_count",
            "id",
            "max_count",
            "min_count",
            "count",
            one_line(F.col("text")),
        ).alias("value"),
    )


def log_totals(log: DataFrame, mode: str = "diff", more_than: int = 1) -> DataFrame:
    """Offline analysis of the trend log.

    Per post: growth over the whole log. Per language: the sum of it. Posts that
    grew by ``more_than`` or less are left out afterwards and still count in the
    language total.
    """
    when = F.regexp_extract("seconds", r"(-?\d+)", 1).try_cast("bigint")
    first = F.min(F.struct(when.alias("seen_at"), "language_code", "text")).alias("first_seen")
    posts = checkpointed(
        log.groupBy("id")
        .agg(F.max("max_count").alias("max_count"), F.min("min_count").alias("min_count"), first)
        .select(
            "id",
            F.col("first_seen.language_code").alias("language_code"),
            F.col("first_seen.text").alias("text"),
            count_growth(F.col("max_count"), F.col("min_count"), mode).alias("count"),
        )
    )
    totals = posts.groupBy("language_code").agg(F.sum("count").alias("total_lang_count"))
    kept = posts.join(small_side(totals), "language_code").where(F.col("count") > more_than)
    return (
        with_language_name(kept, "language_code")
        .select("language", "language_code", "total_lang_count", "id", "count", "text")
        .orderBy(F.desc("total_lang_count"), F.desc("count"), "language_code", "id")
    )

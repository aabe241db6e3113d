"""Filmography lists: one blank-line separated block per person."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.cluster import checkpointed, evaluated, small_side
from millrace.sources.lines import MAX_BROADCAST_SPLITS, line_number, placed_lines, split_offsets

# The column-title line (blanks removed) and the footer rule.
TITLE_LINE = "NameTitles"
FOOTER_RULE = "---"
# Lines whose marks share a row of notes.
NOTED_LINES = 4096


def scan_blocks(spark: SparkSession, path: str) -> DataFrame:
    """One row per block; line breaks inside stay, empty blocks go."""
    blocks = spark.read.option("lineSep", "\n\n").text(path)
    return blocks.where(F.trim(F.translate("value", "\n\t", "  ")) != "")


def section_extract(spark: SparkSession, path: str) -> DataFrame:
    """Lines between the title line (and the rule below it) and the footer, per file. Runs jobs.

    The text is scanned twice. The first pass counts lines and notes title lines and rules, ``NOTED_LINES`` lines
    to a row, so its notes have a bounded size whatever the text holds; split offsets, titles and footers
    all come from these notes. The second pass keeps the range.
    """
    lines = placed_lines(spark, path)
    is_title = F.regexp_replace("value", r"\s", "") == TITLE_LINE
    is_rule = F.col("value").startswith(FOOTER_RULE)
    noted = checkpointed(
        lines.groupBy("file", "block", F.floor(F.col("seq") / NOTED_LINES).alias("part")).agg(
            F.count("*").alias("n"),
            F.min("seq").alias("first_seq"),
            F.collect_list(F.when(is_title, F.col("seq"))).alias("titles"),
            F.collect_list(F.when(is_rule, F.col("seq"))).alias("rules"),
        )
    )
    splits = noted.groupBy("file", "block").agg(F.sum("n").alias("n"), F.min("first_seq").alias("first_seq"))
    offsets = small_side(split_offsets(splits), MAX_BROADCAST_SPLITS)

    def numbers(kind: str) -> DataFrame:
        seqs = noted.select("file", "block", F.explode(kind).alias("seq"))
        return seqs.join(offsets, ["file", "block"], "left").select("file", line_number(F.col("seq")).alias("line_no"))

    titles = small_side(numbers("titles").groupBy("file").agg(F.min("line_no").alias("title_no")))
    footers = (
        numbers("rules")
        .join(titles, "file")
        .where(F.col("line_no") > F.col("title_no") + 1)
        .groupBy("file")
        .agg(F.min("line_no").alias("footer_no"))
    )
    bounds = small_side(titles.join(footers, "file", "left"))
    inside = (F.col("line_no") > F.col("title_no") + 1) & (
        F.col("footer_no").isNull() | (F.col("line_no") < F.col("footer_no"))
    )
    numbered = lines.join(offsets, ["file", "block"], "left").select("file", line_number(F.col("seq")).alias("line_no"), "value")
    return numbered.join(bounds, "file").where(inside).select("file", "line_no", "value")


def _before_bracket(title: Column) -> Column:
    return F.substring_index(title, ")", 1)


def _since(title: Column, min_year: int) -> Column:
    """Whether the four characters after the first ``(`` (or the first four) before the ``)`` are such a year."""
    before = _before_bracket(title)
    head = F.substring(before, F.instr(before, "(") + 1, F.lit(4))
    year = head.try_cast("int")
    # Four characters that make 1000 or more are digits; others may hold blanks or a point.
    plain = (year >= 1000) | head.rlike(r"^[+-]?[0-9]+$")
    return (year >= min_year) & (F.instr(title, ")") > 0) & plain


def parse_filmography(blocks: DataFrame, gender: str, min_year: int = 2011) -> DataFrame:
    """Block → ``actor, gender, movies``; series, undated and older titles go.

    People left without a title are dropped.
    """
    # Every step is computed once, as the filters below it would else repeat it.
    fields = F.array_remove(F.split(F.replace("value", F.lit("\n"), F.lit("")), "\t"), "")
    people = evaluated(blocks, fields.alias("fields")).where(F.size("fields") > 0)
    titles = F.slice("fields", F.lit(2), F.greatest(F.size("fields") - 1, F.lit(0)))
    kept = F.filter(titles, lambda t: ~t.startswith('"') & _since(t, min_year))
    movies = F.transform(kept, lambda t: F.concat(_before_bracket(t), F.lit(")")))
    parsed = evaluated(people, F.col("fields")[0].alias("actor"), F.lit(gender).alias("gender"), movies.alias("movies"))
    return parsed.where(F.size("movies") > 0)

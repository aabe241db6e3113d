"""Writers. None of them gathers rows in one task; files sort by name in row order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.cluster import checkpointed
from millrace.operators.intervals import bed_lines, region_strings
from millrace.operators.pageviews import language_pageviews, report_line
from millrace.operators.reads import coordinate_sort
from millrace.operators.variants import FIRST_CHROM, LAST_CHROM, ordered_variants

# Header of the page-view report.
PAGEVIEW_HEADER = "Language, Language-code, TotalViews, MostVisitedPage, MostVisitedPage_Views"


def write_pageview_report(views: DataFrame, path: str) -> None:
    """Header and one line per language, most viewed first.

    The header rides along as the first row of the global order.
    """
    ranked = language_pageviews(views)
    header = views.sparkSession.range(1).select(F.lit(0).alias("part"), F.lit(PAGEVIEW_HEADER).alias("value"))
    body = ranked.select(F.lit(1).alias("part"), report_line().alias("value"), "total_views", "language_code")
    lines = body.unionByName(header, allowMissingColumns=True)
    order = ["part", F.desc("total_views"), "language_code"]
    lines.orderBy(*order).select("value").write.mode("overwrite").text(path)


def in_coordinate_order(intervals: DataFrame) -> DataFrame:
    """By sequence, start and end, over range partitions; written first, as a range layout reads its input twice."""
    order = ["chrom", "start", "end"]
    return checkpointed(intervals).repartitionByRange(*order).sortWithinPartitions(*order)


def write_bed(intervals: DataFrame, path: str, end_offset: int = 0) -> None:
    """Lines in coordinate order, over the part files in name order."""
    bed_lines(in_coordinate_order(intervals), end_offset).write.mode("overwrite").text(path)


def write_regions(intervals: DataFrame, path: str) -> None:
    """Lines in coordinate order, over the part files in name order."""
    region_strings(in_coordinate_order(intervals)).write.mode("overwrite").text(path)


def write_reads(reads: DataFrame, path: str) -> None:
    """Coordinate-sorted Parquet; row-group statistics on position serve as the index."""
    coordinate_sort(reads).write.mode("overwrite").parquet(path)


def write_variants(variants: DataFrame, path: str) -> None:
    """All chromosomes in one pass; part files in name order hold the global order."""
    ordered_variants(variants).select("line").write.mode("overwrite").text(path)


def write_variants_by_region(variants: DataFrame, path: str) -> None:
    """One folder per region, lines in position order inside each file.

    Ranges, not hashes of the region: a region of any size spreads over tasks.
    """
    kept = variants.where(F.col("chrom").between(FIRST_CHROM, LAST_CHROM))
    laid_out = kept.repartitionByRange("chrom", "pos", "line").sortWithinPartitions("chrom", "pos", "line")
    laid_out.select(F.col("chrom").alias("region"), "line").write.mode("overwrite").partitionBy("region").text(path)


def write_chunks(interleaved: DataFrame, path: str) -> None:
    """FASTQ text, one folder per chunk; a chunk's files in name order keep mates together."""
    order = ["chunk", "pair", "mate"]
    laid_out = interleaved.repartitionByRange("chunk", "pair").sortWithinPartitions(*order)
    record = F.concat_ws("\n", F.concat(F.lit("@"), "name"), "seq", F.lit("+"), "qual")
    laid_out.select("chunk", record.alias("value")).write.mode("overwrite").partitionBy("chunk").text(path)


def write_separation_report(report: DataFrame, path: str) -> None:
    report.orderBy("section", "line_no").select("line").write.mode("overwrite").text(path)

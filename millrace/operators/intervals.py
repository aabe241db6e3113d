"""Merging and intersecting closed intervals ``chrom, start, end``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.cluster import checkpointed, wide_shuffles

# Fixed value: reads this close to the covered stretch still extend it.
READ_GAP = 51


def merge_intervals(
    intervals: DataFrame,
    gap: int,
    by: Sequence[str] = ("chrom",),
    bin_width: int = 1 << 16,
    label: str | None = None,
) -> DataFrame:
    """Join intervals while ``start <= running end + gap``; output ``by, start, end, members``.

    ``label`` names a column of which the merged interval keeps its first one's value.

    A chromosome is never sorted as one group. Intervals with equal start are
    combined first, so a bin holds at most ``bin_width`` rows however deep the
    pile. Each bin is merged by itself; what is left is written once. A table with
    one row per bin then tells how far earlier bins reach: only islands starting
    within that reach join the island open before the bin. Both steps run jobs, over as many tasks as the
    input asks for; their results are written.
    """
    by = list(by)
    in_bin = [*by, "_bin"]
    ordered = W.partitionBy(*in_bin).orderBy("start")
    before = ordered.rowsBetween(W.unboundedPreceding, -1)
    so_far = ordered.rowsBetween(W.unboundedPreceding, 0)
    earlier_bins = W.partitionBy(*by).orderBy("_bin").rowsBetween(W.unboundedPreceding, -1)

    def totals(members: Column) -> list[Column]:
        first_label = [F.min_by("label", "start").alias("label")] if label else []
        return [F.max("end").alias("end"), members.alias("members"), *first_label]

    def opens(reach: str) -> Column:
        return F.col(reach).isNull() | (F.col("start") > F.col(reach) + gap)

    same_start = [F.min(label).alias("label")] if label else []
    starts = (
        intervals.groupBy(*by, "start")
        .agg(F.max("end").alias("end"), F.count("*").alias("members"), *same_start)
        .withColumn("_bin", F.floor(F.col("start") / bin_width))
    )
    islands = (
        starts.withColumn("_reach", F.max("end").over(before))
        .withColumn("_island", F.max(F.when(opens("_reach"), F.col("start"))).over(so_far))
        .groupBy(*in_bin, "_island")
        .agg(*totals(F.sum("members")))
        .withColumnRenamed("_island", "start")
    )
    with wide_shuffles(intervals):
        local = checkpointed(islands)
    bins = (
        local.groupBy(*in_bin)
        .agg(F.max("end").alias("_far"), F.max("start").alias("start"))
        .withColumn("_carried_end", F.max("_far").over(earlier_bins))
        .withColumn("_last_opened", F.when(opens("_carried_end"), F.col("start")))
        .withColumn("_open_island", F.max("_last_opened").over(earlier_bins))
        .select(*in_bin, "_carried_end", "_open_island")
    )
    island = F.when(opens("_carried_end"), F.col("start")).otherwise(F.col("_open_island"))
    whole = local.join(bins, in_bin).groupBy(*by, island.alias("_first")).agg(*totals(F.sum("members")))
    with wide_shuffles(intervals):
        merged = checkpointed(whole)
    kept_label = ["label"] if label else []
    return merged.select(*by, F.col("_first").alias("start"), "end", "members", *kept_label)


def covered_intervals(
    reads: DataFrame, gap: int = READ_GAP, by: Sequence[str] = ("ref_index", "chrom"), bin_width: int = 1 << 16
) -> DataFrame:
    """Stretches covered by reads (``start``, ``end`` per read); the last one is kept too."""
    return merge_intervals(reads, gap, by, bin_width)


def padded_intervals(intervals: DataFrame, overlap: int, bin_width: int = 1 << 16) -> DataFrame:
    """Widen starts by ``overlap`` (not below 1) and merge where ``start - overlap < running end``.

    Chromosome names are compared without case; the name of the first interval is
    shown, the smallest one where several start there.
    """
    folded = intervals.withColumn("_chrom", F.lower("chrom"))
    merged = merge_intervals(folded, overlap - 1, ["_chrom"], bin_width, label="chrom")
    return merged.select(
        F.col("label").alias("chrom"), F.greatest(F.col("start") - overlap, F.lit(1)).alias("start"), "end"
    )


def _length_level(length: Column, base_bits: int, step_bits: int, levels: int) -> Column:
    level = F.lit(levels - 1)
    for i in reversed(range(levels - 1)):
        level = F.when(length <= (1 << (base_bits + i * step_bits)), i).otherwise(level)
    return level


def interval_intersect(
    targets: DataFrame,
    covered: DataFrame,
    base_bits: int = 14,
    step_bits: int = 3,
    levels: int = 7,
) -> DataFrame:
    """Overlap of each target row with each covered interval (half-open, covered ones disjoint).

    Equi-join on position bins. A target takes the bin size that fits its own
    length, so it lies in at most two bins, however long it is. Covered intervals
    enter the bins of every size; being disjoint, they can fill each bin only
    once over, which bounds their copies. A pair is kept in the bin where the
    later of the two starts lies, so it comes out once. Other target columns stay.
    """
    def bins(start: Column, end: Column, bits: Column) -> Column:
        return F.sequence(F.call_function("shiftright", start, bits), F.call_function("shiftright", end - 1, bits))

    def spread(df: DataFrame, level: Column, start: str, end: str) -> DataFrame:
        sized = df.withColumn("_level", level)
        bits = F.lit(base_bits) + F.col("_level") * step_bits
        return sized.withColumn("_bin", F.explode(bins(F.col(start), F.col(end), bits)))

    kept = targets.columns
    left = spread(
        targets.where("end > start").withColumns({c: F.col(c).cast("bigint") for c in ("start", "end")}),
        _length_level(F.col("end") - F.col("start"), base_bits, step_bits, levels),
        "start",
        "end",
    )
    right = spread(
        covered.where("end > start").select(
            "chrom", F.col("start").cast("bigint").alias("_start"), F.col("end").cast("bigint").alias("_end")
        ),
        F.explode(F.sequence(F.lit(0), F.lit(levels - 1))),
        "_start",
        "_end",
    )
    later, sooner = F.greatest("start", "_start"), F.least("end", "_end")
    home = F.call_function("shiftright", later, F.lit(base_bits) + F.col("_level") * step_bits)
    types = dict(targets.dtypes)
    return (
        left.join(right, ["chrom", "_level", "_bin"])
        .where((later < sooner) & (home == F.col("_bin")))
        .withColumns({"start": later.cast(types["start"]), "end": sooner.cast(types["end"])})
        .select(*kept)
    )


def to_half_open(intervals: DataFrame, end_offset: int = 0) -> DataFrame:
    """1-based closed → 0-based half-open; ``end_offset=-1`` drops the last base."""
    return intervals.withColumns({"start": F.col("start") - 1, "end": F.col("end") + end_offset})


def bed_lines(intervals: DataFrame, end_offset: int = 0) -> DataFrame:
    return to_half_open(intervals, end_offset).select(F.concat_ws("\t", "chrom", "start", "end").alias("value"))


def region_strings(intervals: DataFrame) -> DataFrame:
    return intervals.select(F.format_string("%s:%d-%d", "chrom", "start", "end").alias("region"))

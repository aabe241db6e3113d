"""Variant lines: global order and comparison of two call sets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FIRST_CHROM, LAST_CHROM = 1, 24
VARIANT_KEY = ("chrom", "pos", "ref", "alt")


def ordered_variants(variants: DataFrame) -> DataFrame:
    """Variants of chromosomes 1..24 in (chrom, pos) order: one range-partitioned sort."""
    return variants.where(F.col("chrom").between(FIRST_CHROM, LAST_CHROM)).orderBy("chrom", "pos", "line")


def compare_variants(reference: DataFrame, test: DataFrame, key: tuple[str, ...] = VARIANT_KEY) -> DataFrame:
    """One row ``total, matches, diff`` over distinct keys of ``reference``.

    Both sets go through one aggregation that notes on which side a key was
    seen; there is no join, and repeated keys collapse on the map side.
    """
    sides = reference.select(*key, F.lit(1).alias("side")).unionByName(test.select(*key, F.lit(2).alias("side")))
    seen = sides.groupBy(*key).agg(F.bit_or("side").alias("sides"))
    return seen.agg(
        F.count_if(F.col("sides").isin(1, 3)).alias("total"),
        F.count_if(F.col("sides") == 3).alias("matches"),
        F.count_if(F.col("sides") == 1).alias("diff"),
    )

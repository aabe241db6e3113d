"""Interleaving the two files of paired reads into equal chunks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.cluster import checkpointed


def interleave_chunks(first: DataFrame, second: DataFrame, chunks: int) -> DataFrame:
    """Mates with the same ``record`` number follow each other; pairs go to ``chunks`` chunks in order.

    Output ``chunk, pair, mate (1, 2), name, seq, qual``. Records without a
    partner are left out; ``unpaired_records`` counts them.
    """
    def mate(reads: DataFrame, side: str) -> DataFrame:
        return reads.select("record", F.struct("name", "seq", "qual").alias(side))

    pairs = checkpointed(mate(first, "one").join(mate(second, "two"), "record"))
    total = pairs.count()  # answered from file footers
    both = F.array(
        F.struct(F.lit(1).alias("mate"), F.col("one").alias("read")),
        F.struct(F.lit(2).alias("mate"), F.col("two").alias("read")),
    )
    return pairs.select(
        F.call_function("div", F.col("record") * chunks, F.lit(total)).cast("int").alias("chunk"),
        F.col("record").alias("pair"),
        F.explode(both).alias("m"),
    ).select("chunk", "pair", "m.mate", "m.read.name", "m.read.seq", "m.read.qual")


def unpaired_records(first: DataFrame, second: DataFrame) -> DataFrame:
    """How many records of either side have no partner."""
    sides = first.select("record", F.lit(1).alias("side")).unionByName(second.select("record", F.lit(2).alias("side")))
    seen = sides.groupBy("record").agg(F.bit_or("side").alias("sides"))
    return seen.agg(
        F.count_if(F.col("sides") == 1).alias("only_first"), F.count_if(F.col("sides") == 2).alias("only_second")
    )

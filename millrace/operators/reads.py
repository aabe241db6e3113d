"""Operators over aligned reads."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.cluster import checkpointed, evaluated, small_side
from millrace.functions.cigar import alignment_end, soft_clip_to, unclipped_five_prime
from millrace.functions.library import library_size
from millrace.functions.qualities import decode_qualities, guess_encoding, quality_score, to_phred

# Flag bits of the SAM specification.
UNMAPPED, REVERSE = 0x4, 0x10
LAST_REGION = 24

# The read-group tags given to every read.
READ_GROUP = {"rg_id": "GROUP1", "library": "LIB1", "platform": "ILLUMINA", "unit": "UNIT1", "sample": "SAMPLE1"}


def has_flag(bit: int) -> Column:
    return F.col("flag").bitwiseAND(bit) != 0


def mapped_reads(reads: DataFrame) -> DataFrame:
    """Mapped reads on chr1..chr22, chrX, chrY."""
    return reads.where(~has_flag(UNMAPPED) & F.col("ref_index").between(1, LAST_REGION))


def with_alignment_end(reads: DataFrame) -> DataFrame:
    return reads.withColumn("end", alignment_end(F.col("pos"), F.col("cigar")))


def region_counts(reads: DataFrame) -> DataFrame:
    return reads.groupBy("ref_index").agg(F.count("*").alias("n"))


# Range keys end in the name so that one crowded position still splits.
COORDINATE = ("ref_index", "pos", "qname", "flag")


def coordinate_sort(reads: DataFrame) -> DataFrame:
    """Reads in (reference, position) order over range partitions; none of them is a whole region."""
    return reads.repartitionByRange(*COORDINATE).sortWithinPartitions(*COORDINATE)


def reads_by_region(reads: DataFrame) -> DataFrame:
    """Reads of each region side by side in position order, as rows rather than arrays."""
    return coordinate_sort(reads.withColumn("region", F.col("ref_index")))


def read_group_tag(reads: DataFrame, tags: dict[str, str] | None = None) -> DataFrame:
    return reads.withColumns({k: F.lit(v) for k, v in (tags or READ_GROUP).items()})


def quality_encoding(reads: DataFrame) -> DataFrame:
    """Per region guess the encoding from its first read that has qualities, then bring qualities to Phred.

    ``reads``: ``region, ref_index, pos, qname, quals`` (array). A read whose
    shifted qualities fall below 0 is marked ``rejected``, not dropped.
    """
    # The aggregate sorts its rows, so it is given the largest quality, not the list.
    start = F.struct("ref_index", "pos", "qname", F.array_max("quals").alias("max_quality"))
    narrow = evaluated(reads, "region", F.when(F.size("quals") > 0, start).alias("start"))
    guesses = narrow.groupBy("region").agg(F.min("start").alias("first")).select(
        "region", guess_encoding(F.col("first.max_quality")).alias("encoding")
    )
    fixed = reads.join(small_side(guesses), "region").withColumn("phred", to_phred(F.col("quals"), F.col("encoding")))
    return fixed.withColumn("rejected", F.coalesce(F.array_min("phred") < 0, F.lit(False)))


def mended_qualities(reads: DataFrame) -> DataFrame:
    """Scanned reads with ``region, quals, encoding, phred, rejected`` from their printed qualities.

    The region is the reference sequence; reads on none of them go. Absent qualities (``*``, null) are an empty
    list, which is neither guessed from nor rejected.
    """
    quals = F.coalesce(decode_qualities(F.col("qual")), F.array().cast("array<int>"))
    return quality_encoding(reads.where("ref_index IS NOT NULL").withColumns({"region": F.col("ref_index"), "quals": quals}))


def covering_extents(reads: DataFrame) -> DataFrame:
    """``ref_index, chrom, start, end`` of the reads that cover a base; others, and reads without a position, go."""
    placed = with_alignment_end(reads).where(F.col("end") >= F.col("pos"))
    return placed.select("ref_index", F.col("rname").alias("chrom"), F.col("pos").alias("start"), "end")


def clean_reads(reads: DataFrame, seq_dict: DataFrame) -> DataFrame:
    """Soft-clip alignments that run past their reference; unmapped reads get mapping quality 0."""
    lengths = seq_dict.select("ref_index", F.col("length").alias("_length"))
    joined = with_alignment_end(reads).join(small_side(lengths), "ref_index", "left")
    overruns = ~has_flag(UNMAPPED) & (F.col("end") > F.col("_length")) & (F.col("pos") <= F.col("_length"))
    clipped = F.when(overruns, soft_clip_to(F.col("cigar"), F.col("_length") - F.col("pos") + 1)).otherwise(F.col("cigar"))
    return joined.select(
        *[c for c in reads.columns if c not in ("cigar", "mapq")],
        clipped.alias("cigar"),
        F.when(has_flag(UNMAPPED), F.lit(0)).otherwise(F.col("mapq")).alias("mapq"),
        F.coalesce(overruns, F.lit(False)).alias("was_clipped"),
    )


def mark_duplicates(reads: DataFrame) -> DataFrame:
    """Flag all but the best of reads that share chromosome, strand, 5' end and mate position.

    Best = highest sum of good qualities, then name, then the rest of the row; of
    exact copies one counts as best. A read without a 5' position is no duplicate. Reads are written
    with a row number, key and score first (a job), so qualities and CIGAR are read once. One aggregate of narrow
    rows, combined before it moves, then finds each key's best score, name and row; only keys in which several rows
    have that score and name compare the rest of those rows. Marks join back by row number, so no key is hot.
    """
    strand = has_flag(REVERSE)
    key = ["ref_index", "_strand", "_five_prime", "rnext", "pnext"]
    rest = [c for c in reads.columns if c not in ("qname", "ref_index", "rnext", "pnext")]
    placed = checkpointed(
        reads.select(
            "*",
            F.monotonically_increasing_id().alias("_row"),
            strand.alias("_strand"),
            unclipped_five_prime(F.col("pos"), F.col("cigar"), strand).alias("_five_prime"),
            (-F.coalesce(quality_score(F.col("qual")), F.lit(-1))).alias("_lack"),
        )
    )
    keyed = placed.where("_five_prime IS NOT NULL")
    # The smallest and the largest row number of the best score and name: the same, if one row has them.
    first = F.min(F.struct("_lack", "qname", "_row")).alias("first")
    last = F.min(F.struct("_lack", "qname", (-F.col("_row")).alias("_row"))).alias("last")
    tops = checkpointed(
        keyed.groupBy(*key).agg(first, last).select(*key, "first.*", (F.col("first._row") != -F.col("last._row")).alias("_shared"))
    )
    best = tops.where("NOT _shared").select("_row")
    shared = tops.where("_shared").drop("_row", "_shared")
    if shared.take(1):
        side = small_side(shared)
        same = reduce(and_, (F.col(f"a.{c}").eqNullSafe(side[c]) for c in side.columns))
        ties = keyed.alias("a").join(side, same, "left_semi")
        best = best.union(ties.groupBy(*key).agg(F.min(F.struct(*rest, "_row")).alias("best")).select("best._row"))
    marked = placed.join(small_side(best.withColumn("_best", F.lit(True))), "_row", "left")
    return marked.select(*reads.columns, (F.col("_five_prime").isNotNull() & F.col("_best").isNull()).alias("is_duplicate"))


def duplicate_metrics(marked: DataFrame) -> DataFrame:
    """Reads, duplicates and their share per library."""
    return (
        marked.groupBy("library")
        .agg(F.count("*").alias("reads"), F.count_if("is_duplicate").alias("duplicates"))
        .withColumn("duplication", F.round(F.col("duplicates") / F.col("reads"), 6))
    )


def library_metrics(marked: DataFrame) -> DataFrame:
    """The duplicate metrics with the estimated number of different molecules in each library."""
    distinct = F.col("reads") - F.col("duplicates")
    return duplicate_metrics(marked).withColumn("estimated_size", library_size(F.col("reads"), distinct))

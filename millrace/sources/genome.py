"""Aligned reads, sequence dictionaries, target regions and variants as text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.cluster import small_side
from millrace.sources.lines import numbered_lines

# Position of the sex and mitochondrial chromosomes in the
# sequence order chrM, chr1..chr22, chrX, chrY.
CHROM_X, CHROM_Y, CHROM_M = 23, 24, 0


def parse_seq_dict(lines: DataFrame) -> DataFrame:
    """``line_no, value`` → ``ref_index, name, length``; line 0 is the header.

    A length that is no number counts as 0.
    """
    after_colon = lambda c: F.when(F.instr(c, ":") > 0, F.substring(c, F.instr(c, ":") + 1, F.length(c))).otherwise(c)
    body = F.col("line_no") > 0
    part = F.when(body, F.split("value", r"\s+"))
    return lines.where(body).select(
        (F.col("line_no") - 1).cast("int").alias("ref_index"),
        after_colon(part[1]).alias("name"),
        F.coalesce(after_colon(part[2]).try_cast("int"), F.lit(0)).alias("length"),
    )


def scan_seq_dict(spark: SparkSession, path: str) -> DataFrame:
    return parse_seq_dict(numbered_lines(spark, path, per_file=False))


def parse_reads(lines: DataFrame, seq_dict: DataFrame) -> DataFrame:
    """Tab-separated alignment lines; header lines go, unreadable numbers become null.

    ``ref_index`` is null for names the dictionary does not hold (``*`` included).
    """
    part = F.split("value", "\t")
    text = lambda i: F.get(part, F.lit(i))
    number = lambda i: text(i).try_cast("int")
    reads = lines.where(~F.col("value").startswith("@")).select(
        text(0).alias("qname"),
        number(1).alias("flag"),
        text(2).alias("rname"),
        number(3).alias("pos"),
        number(4).alias("mapq"),
        text(5).alias("cigar"),
        text(6).alias("rnext"),
        number(7).alias("pnext"),
        number(8).alias("tlen"),
        text(9).alias("seq"),
        text(10).alias("qual"),
    )
    names = seq_dict.select(F.col("name").alias("rname"), "ref_index")
    return reads.join(small_side(names), "rname", "left").select(
        "qname", "flag", "rname", "ref_index", "pos", "mapq", "cigar", "rnext", "pnext", "tlen", "seq", "qual"
    )


def scan_reads(spark: SparkSession, path: str, seq_dict: DataFrame) -> DataFrame:
    return parse_reads(spark.read.text(path), seq_dict)


def scan_input_files(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of a folder with the file they came from; Spark splits, not files, make the tasks."""
    return spark.read.text(folder).select(F.col("_metadata.file_path").alias("file"), "value")


def scan_bed(spark: SparkSession, path: str) -> DataFrame:
    """``chrom, start, end`` (0-based, half-open) and the other columns as one string."""
    body = ~F.col("value").rlike(r"^(#|track\b|browser\b)") & (F.trim("value") != "")
    part = F.when(body, F.split("value", "\t"))
    rows = spark.read.text(path).where(body)
    return rows.select(
        part[0].alias("chrom"),
        part[1].cast("int").alias("start"),
        part[2].cast("int").alias("end"),
        F.array_join(F.slice(part, F.lit(4), F.greatest(F.size(part) - 3, F.lit(0))), "\t").alias("extra"),
    )


def chrom_number(name: Column) -> Column:
    """Number in a chromosome's name; names without digits other than X, Y, M are an error.

    ``name`` is used once, so a filter on the number stays cheap wherever Spark moves it.
    """
    for letter, number in (("X", CHROM_X), ("Y", CHROM_Y), ("M", CHROM_M)):
        name = F.regexp_replace(name, f"^chr{letter}$", str(number))
    return F.regexp_replace(name, "[^0-9]", "").cast("int")


def parse_vcf(lines: DataFrame) -> DataFrame:
    """Variant lines → ``chrom, pos, ref, alt, line``; ``#`` lines go.

    Splitting under the same condition keeps header lines from being indexed
    when Spark moves a later filter below this one.
    """
    body = ~F.col("value").startswith("#")
    part = F.when(body, F.split("value", "\t"))
    return lines.where(body).select(
        chrom_number(part[0]).alias("chrom"),
        part[1].cast("int").alias("pos"),
        part[3].alias("ref"),
        part[4].alias("alt"),
        F.col("value").alias("line"),
    )


def scan_vcf(spark: SparkSession, path: str) -> DataFrame:
    return parse_vcf(spark.read.text(path))

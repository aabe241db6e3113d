"""CIGAR strings as column expressions (SAM specification, section 1.4)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Operations that advance along the reference / along the read.
REFERENCE_OPS = "MDN=X"
READ_OPS = "MIS=X"


def _sum_lengths(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0), lambda total, n: total + n.cast("int"))


def reference_span(cigar: Column) -> Column:
    """Reference bases covered by an alignment; 0 for ``*``."""
    return _sum_lengths(F.regexp_extract_all(cigar, F.lit(rf"(\d+)[{REFERENCE_OPS}]"), 1))


def alignment_end(pos: Column, cigar: Column) -> Column:
    """Last covered reference position, 1-based and inclusive."""
    return pos + reference_span(cigar) - 1


def leading_clip(cigar: Column) -> Column:
    """Clipped bases before the first aligned base."""
    head = F.regexp_extract(cigar, r"^((?:\d+[SH])*)", 1)
    return _sum_lengths(F.regexp_extract_all(head, F.lit(r"(\d+)"), 1))


def trailing_clip(cigar: Column) -> Column:
    """Clipped bases after the last aligned base."""
    tail = F.regexp_extract(cigar, r"[^SH0-9]((?:\d+[SH])*)$", 1)
    return _sum_lengths(F.regexp_extract_all(tail, F.lit(r"(\d+)"), 1))


def unclipped_five_prime(pos: Column, cigar: Column, reverse: Column) -> Column:
    """Position of the read's 5' end had nothing been clipped."""
    return F.when(reverse, alignment_end(pos, cigar) + trailing_clip(cigar)).otherwise(
        pos - leading_clip(cigar)
    )


def soft_clip_to(cigar: Column, allowed: Column) -> Column:
    """Keep ``allowed`` reference bases; read bases past them become one soft clip.

    A deletion or skip that crosses the limit is dropped, hard clips stay last.
    """
    steps = F.transform(
        F.regexp_extract_all(cigar, F.lit(r"(\d+[MIDNSHP=X])"), 1),
        lambda s: F.struct(
            F.regexp_extract(s, r"^(\d+)", 1).cast("int").alias("n"),
            F.regexp_extract(s, r"(.)$", 1).alias("op"),
        ),
    )
    start = F.struct(
        F.lit(0).alias("used"), F.lit("").alias("kept"), F.lit(0).alias("clipped"), F.lit("").alias("hard")
    )

    def step(acc: Column, x: Column) -> Column:
        n, op = x["n"], x["op"]
        on_ref = op.isin(*REFERENCE_OPS)
        on_read = op.isin(*READ_OPS)
        room = F.greatest(allowed - acc["used"], F.lit(0))
        full = room <= 0
        aligned = op.isin("M", "=", "X")
        hard = (op == "H") & full
        take = (
            F.when(aligned, F.least(n, room))
            .when(on_ref, F.when(n < room, n).otherwise(0))
            .when(full, 0)
            .otherwise(n)
        )
        spill = F.when(on_read, n - take).otherwise(0)
        return F.struct(
            (acc["used"] + F.when(on_ref, n).otherwise(0)).alias("used"),
            F.when(take > 0, F.concat(acc["kept"], take.cast("string"), op)).otherwise(acc["kept"]).alias("kept"),
            (acc["clipped"] + spill).alias("clipped"),
            F.when(hard, F.concat(acc["hard"], n.cast("string"), op)).otherwise(acc["hard"]).alias("hard"),
        )

    return F.aggregate(
        steps,
        start,
        step,
        lambda acc: F.concat(
            acc["kept"],
            F.when(acc["clipped"] > 0, F.concat(acc["clipped"].cast("string"), F.lit("S"))).otherwise(""),
            acc["hard"],
        ),
    )

"""Base qualities."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Largest plausible Phred quality, the shift between the two
# encodings, the ASCII base of stored qualities, the lowest quality that scores.
SANGER_MAX = 60
ILLUMINA_SHIFT = 31
ASCII_BASE = 33
SCORING_MIN = 15


def decode_qualities(text: Column) -> Column:
    """Printable quality string to ``array<int>``; ``*`` (absent) gives an empty array."""
    chars = F.filter(F.split(text, ""), lambda c: c != "")
    return F.when(text == "*", F.array().cast("array<int>")).otherwise(
        F.transform(chars, lambda c: F.ascii(c) - ASCII_BASE)
    )


def quality_score(text: Column) -> Column:
    """Sum of the qualities in a printable string that reach the scoring minimum; 0 for ``*``."""
    value = lambda c: F.ascii(c) - ASCII_BASE
    return F.aggregate(
        F.split(text, ""),
        F.lit(0).cast("bigint"),
        lambda total, c: total + F.when(value(c) >= SCORING_MIN, value(c)).otherwise(0),
    )


def guess_encoding(max_quality: Column) -> Column:
    return F.when(max_quality <= SANGER_MAX, F.lit("SANGER")).otherwise(F.lit("ILLUMINA"))


def to_phred(qualities: Column, encoding: Column) -> Column:
    """Shift Illumina qualities down; Sanger ones stay."""
    return F.when(encoding == "ILLUMINA", F.transform(qualities, lambda q: q - ILLUMINA_SHIFT)).otherwise(qualities)

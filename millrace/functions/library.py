"""Size of a sequenced library."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Halvings of the bracket: more than a double has bits.
HALVINGS = 60


def library_size(reads: Column, distinct: Column) -> Column:
    """Molecules X in a library of which ``reads`` random draws showed ``distinct`` different ones.

    Draws saturate: distinct = X (1 - exp(-reads / X)). With u = reads / X the share distinct / reads
    is (1 - exp(-u)) / u, which falls from 1 at u = 0 and is below 1 / u, so the root lies between
    0 and reads / distinct; it is found by bisection. Null where nothing limits the size: no reads, or
    no duplicates. All reads but one being duplicates gives 1.
    """
    n, c = reads.cast("double"), distinct.cast("double")
    middle = lambda b: (b["lo"] + b["hi"]) / 2

    def halve(b: Column, _: Column) -> Column:
        below = -F.expm1(-middle(b)) * n > middle(b) * c
        return F.struct(
            F.when(below, middle(b)).otherwise(b["lo"]).alias("lo"), F.when(below, b["hi"]).otherwise(middle(b)).alias("hi")
        )

    bracket = F.struct(F.lit(0.0).alias("lo"), F.try_divide(n, c).alias("hi"))
    size = F.aggregate(F.sequence(F.lit(1), F.lit(HALVINGS)), bracket, halve, lambda b: F.round(n / middle(b)).cast("bigint"))
    return F.when((c > 0) & (c < n), size)

"""Growth of a counter between its lowest and highest sighting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

COUNT_MODES = ("floor_one", "diff", "diff_plus_one")


def count_growth(max_count: Column, min_count: Column, mode: str) -> Column:
    """``floor_one``: 1 when nothing moved, else the difference; the others as named."""
    diff = max_count - min_count
    if mode == "floor_one":
        return F.when(max_count == min_count, F.lit(1)).otherwise(diff)
    if mode == "diff":
        return diff
    if mode == "diff_plus_one":
        return diff + 1
    raise ValueError(f"count mode must be one of {COUNT_MODES}, not {mode!r}")

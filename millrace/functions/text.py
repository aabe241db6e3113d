"""Text clean-up of short posts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean_text(text: Column) -> Column:
    """Drop the first ``RT``, every ``@name`` and every URL with one blank after it."""
    rest = F.substring(text, F.instr(text, "RT") + 2, F.length(text))
    no_marker = F.when(F.instr(text, "RT") > 0, F.concat(F.substring_index(text, "RT", 1), rest)).otherwise(text)
    no_names = F.regexp_replace(no_marker, r"@\p{L}+", "")
    return F.regexp_replace(no_names, r"https?://\S+\s?", "")


def one_line(text: Column) -> Column:
    """Each CR or LF becomes one blank."""
    return F.regexp_replace(text, r"[\r\n]", " ")


def script_fix(code: Column, text: Column) -> Column:
    """Detectors take Japanese and Korean for Lithuanian; decide by script instead."""
    doubtful = code == "lt"
    return (
        F.when(doubtful & text.rlike(r"\p{InHiragana}"), F.lit("ja"))
        .when(doubtful & text.rlike(r"\p{IsHangul}"), F.lit("ko"))
        .otherwise(code)
    )

"""Language of a text by ranked character trigrams (Cavnar and Trenkle, 1994)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.functions.text import clean_text, one_line, script_fix

PROFILE_SIZE = 300
BATCH_LETTERS = 1 << 20  # characters that are ranked at once; a longer text is a batch of its own

_BITS = 21  # of a code point


def framed_letters(cleaned: Column) -> Column:
    """Letters of a text, words parted and framed by one blank."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(cleaned), r"[^\p{L}]+", " ")), F.lit(" "))


def trigrams(text: Column) -> Column:
    """Overlapping trigrams of ``framed_letters`` of the cleaned text.

    One regex pass with a lookahead, so time is linear in the text's length.
    """
    return F.regexp_extract_all(framed_letters(clean_text(text)), F.lit("(?=(...))"), 1)


def language_profiles(samples: DataFrame, size: int = PROFILE_SIZE) -> DataFrame:
    """``lang, text`` → ``lang, trigram, rank`` of each language's most frequent trigrams.

    Counts combine on the map side; the rank limit is applied before the rank
    shuffle too, so a dominant language moves only candidate rows.
    """
    counts = (
        samples.select("lang", F.explode(trigrams(F.col("text"))).alias("trigram"))
        .groupBy("lang", "trigram")
        .agg(F.count("*").alias("n"))
    )
    order = W.partitionBy("lang").orderBy(F.desc("n"), "trigram")
    return counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= size).drop("n")


def _packed(points: np.ndarray) -> np.ndarray:
    """Each three code points in a row as one integer, in the order of the strings."""
    p = points.astype(np.int64)
    return (p[:-2] << (2 * _BITS)) | (p[1:-1] << _BITS) | p[2:]


def ranked_trigrams(texts: list[str], size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(text, rank, trigram)`` of the ``size`` most frequent trigrams of each text, by text and rank from 1.

    Ties go to the smaller trigram. All texts are counted by one sort and ranked by another.
    """
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    if len(points) < 3:
        none = np.zeros(0, np.int64)
        return none, none, none
    owner = np.repeat(np.arange(len(texts)), lengths)
    inside = owner[:-2] == owner[2:]  # not over the end of a text
    text, gram = owner[:-2][inside], _packed(points)[inside]
    by = np.lexsort((gram, text))
    text, gram = text[by], gram[by]
    begin = np.flatnonzero((np.diff(text, prepend=-1) != 0) | (np.diff(gram, prepend=-1) != 0))
    times = np.diff(np.append(begin, len(text)))
    text, gram = text[begin], gram[begin]
    by = np.lexsort((gram, -times, text))
    text, gram = text[by], gram[by]
    rank = np.arange(len(text)) - np.searchsorted(text, text) + 1
    kept = rank <= size
    return text[kept], rank[kept], gram[kept]


class Profiles:
    """Ranked trigrams of all languages as one sorted array, to be looked up by many trigrams at once."""

    def __init__(self, rows: list[tuple[str, str, int]], size: int):
        self.size = size
        self.codes = sorted({lang for lang, _, _ in rows})
        number = {code: i for i, code in enumerate(self.codes)}
        whole = [(_packed(np.array([ord(c) for c in t]))[0], number[lang], rank) for lang, t, rank in rows if len(t) == 3]
        whole.sort()
        gram = np.array([g for g, _, _ in whole], np.int64)
        self.lang = np.array([i for _, i, _ in whole], np.int64)
        self.rank = np.array([r for _, _, r in whole], np.int64)
        self.gram, self.begin = np.unique(gram, return_index=True)
        self.number_of = np.diff(np.append(self.begin, len(gram)))

    def nearest(self, texts: list[str]) -> tuple[list[str | None], np.ndarray]:
        """Language and distance of each text."""
        n, langs = len(texts), len(self.codes)
        text, rank, gram = ranked_trigrams(texts, self.size)
        every = np.bincount(text, minlength=n) * self.size
        if not langs:
            return [None] * n, every
        at = np.minimum(np.searchsorted(self.gram, gram), max(len(self.gram) - 1, 0))
        known = np.flatnonzero(self.gram[at] == gram) if len(self.gram) else np.zeros(0, np.int64)
        times = self.number_of[at[known]]
        row = np.repeat(known, times)  # a row per trigram and language that has it
        entry = np.repeat(self.begin[at[known]] - np.cumsum(times) + times, times) + np.arange(len(row))
        gain = np.abs(rank[row] - self.rank[entry]) - self.size  # from "all missing"
        # Sums of integers far below 2 ** 53, so the doubles of ``bincount`` are exact.
        total = np.bincount(text[row] * langs + self.lang[entry], weights=gain, minlength=n * langs).reshape(n, langs)
        shared = np.bincount(text[row] * langs + self.lang[entry], minlength=n * langs).reshape(n, langs) > 0
        # A language that shares no trigram stands behind those that do, also where their gain is 0.
        best = np.argmin(np.where(shared, total, 0.5), axis=1)
        return [self.codes[i] for i in best], every + total[np.arange(n), best].astype(np.int64)


def _batches(texts: list[str]) -> Iterator[list[str]]:
    """Runs of texts of at most ``BATCH_LETTERS`` characters, or of one text."""
    begin = letters = 0
    for i, text in enumerate(texts):
        if letters + len(text) > BATCH_LETTERS and i > begin:
            yield texts[begin:i]
            begin, letters = i, 0
        letters += len(text)
    if begin < len(texts):
        yield texts[begin:]


def language_of(cleaned: Column, profiles: DataFrame, size: int = PROFILE_SIZE) -> Column:
    """``struct(language, distance)`` of a cleaned text, in batch and in streams.

    Distance = sum over the text's ranked trigrams of the rank difference, or
    ``size`` where the language lacks the trigram; smallest distance wins, then
    the smaller code. The trigrams of a whole Arrow batch are counted, ranked and looked up as arrays of packed
    integers, so nothing is shuffled and no code runs per text or trigram. The profiles, ``size`` rows for each language,
    are read once (a job) and sent along with the function. A null or empty text has distance 0 and the first code.
    """
    rows = profiles.select("lang", "trigram", "rank").where("lang IS NOT NULL").collect()
    known = Profiles([tuple(r) for r in rows], size)

    def identify(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            texts = [t or "" for t in column.to_pylist()]
            codes: list[str | None] = []
            distances = [np.zeros(0, np.int64)]
            for part in _batches(texts):
                found, distance = known.nearest(part)
                codes += found
                distances.append(distance)
            yield pa.StructArray.from_arrays(
                [pa.array(codes, pa.string()), pa.array(np.concatenate(distances), pa.int64())], ["language", "distance"]
            )

    return F.arrow_udf(identify, "struct<language:string,distance:bigint>")(framed_letters(cleaned))


def identify_language(texts: DataFrame, profiles: DataFrame, size: int = PROFILE_SIZE) -> DataFrame:
    """``doc_id, text`` → ``doc_id, language, distance``."""
    found = texts.select("doc_id", language_of(clean_text(F.col("text")), profiles, size).alias("found"))
    return found.select("doc_id", "found.language", "found.distance")


def detect_language(posts: DataFrame, profiles: DataFrame, size: int = PROFILE_SIZE) -> DataFrame:
    """Posts with ``text`` cleaned and ``lang`` told from it, mended by script; for the trend job, batch or stream."""
    cleaned = posts.withColumn("text", one_line(clean_text(F.col("text"))))
    code = language_of(F.col("text"), profiles, size)["language"]
    return cleaned.withColumn("lang", script_fix(code, F.col("text")))

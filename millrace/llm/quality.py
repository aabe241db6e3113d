"""Quality rules: base rules, and robust multivariate outliers by minimum covariance determinants.

Statistics are counted inside each row. For every language and source (a language, or all rows, where
there are too few) the half-way robust start from medians is concentrated: mean and covariance of the
``SHARE`` nearest rows, distances from those, again. Each step is a grouped sum of narrow rows, so a
source of any size is combined before it moves.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.cluster import checkpointed

SPACES = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

SHARE = 0.75  # of a group's rows that the estimates rest on
STEPS = 6
MIN_GROUP = 200  # rows for estimates of a group's own
# Added to the variances, so statistics that hardly vary do not make every other row an outlier.
FLOORS = {"z1": 0.25, "z2": 0.08, "z3": 0.08, "z4": 0.16, "z5": 0.16}
CUT = 45.0  # squared distance of outliers
MEDIAN_CHI2 = 4.351  # median of the chi-squared distribution with five degrees of freedom
BINS = 32  # of a distance histogram, for each doubling

_Z = list(FLOORS)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.translate(text, SPACES, " " * len(SPACES)), " "), "")


def repeated_words(words: Column) -> Column:
    """Words that lie in a window of three words found twice or more. Windows are compared by 64-bit hashes."""
    n = F.size(words)

    def covered(places: Column) -> Column:
        steps = F.transform(
            places,
            lambda p, k: F.when(k + 1 < F.size(places), F.least(F.lit(3), F.get(places, k + 1) - p)).otherwise(3),
        )
        return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

    def places_of(rows: Column) -> Column:
        twice = F.filter(
            rows,
            lambda e, k: (F.get(rows, k - 1)["h"] == e["h"]) | (F.coalesce(F.get(rows, k + 1)["h"] == e["h"], F.lit(False))),
        )
        return F.sort_array(F.transform(twice, lambda e: e["i"]))

    def of_hashes(hashes: Column) -> Column:
        rows = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        found = let(rows, lambda r: let(places_of(r), covered))
        return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), found).otherwise(0)

    hashes = F.transform(
        F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))
    )
    return F.when(n >= 3, let(hashes, of_hashes)).otherwise(0)


def text_statistics(docs: DataFrame, *keep: str) -> DataFrame:
    """``docs`` columns ``keep`` with n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words of ``text``."""
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda line: F.translate(line, SPACES, "") != "")
    by_words = let(
        words_of(text), lambda w: F.struct(F.size(w).alias("n_words"), repeated_words(w).alias("n_repeat_words"))
    )
    by_lines = let(lines, lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("dup")))
    counted = docs.select(
        *keep,
        by_words.alias("w"),
        by_lines.alias("l"),
        F.length(F.translate(text, SPACES, "")).cast("long").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
    )
    return counted.select(
        *keep,
        F.col("w.n_words").cast("long").alias("n_words"),
        "word_chars",
        "n_symbols",
        F.col("l.n").cast("long").alias("n_lines"),
        F.col("l.dup").cast("long").alias("n_dup_lines"),
        F.col("w.n_repeat_words").cast("long").alias("n_repeat_words"),
    )


def _distance(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    """Squared Mahalanobis distance of rows from their group's estimates: forward substitution in Cholesky factors."""
    joined = rows.join(estimates, "grp")
    for k, z in enumerate(_Z):
        before = sum((F.col(f"l{k}{j}") * F.col(f"y{j}") for j in range(k)), F.lit(0.0))
        joined = joined.withColumn(f"y{k}", (F.col(z) - F.col(f"m_{z}") - before) / F.col(f"l{k}{k}"))
    d2 = sum((F.col(f"y{k}") * F.col(f"y{k}") for k in range(len(_Z))), F.lit(0.0))
    return joined.withColumn("d2", d2)


def _bin(d2: Column) -> Column:
    return F.floor(F.log2(d2 + 1e-9) * BINS).cast("int")


def _quantiles(rows: DataFrame, **shares: float) -> DataFrame:
    """Per group, upper bounds of the bins in which these shares of the rows are reached."""
    bins = rows.groupBy("grp", _bin(F.col("d2")).alias("bin")).agg(F.count("*").alias("n"))
    # A distance has at most a few thousand bins, so this list is bounded.
    listed = bins.groupBy("grp").agg(
        F.sort_array(F.collect_list(F.struct("bin", "n"))).alias("bins"), F.sum("n").alias("rows")
    )

    def reached(share: float) -> Column:
        start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(None).cast("int").alias("bin"))
        end = F.aggregate(
            "bins",
            start,
            lambda a, b: F.struct(
                (a["n"] + b["n"]).alias("n"),
                F.when(a["n"] < F.col("rows") * share, b["bin"]).otherwise(a["bin"]).alias("bin"),
            ),
        )
        return F.pow(F.lit(2.0), (end["bin"] + 1) / F.lit(float(BINS)))

    return listed.select("grp", "rows", *(reached(share).alias(name) for name, share in shares.items()))


def _estimates(rows: DataFrame) -> DataFrame:
    """Per group: means and the Cholesky factors of the covariance with floors."""
    pairs = [(i, j) for i in range(len(_Z)) for j in range(i + 1)]
    sums = rows.groupBy("grp").agg(
        *(F.avg(z).alias(f"m_{z}") for z in _Z),
        *(F.covar_pop(_Z[i], _Z[j]).alias(f"c{i}{j}") for i, j in pairs),
    )
    for i, j in pairs:
        inner = sum((F.col(f"l{i}{k}") * F.col(f"l{j}{k}") for k in range(j)), F.lit(0.0))
        if i == j:
            value = F.sqrt(F.greatest(F.col(f"c{i}{i}") + FLOORS[_Z[i]] ** 2 - inner, F.lit(FLOORS[_Z[i]] ** 2 / 4)))
        else:
            value = (F.col(f"c{i}{j}") - inner) / F.col(f"l{j}{j}")
        sums = sums.withColumn(f"l{i}{j}", value)
    return sums.select("grp", *(f"m_{z}" for z in _Z), *(f"l{i}{j}" for i, j in pairs))


def robust_estimates(rows: DataFrame) -> DataFrame:
    """``(grp, means, factors, scale)`` by concentration steps over ``(grp, z1..z5)``."""
    middles = rows.groupBy("grp").agg(*(F.percentile_approx(z, 0.5).alias(f"m_{z}") for z in _Z))
    spreads = (
        rows.join(middles, "grp")
        .groupBy("grp")
        .agg(*(F.percentile_approx(F.abs(F.col(z) - F.col(f"m_{z}")), 0.5).alias(f"s_{z}") for z in _Z))
    )
    start = middles.join(spreads, "grp").select(
        "grp",
        *(f"m_{z}" for z in _Z),
        *(
            (F.greatest(1.4826 * F.col(f"s_{_Z[i]}"), F.lit(FLOORS[_Z[i]])) if i == j else F.lit(0.0)).alias(f"l{i}{j}")
            for i in range(len(_Z))
            for j in range(i + 1)
        ),
    )
    now = checkpointed(start)
    for _ in range(STEPS):
        far = _distance(rows, now).select("grp", *_Z, "d2")
        near = far.join(_quantiles(far, cut=SHARE).select("grp", "cut"), "grp").where("d2 <= cut")
        now = checkpointed(_estimates(near))
    far = _distance(rows, now).select("grp", "d2")
    middle = _quantiles(far, middle=0.5)
    return checkpointed(
        now.join(middle, "grp").withColumn("scale", F.greatest(F.col("middle") / MEDIAN_CHI2, F.lit(1.0)))
    )


def quality_verdicts(docs: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Statistics and verdict per row of ``docs(doc_id, text, lang, source)``.

    ``(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, distance)``. A null text has no
    words; null lang or source is a value of its own. Rows that fail the base rules take no part in the
    estimates and are not kept; their ``distance`` is null. Others are kept if their squared robust distance is at most ``CUT``.
    Repeated rows stay and count each time; other columns are ignored. With ``carry``, the
    result is these columns of the kept rows alone. Runs jobs.
    """
    kept = [f"_carry{i}" for i in range(len(carry))]
    docs = docs.select("doc_id", "text", "lang", "source", *(F.col(c).alias(k) for c, k in zip(carry, kept, strict=True)))
    stats = text_statistics(docs, "doc_id", "lang", "source", *kept)
    n = F.greatest(F.col("n_words"), F.lit(1))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    none = F.lit("\x00")
    lang, source = F.coalesce("lang", none), F.coalesce("source", none)
    rows = checkpointed(
        stats.withColumns(
            {
                "base_failed": failed,
                "z1": F.log(n),
                "z2": F.log(F.greatest(F.col("word_chars"), F.lit(1)) / n),
                "z3": F.sqrt(F.col("n_symbols") / n),
                "z4": F.sqrt(F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1))),
                "z5": F.sqrt(F.col("n_repeat_words") / n),
                # From the own group to all rows.
                "groups": F.array(F.concat(F.lit("2"), lang, F.lit("\x01"), source), F.concat(F.lit("1"), lang), F.lit("0")),
            }
        )
    )
    sound = rows.where("NOT base_failed").select(F.explode("groups").alias("grp"), *_Z)
    sizes = sound.groupBy("grp").agg(F.count("*").alias("size")).where((F.col("size") >= MIN_GROUP) | (F.col("grp") == "0"))
    large = checkpointed(sizes)
    estimates = robust_estimates(sound.join(large.select("grp"), "grp"))
    # A row's group is the first of its own that has estimates.
    known = large.select("grp", F.lit(True).alias("known"))
    keys = rows.select("groups").distinct().select("groups", F.posexplode("groups").alias("pos", "grp")).join(known, "grp")
    chosen = keys.groupBy("groups").agg(F.min("pos").alias("pos"))
    placed = rows.join(chosen, "groups", "left").withColumn("grp", F.col("groups")[F.coalesce("pos", F.lit(2))])
    judged = _distance(placed.where("NOT base_failed"), estimates).withColumn("distance", F.col("d2") / F.col("scale"))
    out = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    if carry:
        return judged.where(F.col("distance") <= CUT).select(*(F.col(k).alias(c) for c, k in zip(carry, kept, strict=True)))
    return judged.select(*out, (F.col("distance") <= CUT).alias("kept"), "distance").union(
        rows.where("base_failed").select(*out, F.lit(False), F.lit(None).cast(T.DoubleType()))
    )

import random
from collections import Counter

from llm_cases import EDGES, SPACED, documents, prose
from pyspark.sql import functions as F

from millrace.llm import quality


def brute(text):
    text = text or ""
    w = SPACED.findall(text)
    lines = [line for line in text.split("\n") if SPACED.search(line)]
    grams = [tuple(w[j : j + 3]) for j in range(len(w) - 2)]
    times = Counter(grams)
    covered = {j + k for j, g in enumerate(grams) if times[g] > 1 for k in range(3)}
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(covered), failed


TEXTS = [*EDGES, "a b c a b c a b c", "x y z\n x y z\nx y z\n\n \n", "# * $ %", prose(3, 60) + "\n" + "same line\n" * 3, "aa " * 40_000]


def test_statistics_match_brute_force(spark):
    rows = [*enumerate(TEXTS), (3, "one"), (None, prose(1, 70))]
    got = quality.quality_verdicts(documents(spark, rows)).collect()
    assert sorted((tuple(r)[:7] for r in got), key=repr) == sorted(((i, *brute(t)) for i, t in rows), key=repr)
    assert all(not r.kept for r in got if r.base_failed) and all(r.kept is not None for r in got)


def crowd(seed, n):
    rng = random.Random(seed)
    texts = [prose(rng.random(), rng.randrange(60, 400), 3000) for _ in range(n)]
    noisy = [" ".join(w + rng.choice(("###", "%%%")) for w in prose(rng.random(), 200, 3000).split()) for _ in range(n // 10)]
    return texts, noisy


def test_outliers_go_and_clean_texts_stay(spark):
    clean, noisy = crowd(1, 400)
    few, few_noisy = crowd(2, 30)  # a source too small for estimates of its own
    docs = (
        documents(spark, [(i, t) for i, t in enumerate(clean)] + [(1000 + i, t) for i, t in enumerate(noisy)])
        .union(documents(spark, [(2000 + i, t) for i, t in enumerate(few)] + [(3000 + i, t) for i, t in enumerate(few_noisy)], "de", "small"))
        .withColumn("source", F.when(F.col("doc_id") % 50 == 0, None).otherwise(F.col("source")))
    )
    kept = {r.doc_id: r.kept for r in quality.quality_verdicts(docs).collect()}
    for i, k in kept.items():
        assert k == (i // 1000 in (0, 2)), i


def test_carried_columns(spark):
    docs = documents(spark, [(1, prose(1, 80)), (2, "short"), (None, prose(2, 90))])
    kept = quality.quality_verdicts(docs, carry=docs.columns)
    assert kept.columns == docs.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1]


def test_empty_table(spark):
    assert quality.quality_verdicts(documents(spark, ["a"]).limit(0)).count() == 0

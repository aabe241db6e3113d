import numpy as np
from millrace.llm import hard_negatives as hn
from millrace.llm.hard_negatives import Best, Run, codebook, hard_negatives, search
from pyspark.sql import functions as F

SCHEMA = "vec_id long, embedding array<float>, label int, anchor_id string, score int"


def brute(rows, positives=5, negatives=10):
    good = {}
    for i, v, label in rows:
        if i is not None and label is not None and v is not None and all(c is not None and np.isfinite(c) for c in v):
            x = tuple(int(np.floor(256 * float(np.float32(c)))) for c in v)
            good[i] = max(good.get(i, (label, x)), (label, x))
    out = set()
    for a, (label, x) in good.items():
        if a % 100:
            continue
        score = {i: sum(p * q for p, q in zip(x, y, strict=True)) for i, (_, y) in good.items()}
        first = sorted((i for i in good if good[i][0] == label and i != a), key=lambda i: (-score[i], i))[:positives]
        for p in first:
            other = [i for i in good if good[i][0] != label and 30 * score[p] <= 100 * score[i] <= 90 * score[p]]
            for k, i in enumerate(sorted(other, key=lambda i: (-score[i], i))[:negatives], 1):
                out.add((a, p, k, i, score[p], score[i]))
    return out


def run(spark, rows, **more):
    df = spark.createDataFrame([(i, v, label, "clash", 1) for i, v, label in rows], SCHEMA)
    found = hard_negatives(df, F.col("vec_id") % 100 == 0, **more)
    return sorted(tuple(r) for r in found.collect())


def test_equals_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(1)
    base = rng.standard_normal((9, 10))
    rows = [(i * 5, [float(c) for c in base[rng.integers(9)] + rng.standard_normal(10) * 0.2], int(rng.integers(4))) for i in range(400)]
    rows += [(5000 + i, rows[3][1], i % 3) for i in range(120)]  # copies: ties everywhere
    rows += [(100, rows[5][1], 9), (100, rows[5][1], 9), (None, rows[1][1], 1), (9000, None, 1), (9100, rows[1][1], None)]
    rows += [(9200, [None] * 10, 1), (9300, [float("nan")] * 10, 1), (9400, [float("-inf")] * 10, 1)]
    want = sorted(brute(rows))
    assert run(spark, rows) == want and len(want) > 300
    # Several blocks of anchors, and several runs of rows in a task.
    monkeypatch.setattr(hn, "BLOCK_BYTES", 400)
    assert run(spark, rows, run_rows=60) == want


def test_empty_short_and_huge(spark):
    assert run(spark, []) == [] and run(spark, [(0, [], 1), (1, [], 2)]) == []
    assert run(spark, [(1, [1.0], 1), (2, [1.0], 2)]) == []  # no anchor
    rows = [(0, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [0.5, 0.0], 2), (3, [0.2, 0.0], 2), (4, [1.0], 2)]
    assert run(spark, rows) == [(0, 1, 1, 2, 65536, 32768)]
    big = [(0, [1e7, 0.0], 1), (1, [1e7, 1.0], 1), (2, [5e6, 0.0], 2), (3, [1.0, 0.0], 2)]
    assert run(spark, big) == sorted(brute(big)) and len(brute(big)) == 1


def test_certified_stop_leaves_most_rows_unread():
    rng = np.random.default_rng(2)
    centres = rng.integers(-100, 100, (16, 32))
    x = centres[rng.integers(16, size=20_000)] + rng.integers(-3, 4, (20_000, 32))
    books = codebook(x[:2000, :16].astype(float)), codebook(x[:2000, 16:].astype(float))
    rows = Run(np.arange(len(x)), np.zeros(len(x), np.int64), x, books)
    seen = 0
    for q in x[:50]:
        best = Best(10)
        seen += search(rows, q, [best], lambda a, b: np.ones(b - a, bool))
        score = rows.whole @ q
        want = np.lexsort((rows.ids, -score))[:10]
        assert best.ids.tolist() == rows.ids[want].tolist() and best.scores.tolist() == score[want].tolist()
    assert seen < 0.5 * 50 * len(x)

import hashlib

import numpy as np
import pytest
from llm_cases import ALNUM, EDGES, documents, prose, words

from millrace.llm import decontaminate as op

ITEM = "Alpha beta gamma, delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho."
ITEMS = [(1, ITEM), (2, "short item here"), (10, ITEM), (3, None), (4, " .,; "), (None, "unnamed item text"), (5, "one")]


def benchmark(spark, items=ITEMS):
    return spark.createDataFrame([(i, t, "x") for i, t in items], "item_id bigint, text string, spans string")


def brute(text, items, window=13):
    w, hit, found = words(text, ALNUM), set(), set()
    for item, t in items:
        q = words(t, ALNUM)
        size = min(window, len(q))
        for j in range(len(q) - size + 1) if q else ():
            for i in range(len(w) - size + 1):
                if w[i : i + size] == q[j : j + size]:
                    hit.update(range(i, i + size))
                    found.add("null" if item is None else str(item))
    names = ",".join(sorted(found))
    sha = hashlib.sha256(names.encode()).hexdigest()
    return len(w), len(hit), len(found), sha, bool(hit) and 20 * len(hit) >= len(w)


TEXTS = [
    *EDGES,
    ITEM,
    prose(4, 300) + " " + ITEM + " " + prose(5, 300),
    "x " + ITEM[:60] + " y",
    "SHORT item. here! short item here",
    "one two one",
    "gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron and more " * 3,
    "unnamed item",
]


@pytest.mark.parametrize("block_bytes", [1 << 20, 40])
def test_windows_match_brute_force(spark, block_bytes):
    texts = [t for t in TEXTS if len(t or "") < 50_000]
    rows = [(i, t) for i, t in enumerate(texts)] + [(0, ITEM), (None, ITEM)]
    found = op.match_benchmark(documents(spark, rows), benchmark(spark), block_bytes=block_bytes)
    got = sorted(((r.doc_id, r.n_words, r.n_hit, len(r["items"])) for r in found.collect()), key=repr)
    assert got == sorted(((i, *brute(t, ITEMS)[:3]) for i, t in rows), key=repr)


def test_verdicts_and_long_texts(spark):
    got = {r.doc_id: tuple(r)[1:6] for r in op.contamination(documents(spark, TEXTS), benchmark(spark)).collect()}
    for i, t in enumerate(TEXTS):
        if len(t or "") < 50_000:
            assert got[i] == brute(t, ITEMS)
    assert got[EDGES.index(EDGES[8])][0] == 30_000


def test_longest_match(spark):
    text = "x x " + " ".join(words(ITEM, ALNUM)[1:16]) + " y"
    row = op.match_benchmark(documents(spark, [text]), benchmark(spark)).first()
    assert row.longest.asDict() == {"item": "1", "item_start": 1, "start": 2, "length": 15}
    assert row.spans == [2, 17]


def test_empty_tables(spark):
    none = benchmark(spark).limit(0)
    assert op.match_benchmark(documents(spark, ["a b"]), none).first().n_hit == 0
    assert op.match_benchmark(documents(spark, ["a"]).limit(0), benchmark(spark)).count() == 0


def test_suffix_array_is_sorted():
    rng = np.random.default_rng(1)
    text = np.concatenate([rng.integers(1, 4, 200), [0], np.tile([1, 2], 60), [0]])
    order = op.suffix_array(text, 3, 64)
    suffixes = [tuple(text[i : i + 64]) for i in order]
    assert suffixes == sorted(suffixes) and sorted(order) == [i for i, x in enumerate(text) if x]

import random

from llm_cases import EDGES, SPACED, documents, prose, words

from millrace.llm import near_dup


def brute(rows, size, percent):
    def shingles(text):
        w = words(text, SPACED)
        return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()

    sets = [(i, shingles(t)) for i, t in rows]
    parent = {i: i for i, _ in rows if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, x in sets:
        for b, y in sets:
            if None not in (a, b) and a < b and x and 100 * len(x & y) >= percent * len(x | y):
                low, high = sorted((find(a), find(b)))
                parent[high] = low
    return sorted(
        ((i, len(s), i if i is None else find(i), i is None or find(i) == i) for i, s in sets), key=repr
    )


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def edited(text, rng, share):
    return " ".join(w if rng.random() > share else f"new{rng.randrange(10**6)}" for w in text.split())


def test_groups_match_brute_force(spark):
    rng = random.Random(5)
    base, other = prose(2, 150), prose(3, 60)
    texts = list(EDGES)
    # Near copies around the threshold, so that some pairs link only through others.
    texts += [edited(base, rng, rng.choice([0.0, 0.01, 0.03, 0.06])) for _ in range(60)]
    texts += [edited(other, rng, 0.02) for _ in range(20)] + [other] * 10
    texts += [base + " " + prose(100 + i, 200) for i in range(15)]  # a shared passage links nothing
    rows = list(enumerate(texts)) + [(3, "one"), (None, base), (None, None)]
    for size in (4, 5):
        got = near_dup.near_duplicates(documents(spark, rows), size=size)
        assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
        assert result(got) == brute(rows, size, 80)


def test_rows_of_one_id_are_one_node(spark):
    rows = [(5, prose(1, 50)), (5, prose(2, 50)), (9, prose(1, 50)), (7, prose(2, 50))]
    got = {(r.doc_id, r.component_id) for r in near_dup.near_duplicates(documents(spark, rows)).collect()}
    assert got == {(5, 5), (9, 5), (7, 5)}


def test_empty_table(spark):
    assert near_dup.near_duplicates(documents(spark, [(1, "x")]).limit(0)).count() == 0


def test_sketch_bound_covers_the_threshold():
    assert near_dup.max_flips(0.8) < near_dup.max_flips(0.5) <= near_dup.SKETCH_BITS

import random

import numpy as np
from llm_cases import EDGES, documents, prose
from test_llm_near_dup import brute, edited, result

from millrace.cluster import checkpointed, narrowed
from millrace.llm import count_tree
from millrace.llm.count_points import Tree, closer_pairs, groups_of, least_overlap, pack, pack_fine, surviving, unpack
from millrace.llm.count_tree import first_shingles, similar_sets
from millrace.llm.near_dup import confirmed_pairs


def test_components_match_brute_force(spark):
    rng = random.Random(8)
    base, other = prose(2, 150), prose(3, 60)
    texts = list(EDGES)
    # Near copies around the threshold: some link only through others, some with none.
    texts += [edited(base, rng, rng.choice([0.0, 0.005, 0.01, 0.02, 0.03])) for _ in range(90)]
    texts += [edited(other, rng, 0.01) for _ in range(40)] + [other] * 10
    texts += [base + " " + prose(100 + i, 200) for i in range(15)]  # a shared passage links nothing
    rows = list(enumerate(texts)) + [(3, "one"), (None, base), (None, None)]
    want = [r[:3] for r in brute(rows, 4, 85)]
    assert 12 < len({r[2] for r in want}) < len(texts) - 40
    for more in ({}, {"page": 16, "many": 0}):  # one page a shard; many pages that hold most pairs back
        got = similar_sets(documents(spark, rows), **more)
        assert got.columns == ["doc_id", "n_shingles", "component_id"]
        assert result(got) == want


def test_rows_of_one_id_and_empty_table(spark):
    rows = [(5, prose(1, 50)), (5, prose(2, 50)), (9, prose(1, 50)), (7, prose(2, 50))]
    assert {(r.doc_id, r.component_id) for r in similar_sets(documents(spark, rows)).collect()} == {(5, 5), (9, 5), (7, 5)}
    assert similar_sets(documents(spark, [(1, "x")]).limit(0)).count() == 0


def test_tree_keeps_every_pair_and_leaves_most_nodes():
    rng = np.random.default_rng(4)
    sets = [set(rng.choice(5000, rng.integers(20, 60), replace=False).tolist()) for _ in range(60)]
    sets += [(s | {9000 + i}) - {min(s)} for i, s in enumerate(sets)] + [s | {9999} for s in sets]
    sets += [set(range(20_000, 20_000 + n)) for n in (900, 950, 2000, 2100)]  # counted in more groups
    blobs = [pack(np.array(sorted(s))) for s in sets]
    sizes = np.array([len(s) for s in sets])
    tree = Tree(blobs, sizes, np.array([0, 100, len(sets)]), [pack_fine(np.array(sorted(s))) for s in sets])
    a, b = (v.ravel() for v in np.meshgrid(np.arange(len(tree.length)), np.arange(len(tree.length))))
    i, j, ratio = surviving(tree, tree, a[a <= b], b[a <= b], 85)
    got = {frozenset(p) for p in zip(tree.rows[i].tolist(), tree.rows[j].tolist(), strict=True)}
    want = {
        frozenset((x, y)) for x in range(len(sets)) for y in range(x) if 100 * len(sets[x] & sets[y]) >= 85 * len(sets[x] | sets[y])
    }
    assert want <= got and len(want) > 60 and len(got) < 3 * len(want) and (ratio >= 1).all()


def test_bounds_are_exact():
    for n in range(1, 300):
        for m in range(n, 300):
            need = int(least_overlap(np.array([n + m]), 85)[0])
            assert 100 * need >= 85 * (n + m - need) and 100 * (need - 1) < 85 * (n + m - need + 1)
            if need <= n:  # two sets that share ``need`` elements: one of the first of each is shared
                assert (n - first_shingles(n, 85)) < need and (m - first_shingles(m, 85)) < need


def test_counts_fold_into_fewer_groups():
    assert [groups_of(n) for n in (0, 1, 128, 129, 256, 257, 5000, 10**7)] == [64, 64, 64, 128, 128, 256, 4096, 4096]
    for values in (np.arange(700) * 3, np.zeros(700, np.int64)):  # the second needs wide counts
        assert unpack(pack_fine(values), 700, 64).tolist() == np.bincount(values & 63, minlength=64).tolist()


def test_points_of_sets_are_written_before_they_are_used(spark, monkeypatch):
    plans = []
    compact = count_tree.compact

    def seen(df, *sizes):
        plans.append((df.columns, df._jdf.queryExecution().optimizedPlan().toString()))
        return compact(df, *sizes)

    monkeypatch.setattr(count_tree, "compact", seen)
    docs = spark.createDataFrame([(i, f"a b c d e f{i // 2}") for i in range(8)], "doc_id long, text string")
    assert len({r.component_id for r in count_tree.similar_sets(docs).collect()}) == 4
    heads = [plan for columns, plan in plans if "keys" in columns]
    assert len(heads) == 1 and "LeftAnti" in heads[0]
    assert not any("LeftAnti" in plan for columns, plan in plans if "key" in columns)


def test_keys_move_once_to_find_shards(spark, monkeypatch):
    plans = []
    compact = count_tree.compact

    def seen(df, *sizes):
        plans.append((df.columns, df._jdf.queryExecution().executedPlan().toString()))
        return compact(df, *sizes)

    monkeypatch.setattr(count_tree, "compact", seen)
    texts = ["a b c d e", "a b c d e f", "a b c d", "v w x y z", "v w x y", "m"]
    docs = spark.createDataFrame([*enumerate(texts), (1, "v w x y z u"), (None, "m")], "doc_id long, text string")
    assert len({r.component_id for r in count_tree.similar_sets(docs, percent=40).where("doc_id < 5").collect()}) == 1
    members = [plan for columns, plan in plans if {"key", "x", "y"} <= {*columns}]
    assert len(members) == 1 and members[0].count("Exchange") == 1 and "Join" not in members[0]
    assert "xxhash64" in members[0][: members[0].index("Exchange")] and "xxhash64" not in members[0][members[0].index("Exchange") :]


def test_only_rows_of_the_pairs_move(spark):
    pairs = checkpointed(spark.createDataFrame([(1, 2), (2, 3)], "a long, b long"))
    points = checkpointed(spark.createDataFrame([(i, 900, pack_fine(np.arange(900) + 10 * i)) for i in range(50)], "id long, n_shingles long, fine binary"))
    closer = closer_pairs(pairs, points, 85)
    assert closer._jdf.queryExecution().optimizedPlan().toString().count("LeftSemi") == 2
    assert sorted(closer.collect()) == [(1, 2), (2, 3)]
    sets = [(i, np.arange(i, i + 20).astype(np.uint64).tobytes()) for i in (1, 2, 3, 3, 4)]
    sets = checkpointed(spark.createDataFrame(sets, "doc_id long, shingles binary"))
    assert sorted(r.doc_id for r in narrowed(sets, "doc_id", pairs.select("b")).collect()) == [2, 3, 3]
    assert sorted(confirmed_pairs(pairs, sets, 85).distinct().collect()) == [(1, 2), (2, 3)]
    assert confirmed_pairs(pairs.where("a = 0"), sets, 85).count() == 0

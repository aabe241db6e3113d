import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from millrace.operators import graph
from millrace.sinks.files import write_separation_report


def edges_of(spark, pairs):
    return spark.createDataFrame(pairs, "actor_id bigint, movie string")


def actors_of(spark, ids):
    return spark.createDataFrame(
        [(i, f"name{i:03d}", "m" if i % 2 == 0 else "f") for i in ids], "actor_id bigint, name string, gender string"
    )


def brute(pairs, seed, limit=6):
    casts, movies = defaultdict(set), defaultdict(set)
    for actor, movie in pairs:
        casts[movie].add(actor)
        movies[actor].add(movie)
    distance, frontier = {seed: 0}, {seed}
    for step in range(1, limit + 1):
        frontier = {b for a in frontier for m in movies[a] for b in casts[m]} - distance.keys()
        distance.update(dict.fromkeys(frontier, step))
    connected = {a for cast in casts.values() if len(cast) > 1 for a in cast}
    return {a: distance.get(a, 100) for a in connected}, casts, movies


def seed(spark, number):
    return spark.createDataFrame([(number,)], "actor_id bigint")


def test_chain_and_loose_ends(spark):
    chain = [(i + d, f"m{i}") for i in range(8) for d in (0, 1)]
    pairs = chain + [(50, "alone"), (60, "x"), (61, "x")]
    got = dict(tuple(r) for r in graph.separation(edges_of(spark, pairs), seed(spark, 0)).collect())
    assert got == {0: 0, 1: 1, 2: 2, 3: 3, 4: 4, 5: 5, 6: 6, 7: 100, 8: 100, 60: 100, 61: 100}


def test_search_matches_brute_force_with_a_hot_movie(spark):
    rng = random.Random(9)
    pairs = list({(rng.randrange(300), f"m{rng.randrange(260)}") for _ in range(420)})
    pairs += [(i, "hot") for i in range(120, 270) if (i, "hot") not in pairs]
    want, casts, movies = brute(pairs, 3)
    edges = edges_of(spark, pairs)
    got = dict(tuple(r) for r in graph.separation(edges, seed(spark, 3)).collect())
    assert got == want
    sizes = {r.movie: (r.cast_size, r.pairs) for r in graph.movie_casts(edges).collect()}
    assert sizes == {m: (len(c), len(c) * (len(c) - 1)) for m, c in casts.items()}
    entries = {r.actor_id: r.neighbour_entries for r in graph.adjacency_sizes(edges).collect()}
    counted = {a: sum(len(casts[m]) - 1 for m in ms) for a, ms in movies.items()}
    assert entries == {a: n for a, n in counted.items() if n}
    near = {r.actor_id for r in graph.coactors(edges, seed(spark, 3)).collect()}
    assert near == {b for m in movies[3] for b in casts[m]} - {3}


def test_repeated_edges_do_not_count_twice(spark):
    edges = edges_of(spark, [(1, "m"), (1, "m"), (2, "m")])
    assert [tuple(r) for r in graph.movie_casts(edges).collect()] == [("m", 2, 2)]


def test_seed_must_exist(spark):
    actors = actors_of(spark, [1, 2])
    assert graph.seed_lookup(actors, "name002").first().actor_id == 2
    with pytest.raises(Exception, match="no actor is named"):
        graph.seed_lookup(actors, "nobody").collect()


def test_ids_are_dense_and_signed(spark):
    men = spark.createDataFrame([("b", "m"), ("a", "m")], "actor string, gender string")
    women = spark.createDataFrame([("c", "f"), ("a", "f")], "actor string, gender string")
    got = sorted(tuple(r) for r in graph.actor_ids(graph.actors_union(men, women)).collect())
    assert got == [("a", "f", 0, -1), ("a", "m", 1, 1), ("b", "m", 2, 2), ("c", "f", 3, -4)]


def test_report(spark, tmp_path):
    chain = [(i + d, f"m{i}") for i in range(8) for d in (0, 1)]
    edges, actors = edges_of(spark, chain), actors_of(spark, range(9))
    distances = graph.separation(edges, seed(spark, 0))
    counts = [tuple(r) for r in graph.separation_counts(distances, actors).orderBy("distance").collect()]
    assert counts == [(1, 0, 1, 1, 1), (2, 1, 0, 1, 2), (3, 0, 1, 1, 3), (4, 1, 0, 1, 4), (5, 0, 1, 1, 5), (6, 1, 0, 1, 6)]
    report = graph.separation_report(distances, actors, edges)
    path = str(tmp_path / "report")
    write_separation_report(report, path)
    lines = [r.line for r in report.orderBy("section", "line_no").collect()]
    assert lines[:2] == [
        "Total number of actors = 9, out of which 5 (55%) are males while 4 (44%) are females.",
        "Total number of movies = 8",
    ]
    assert lines[2] == "There are 0 (0.0%) actors and 1 (25.0%) actresses at distance 1"
    assert lines[8:11] == [
        "Total number of actors from distance 1 to 6 = 6, ratio = 0.6666667",
        "Total number of male actors from distance 1 to 6 = 3, ratio = 0.6",
        "Total number of female actors (actresses) from distance 1 to 6 = 3, ratio = 0.75",
    ]
    assert lines[11:] == ["List of male actors at distance 6:", "1. name006", "List of female actors (actresses) at distance 6:"]
    assert sorted(r.value for r in spark.read.text(path).collect()) == sorted(lines)


def test_explode_drops_repeats(spark):
    people = spark.createDataFrame([(1, ["a", "b", "a"]), (2, ["a"])], "actor_id bigint, movies array<string>")
    assert graph.movie_edges(people).where(F.col("movie") == "a").count() == 2


def test_graph_of_lists(spark):
    rows = [("b", "m", ["x"]), ("b", "m", ["x", "y"]), ("b", "f", ["y"]), ("a", "f", ["z"])]
    actors, edges = graph.graph_of_lists(spark.createDataFrame(rows, "actor string, gender string, movies array<string>"))
    assert sorted(tuple(r) for r in actors.collect()) == [(0, "a", "f"), (1, "b", "f"), (2, "b", "m")]
    assert sorted(tuple(r) for r in edges.collect()) == [(0, "z"), (1, "y"), (2, "x"), (2, "y")]


def test_hot_movie_is_split(spark):
    # Half of the edges in one movie; without broadcasts, AQE must cut the join of that movie.
    pairs = [(i, "hot") for i in range(20_000)] + [(i, f"m{i % 5000}") for i in range(20_000)]
    keys = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in keys}
    from millrace import cluster

    limit, cluster.BROADCAST_ROWS = cluster.BROADCAST_ROWS, -1
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        edges = cluster.checkpointed(spark.createDataFrame(pairs, "actor_id bigint, movie string").repartition(8))
        sizes = graph.adjacency_sizes(edges)
        assert sizes.count() == 20_000
        sizes.collect()
        assert "skew=true" in sizes._jdf.queryExecution().executedPlan().toString()
    finally:
        cluster.BROADCAST_ROWS = limit
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_neighbours_exact_and_by_sketch(spark):
    rng = random.Random(12)
    rows = [(rng.randrange(3000), f"m{rng.randrange(60)}") for _ in range(6000)]
    rows += rows[:200] + [(9001, "alone"), (9002, "pair"), (9003, "pair")]
    casts = {}
    for actor, movie in rows:
        casts.setdefault(movie, set()).add(actor)
    near = {}
    for actor, movie in rows:
        near.setdefault(actor, set()).update(casts[movie] - {actor})
    want = {a: len(n) for a, n in near.items() if n}
    edges = spark.createDataFrame(rows, "actor_id long, movie string")
    got = {r.actor_id: (r.neighbours, r.exact) for r in graph.neighbour_counts(edges).collect()}
    assert got == {a: (n, True) for a, n in want.items()}
    got = {r.actor_id: (r.neighbours, r.exact) for r in graph.neighbour_counts(edges, exact_entries=1).collect()}
    assert got.keys() == want.keys() and got[9002] == (1, True)
    assert all(abs(n - want[a]) <= 0.03 * want[a] for a, (n, _) in got.items())
    assert sum(not exact for _, exact in got.values()) > 2000
    assert graph.neighbour_counts(edges.limit(0)).count() == 0


def test_rounds_leave_the_edges_where_they_lie(spark):
    # One movie and one person with more edges than a slot takes; without broadcasts only frontiers are exchanged.
    rng = random.Random(4)
    pairs = {(i, "hot") for i in range(100)} | {(7, f"m{i}") for i in range(200)}
    pairs |= {(rng.randrange(400), f"m{rng.randrange(300)}") for _ in range(500)}
    pairs |= {(1000 + i + d, f"line{i}") for i in range(5) for d in (0, 1)}
    from millrace import cluster

    limit, cluster.BROADCAST_ROWS = cluster.BROADCAST_ROWS, -1
    old = {k: spark.conf.get(k, None) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    try:
        for k in old:
            spark.conf.set(k, "-1")
        layout = graph.laid_out(edges_of(spark, sorted(pairs)), slot_edges=50)
        assert layout.wide_movies.where("movie = 'hot'").first()._slots == 2
        assert layout.wide_actors.where("actor_id = 7").first()._slots >= 3
        assert layout.by_movie.where("movie = 'hot'").select("_slot").distinct().count() == 2
        frontier = cluster.checkpointed(graph._slots(seed(spark, 3), layout.wide_actors))
        taken = graph.step(layout, frontier)
        taken.collect()
        plan = taken._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        # Between a bucketed scan and the join above it stand only a sort, a filter and columns.
        lines = plan.splitlines()
        scans = [i for i, line in enumerate(lines) if "Bucketed: true" in line]
        assert len(scans) == 2
        for i in scans:
            above = i
            while "Join" not in lines[above]:
                assert "Exchange" not in lines[above] and "ShuffleQueryStage" not in lines[above], plan
                above -= 1
        want, _, _ = brute(pairs, 3)
        found = {r.actor_id: r.distance for r in graph.search(layout, seed(spark, 3)).collect()}
        assert found == {a: d for a, d in want.items() if d < 100}
        assert {r.actor_id for r in graph.connected_actors(layout).collect()} == set(want)
    finally:
        cluster.BROADCAST_ROWS = limit
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)

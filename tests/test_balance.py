import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import balance


def assign(spark, weights, tasks):
    df = spark.createDataFrame(list(weights.items()), "key int, n bigint")
    return balance.region_assignment(df, tasks)


def brute(weights, tasks):
    loads, out = [0] * tasks, {}
    for n, key in sorted(((n, k) for k, n in weights.items()), reverse=True):
        task = loads.index(min(loads))
        loads[task] += n
        out[key] = task
    return out


@pytest.mark.parametrize("tasks", [1, 2, 7, 30])
def test_greedy_order(spark, tasks):
    rng = random.Random(tasks)
    weights = {k: rng.choice([1, 5, 5, 9, 40]) for k in range(20)}
    assert {r.key: r.task for r in assign(spark, weights, tasks).collect()} == brute(weights, tasks)


def test_small_example(spark):
    # a=1 b=2 c=3 d=4 with 5, 3, 3, 2 on two tasks
    assert {r.key: r.task for r in assign(spark, {1: 5, 2: 3, 3: 3, 4: 2}, 2).collect()} == {1: 0, 4: 0, 3: 1, 2: 1}


def test_heavy_task_is_cut(spark):
    rows = spark.range(4000).select(
        F.when(F.col("id") < 3500, 1).otherwise(2).cast("int").alias("key"), F.col("id").alias("pos")
    )
    routed = balance.balanced_repartition(rows, "key", assign(spark, {1: 3500, 2: 500}, 2), ["pos"])
    assert routed.count() == 4000
    assert {tuple(r) for r in routed.select("key", "task").distinct().collect()} == {(1, 0), (2, 1)}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        heavy = routed.where("task = 0").select(F.spark_partition_id().alias("p")).distinct().count()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert heavy > 1


def test_depth_matches_brute_force(spark):
    rng = random.Random(2)
    items = [(rng.randrange(1, 3), s, s + rng.choice([-1, 0, 9, 200])) for s in (rng.randrange(1, 500) for _ in range(120))]
    items += [(1, 77, 80)] * 500
    depth = {}
    for ref, start, end in items:
        for x in range(start, end + 1):
            depth[ref, x] = depth.get((ref, x), 0) + 1
    want = {
        ref: (sum(r == ref for r, _ in depth), max(d for (r, _), d in depth.items() if r == ref)) for ref in (1, 2)
    }
    reads = spark.createDataFrame(items, "ref_index int, pos int, `end` int")
    for width in (16, 1 << 14):
        got = {r.ref_index: (r.covered, r.max_depth) for r in balance.region_depth(reads, width).collect()}
        assert got == want


def test_user_function_sees_batches(spark):
    import pandas as pd

    def count(batches):
        total, ref = 0, None
        for batch in batches:
            total += len(batch)
            ref = int(batch["ref_index"].iloc[0])
        yield pd.DataFrame({"ref_index": [ref], "n": [total]})

    reads = spark.createDataFrame([(1, 5, 9), (1, 6, 7), (2, 1, 1)], "ref_index int, pos int, `end` int")
    got = balance.grouped_region_apply(reads, count, "ref_index int, n bigint", tile_width=100)
    assert {tuple(r) for r in got.collect()} == {(1, 2), (2, 1)}


def test_many_regions(spark):
    rng = random.Random(3)
    weights = {k: rng.randrange(1, 1000) for k in range(50_000)}
    assert {r.key: r.task for r in assign(spark, weights, 64).collect()} == brute(weights, 64)


def test_partitions_hold_one_task_each(spark):
    # One key holds a third of all rows; four tasks, forty partitions.
    sizes = {0: 20_000, **{k: 1_000 + 97 * k for k in range(1, 21)}}
    rows = spark.createDataFrame([(k, i) for k, n in sizes.items() for i in range(n)] + [(99, 0), (None, 1)], "key int, i int")
    weights = spark.createDataFrame(list(sizes.items()), "key int, n bigint")
    assignment = balance.region_assignment(weights, 4)
    placed = balance.placed_by_task(rows, "key", assignment, 40, ["i", "key"])
    held = placed.groupBy(F.spark_partition_id().alias("at"), "task").agg(F.count("*").alias("n")).collect()
    assert len({r.at for r in held}) == len(held)
    counts = [r.n for r in held]
    assert sum(counts) == sum(sizes.values())
    assert max(counts) <= 1.2 * sum(counts) / len(counts)
    tasks = {r.key: r.task for r in assignment.collect()}
    assert {(r.key, r.task) for r in placed.select("key", "task").distinct().collect()} == set(tasks.items())
    assert balance.placed_by_task(rows, "key", assignment.limit(0), 4).count() == 0

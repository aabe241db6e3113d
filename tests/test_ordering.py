import random

from pyspark.sql import functions as F

from millrace import cluster
from millrace.cluster import broadcast_if_small, shared_path
from millrace.operators.ordering import with_ordinal


def test_global_and_group_numbers(spark):
    rng = random.Random(5)
    # One group holds most rows.
    data = [("hot" if rng.random() < 0.8 else f"g{rng.randrange(5)}", rng.randrange(10**6), n) for n in range(2000)]
    df = spark.createDataFrame(data, "g string, v int, n int").repartition(7)
    ordered = sorted(data)
    got = {(r.g, r.v, r.n): r.ordinal for r in with_ordinal(df, ["g", "v", "n"]).collect()}
    assert got == {row: i for i, row in enumerate(ordered)}
    first = {}
    for i, row in enumerate(ordered):
        first.setdefault(row[0], i)
    within = {(r.g, r.v, r.n): r.ordinal for r in with_ordinal(df, ["g", "v", "n"], within=["g"]).collect()}
    assert within == {row: i - first[row[0]] for i, row in enumerate(ordered)}


def test_broadcast_needs_a_bound(spark):
    df = spark.range(10)
    hinted = lambda limit: "ResolvedHint" in broadcast_if_small(df, limit)._jdf.queryExecution().analyzed().toString()
    assert hinted(10) and not hinted(9)


def test_shared_folder_comes_from_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is not None:
        assert shared_path(spark, "x").startswith(root.rstrip("/"))


def test_shared_tables_can_be_dropped(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(cluster, "shared_root", lambda session: str(tmp_path))
    spark.range(3).write.parquet(cluster.shared_path(spark, "x"))
    cluster.drop_shared(spark)
    assert not list((tmp_path / "millrace").iterdir())


def test_shuffle_files_go_with_the_job_that_wrote_them(spark, monkeypatch):
    seen, key = [], cluster.FILE_CLEANUP
    root = cluster.shared_path
    monkeypatch.setattr(cluster, "shared_path", lambda *a: seen.append(None) or root(*a))
    before = spark.conf.get(key)
    held = spark.range(10).withColumn("on", F.lit(1)).repartition(3, "id")
    write = type(held).write.fget
    monkeypatch.setattr(type(held), "write", property(lambda self: seen.append(spark.conf.get(key)) or write(self)))
    assert cluster.checkpointed(held).count() == 10
    assert seen == [None, "true"] and spark.conf.get(key) == before

import random

from pyspark.sql import functions as F

from millrace.operators import intervals
from millrace.operators import reads as ops
from millrace.plans import tables
from millrace.sinks.files import write_reads

SCHEMA = "qname string, flag int, rname string, ref_index int, pos int, mapq int, cigar string, rnext string, pnext int, tlen int, seq string, qual string"


def read(qname, flag=0, ref=1, pos=10, cigar="10M", pnext=0, qual="I" * 10, rnext="="):
    return (qname, flag, f"chr{ref}", ref, pos, 60, cigar, rnext, pnext, 0, "*", qual)


def frame(spark, items):
    return spark.createDataFrame(items, SCHEMA)


def test_mapped_reads(spark):
    items = [read("a", ref=0), read("b", ref=24), read("c", ref=25), read("d", flag=4), read("e", ref=23), read("f", ref=None)]
    assert {r.qname for r in ops.mapped_reads(frame(spark, items)).collect()} == {"b", "e"}


def test_clean_reads(spark):
    lengths = spark.createDataFrame([(1, "chr1", 15)], "ref_index int, name string, length int")
    items = [read("fits", pos=6), read("over", pos=10), read("lost", flag=4, pos=10), read("beyond", pos=16)]
    got = {r.qname: (r.cigar, r.mapq, r.was_clipped) for r in ops.clean_reads(frame(spark, items), lengths).collect()}
    assert got == {
        "fits": ("10M", 60, False),
        "over": ("6M4S", 60, True),
        "lost": ("10M", 0, False),
        "beyond": ("10M", 60, False),
    }


def five_prime(item):
    span = {"10M": 10, "2S8M": 8, "8M2S": 8}[item[6]]
    if item[1] & 16:
        return item[4] + span - 1 + (2 if item[6] == "8M2S" else 0)
    return item[4] - (2 if item[6] == "2S8M" else 0)


def test_duplicates_match_brute_force(spark):
    rng = random.Random(11)
    items = [
        read(
            f"q{rng.randrange(400)}",
            flag=rng.choice([0, 16]),
            ref=rng.randrange(1, 4),
            pos=rng.randrange(10, 30),
            cigar=rng.choice(["10M", "2S8M", "8M2S"]),
            pnext=rng.choice([0, 1, None]),
            qual=rng.choice("/0AI") * 10,
        )
        for _ in range(600)
    ]
    items += [read(f"hot{i % 90}", ref=5, qual="I" * 10) for i in range(400)]  # one key, many copies
    groups = {}
    for item in items:
        key = (item[3], bool(item[1] & 16), five_prime(item), item[7], item[8])
        groups.setdefault(key, []).append(item)
    score = lambda x: sum(ord(c) - 33 for c in x[11] if ord(c) - 33 >= 15)
    want = []
    for group in groups.values():
        best = min(group, key=lambda x: (-score(x), x[0], repr(x[1:])))
        want += [(best[0], best[3], False)] + [(x[0], x[3], True) for x in group]
        want.remove((best[0], best[3], True))
    marked = ops.mark_duplicates(frame(spark, items).repartition(6))
    got = [(r.qname, r.ref_index, r.is_duplicate) for r in marked.collect()]
    assert sorted(got) == sorted(want)


def test_reads_without_position_are_no_duplicates(spark):
    items = [read("a", pos=None), read("b", pos=None), read("c"), read("d")]
    marked = ops.mark_duplicates(frame(spark, items)).collect()
    assert {r.qname: r.is_duplicate for r in marked} == {"a": False, "b": False, "c": False, "d": True}


def test_metrics(spark):
    items = [read("a"), read("b"), read("c", pos=99)]
    metrics = ops.duplicate_metrics(ops.read_group_tag(ops.mark_duplicates(frame(spark, items))))
    assert [tuple(r) for r in metrics.collect()] == [("LIB1", 3, 1, 0.333333)]


def test_guessing_sorts_no_quality_lists(spark, monkeypatch):
    rows = [(1, 1, None, "b", [61]), (1, 1, None, "a", None), (1, 1, 2, "a", [3]), (2, 2, 1, "x", []), (None, None, 1, "y", [5])]
    df = spark.createDataFrame(rows, "region int, ref_index int, pos int, qname string, quals array<int>")
    plans, small_side = [], ops.small_side
    monkeypatch.setattr(ops, "small_side", lambda side: plans.append(side._jdf.queryExecution().executedPlan().toString()) or small_side(side))
    got = sorted((r.region, r.qname, r.encoding) for r in ops.quality_encoding(df).collect())
    assert got == [(1, "a", "ILLUMINA"), (1, "a", "ILLUMINA"), (1, "b", "ILLUMINA"), (2, "x", "ILLUMINA")]
    sort = plans[0].index("Sort [")
    assert "quals" not in plans[0][:sort] and "Generate" in plans[0][sort:]


def test_reads_are_not_moved_to_find_their_sequences(spark, tmp_path):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "16")
    try:
        supplier = spark.range(60).select(F.col("id").alias("s_suppkey"))
        supplier.write.parquet(f"{tmp_path}/supplier.parquet")
        line = "id AS l_orderkey, 1 AS l_linenumber, id AS l_partkey, id AS l_suppkey, 3.0D AS l_quantity, 'N' AS l_returnflag, 'O' AS l_linestatus"
        lines = spark.range(300).selectExpr(*line.split(", "), "timestamp '1996-01-01 00:00:00' AS l_shipdate")
        lines.write.parquet(f"{tmp_path}/lineitem.parquet")
        reads = tables.reads(spark, str(tmp_path))
        assert "SortMergeJoin" not in reads._jdf.queryExecution().executedPlan().toString()
        assert {(r.l, r.ref_index) for r in reads.select(F.expr("split(qname, ':')[1] % 26").cast("int").alias("l"), "ref_index").collect()} == {(i, i) for i in range(26)}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_quality_encoding(spark):
    items = [
        (1, 1, 5, "late", [70, 30]),
        (1, 1, 2, "first", [60, 10]),
        (2, 2, 1, "first", [61, 31]),
        (2, 2, 2, "bad", [50, 30]),
    ]
    df = spark.createDataFrame(items, "region int, ref_index int, pos int, qname string, quals array<int>")
    got = {(r.region, r.qname): (r.encoding, r.phred, r.rejected) for r in ops.quality_encoding(df).collect()}
    assert got == {
        (1, "late"): ("SANGER", [70, 30], False),
        (1, "first"): ("SANGER", [60, 10], False),
        (2, "first"): ("ILLUMINA", [30, 0], False),
        (2, "bad"): ("ILLUMINA", [19, -1], True),
    }


def test_sorted_sink_splits_a_hot_region(spark, tmp_path):
    items = [read(f"q{i:04d}", ref=7, pos=10) for i in range(2000)] + [read("x", ref=2, pos=3)]
    path = str(tmp_path / "reads")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tasks = ops.coordinate_sort(frame(spark, items)).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(r["count"] for r in tasks) == 2001 and max(r["count"] for r in tasks) < 1500
    write_reads(frame(spark, items), path)
    keys = [
        tuple(r)
        for r in spark.read.parquet(path)
        .select(F.element_at(F.split(F.input_file_name(), "/"), -1), "ref_index", "pos", "qname")
        .collect()
    ]
    assert [k[1:] for k in sorted(keys)] == sorted(k[1:] for k in keys)
    files = {}
    for name, *key in keys:
        files.setdefault(name, []).append(key)
    assert all(part == sorted(part) for part in files.values())


def test_region_counts_and_rows(spark):
    items = [read("a"), read("b"), read("c", ref=2)]
    assert {tuple(r) for r in ops.region_counts(frame(spark, items)).collect()} == {(1, 2), (2, 1)}
    assert {(r.region, r.qname) for r in ops.reads_by_region(frame(spark, items)).collect()} == {(1, "a"), (1, "b"), (2, "c")}


def test_scanned_qualities_to_covered_stretches(spark):
    text = lambda *values: "".join(chr(v + 33) for v in values)
    rows = [
        ("a", 0, "chr1", 1, 100, "5M", "*"),  # first, but without qualities: not asked for the encoding
        ("b", 0, "chr1", 1, 110, "5M", text(70, 65)),
        ("c", 0, "chr1", 1, 150, "5M", text(20, 70)),
        ("d", 0, "chr1", 1, None, "5M", None),
        ("e", 0, "chr2", 2, 10, "5M", text(30, 40)),
        ("f", 0, "chr2", 2, 66, "5M", text(60)),
        ("g", 0, "chr2", 2, 200, "*", text(60)),
        ("h", 0, "?", None, 10, "5M", text(1)),
    ]
    reads = spark.createDataFrame(rows, "qname string, flag int, rname string, ref_index int, pos int, cigar string, qual string")
    mended = ops.mended_qualities(reads)
    got = {r.qname: (r.phred, r.rejected) for r in mended.collect()}
    assert got == {
        "a": ([], False),
        "b": ([39, 34], False),
        "c": ([-11, 39], True),
        "d": ([], False),
        "e": ([30, 40], False),
        "f": ([60], False),
        "g": ([60], False),
    }
    covered = intervals.covered_intervals(ops.covering_extents(mended.where("NOT rejected")))
    found = sorted((r.chrom, r.start, r.end, r.members) for r in covered.collect())
    assert found == [("chr1", 100, 114, 2), ("chr2", 10, 14, 1), ("chr2", 66, 70, 1)]

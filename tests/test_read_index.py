import random

from pyspark.sql import functions as F

from millrace.sinks.files import write_reads
from millrace.sources.read_index import reads_in_region, write_read_index

SCHEMA = "qname string, flag int, ref_index int, pos int, cigar string"


def test_region_lookup_opens_only_the_files_it_needs(spark, tmp_path):
    rng = random.Random(5)
    cigars = [(f"{n}M", n) for n in (10, 50, 100)] + [("20M30000N20M", 30_040), ("*", 1)]
    rows, spans = [], {}
    for i in range(3000):
        cigar, span = rng.choice(cigars)
        ref, pos = rng.randrange(1, 4), rng.randrange(1, 400_000)
        rows.append((f"r{i}", 0, ref, pos, cigar))
        spans[f"r{i}"] = (ref, pos, pos + span - 1)
    rows += [("lost", 4, None, None, "*"), ("unplaced", 4, 1, None, "*")]
    path, index = str(tmp_path / "reads"), str(tmp_path / "index")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_reads(spark.createDataFrame(rows, SCHEMA).repartition(4), path)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    write_read_index(spark, path, index)
    everything = spark.read.parquet(path).inputFiles()
    assert len(everything) > 2
    for ref, start, end in ((2, 100_000, 100_400), (1, 1, 400_000), (3, 16_383, 16_384), (3, 500_000, 600_000), (9, 1, 10)):
        found = reads_in_region(spark, path, index, ref, start, end)
        want = sorted(n for n, (r, lo, hi) in spans.items() if r == ref and lo <= end and hi >= start)
        assert sorted(r.qname for r in found.collect()) == want
        assert found.columns == ["qname", "flag", "ref_index", "pos", "cigar"]
    few = reads_in_region(spark, path, index, 1, 300_000, 300_010).where(F.col("flag") == 0)
    assert 0 < len(few.inputFiles()) < len(everything)


def test_no_reads(spark, tmp_path):
    path, index = str(tmp_path / "reads"), str(tmp_path / "index")
    write_reads(spark.createDataFrame([], SCHEMA), path)
    write_read_index(spark, path, index)
    assert reads_in_region(spark, path, index, 1, 1, 100).count() == 0

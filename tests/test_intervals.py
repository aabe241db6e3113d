import random

import pytest
from pyspark.sql import functions as F

from millrace import cluster
from millrace.operators import intervals
from millrace.sinks.files import write_bed, write_regions


def frame(spark, items):
    return spark.createDataFrame(items, "chrom string, start int, `end` int")


def brute_merge(items, gap):
    out, names = [], {}
    for chrom, start, end in sorted(items, key=lambda x: (x[0], x[1], x[2])):
        if out and out[-1][0] == chrom and start <= out[-1][2] + gap:
            out[-1][2] = max(out[-1][2], end)
            out[-1][3] += 1
        else:
            out.append([chrom, start, end, 1])
    return sorted(map(tuple, out))


def random_items(seed, hot):
    rng = random.Random(seed)
    items = [(rng.choice("abc"), s, s + rng.randrange(30)) for s in (rng.randrange(1, 3000) for _ in range(150))]
    items += [("a", s, s + rng.choice([0, 5, 900])) for s in (rng.randrange(1, 3000) for _ in range(20))]
    return items + ([("b", 500, 510)] * 300 if hot else [])


@pytest.mark.parametrize("bin_width", [4, 64, 1 << 16])
@pytest.mark.parametrize("gap", [-1, 0, 5])
def test_merge_matches_brute_force(spark, rows, bin_width, gap):
    items = random_items(bin_width + gap, hot=gap == 5)
    got = rows(intervals.merge_intervals(frame(spark, items), gap, bin_width=bin_width), "chrom", "start", "end", "members")
    assert got == sorted(brute_merge(items, gap), key=repr)


def test_read_gap_of_51_joins_and_52_parts(spark, rows):
    reads = spark.createDataFrame(
        [(1, "chr1", 1, 10), (1, "chr1", 61, 70), (1, "chr1", 122, 130), (2, "chr2", 5, 5)],
        "ref_index int, chrom string, start int, `end` int",
    )
    got = rows(intervals.covered_intervals(reads), "chrom", "start", "end")
    # The last read and the last interval are kept, single reads too.
    assert got == [("chr1", 1, 70), ("chr1", 122, 130), ("chr2", 5, 5)]


def test_padding(spark, rows):
    got = rows(
        intervals.padded_intervals(
            frame(spark, [("chr1", 3, 10), ("CHR1", 14, 20), ("chr1", 25, 30), ("chr2", 100, 110)]), 5
        )
    )
    # 14-5 < 10 merges, 25-5 < 20 does not; starts never fall below 1.
    assert got == [("chr1", 1, 20), ("chr1", 20, 30), ("chr2", 95, 110)]


@pytest.mark.parametrize("base_bits", [2, 5, 14])
def test_intersect_matches_brute_force(spark, rows, base_bits):
    rng = random.Random(base_bits)
    covered = [(c, s - 1, e) for c, s, e, _ in brute_merge(random_items(3, hot=False), 0)]
    targets = [
        (rng.choice("abc"), s, s + rng.choice([1, 7, 40, 2500, 3_000_000]), f"t{i}")
        for i, s in enumerate(rng.randrange(0, 3000) for _ in range(200))
    ]
    targets += [("b", 100, 100, "empty"), ("a", covered[0][2], covered[0][2] + 1, "touching")]
    targets += [("b", 500, 520, f"hot{i}") for i in range(100)]
    want = sorted(
        (
            (c, max(s, cs), min(e, ce), name)
            for c, s, e, name in targets
            for cc, cs, ce in covered
            if c == cc and max(s, cs) < min(e, ce)
        ),
        key=repr,
    )
    df = spark.createDataFrame(targets, "chrom string, start int, `end` int, name string")
    assert rows(intervals.interval_intersect(df, frame(spark, covered), base_bits=base_bits)) == want


def test_text_forms(spark, tmp_path):
    one = frame(spark, [("chr1", 11, 20)])
    for offset, want in ((0, "chr1\t10\t20"), (-1, "chr1\t10\t19")):
        path = str(tmp_path / f"bed{offset}")
        write_bed(one, path, offset)
        assert [r.value for r in spark.read.text(path).collect()] == [want]
    write_regions(one, str(tmp_path / "regions"))
    assert [r.value for r in spark.read.text(str(tmp_path / "regions")).collect()] == ["chr1:11-20"]


def test_shuffles_of_a_merge_grow_with_the_input(spark, rows, monkeypatch, tmp_path):
    path = str(tmp_path / "intervals")
    starts = F.col("id") * 3
    spark.range(2000).select(F.lit("a").alias("chrom"), starts.alias("start"), (starts + 2).alias("end")).write.parquet(path)
    monkeypatch.setattr(cluster, "TASK_BYTES", 1 << 10)
    seen = []
    write = intervals.checkpointed
    partitions = lambda: int(spark.conf.get("spark.sql.shuffle.partitions"))
    monkeypatch.setattr(intervals, "checkpointed", lambda df: seen.append(partitions()) or write(df))
    before = partitions()
    merged = intervals.merge_intervals(spark.read.parquet(path), 0, bin_width=64)
    assert len(seen) == 2 and min(seen) > 2 * before and partitions() == before
    assert rows(merged) == [("a", 3 * i, 3 * i + 2, 1) for i in sorted(range(2000), key=lambda i: repr(("a", 3 * i)))]

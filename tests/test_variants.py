import glob
import random

from millrace.operators import variants
from millrace.sinks.files import write_variants, write_variants_by_region
from millrace.sources.genome import parse_vcf


def lines_of(spark, items):
    return spark.createDataFrame([(f"{c}\t{p}\t.\t{r}\t{a}",) for c, p, r, a in items], "value string")


def sample():
    rng = random.Random(4)
    names = ["chr1", "chr2", "chr10", "chrX", "chrY", "chrM"]
    return [(rng.choice(names), rng.randrange(1, 500), rng.choice("AC"), rng.choice("GT")) for _ in range(500)]


def number(name):
    return {"chrX": 23, "chrY": 24, "chrM": 0}.get(name) or (0 if name == "chrM" else int(name[3:]) if name[3:].isdigit() else 0)


def text_of(folder):
    return [line for path in sorted(glob.glob(f"{folder}/part-*")) for line in open(path).read().splitlines()]


def test_file_order_is_global_order(spark, tmp_path):
    items = sample()
    parsed = parse_vcf(lines_of(spark, items).repartition(5))
    write_variants(parsed, str(tmp_path / "all"))
    want = sorted((number(c), p, f"{c}\t{p}\t.\t{r}\t{a}") for c, p, r, a in items if c != "chrM")
    assert text_of(tmp_path / "all") == [line for *_, line in want]
    write_variants_by_region(parsed, str(tmp_path / "regions"))
    for chrom in {n for n, *_ in want}:
        assert text_of(tmp_path / "regions" / f"region={chrom}") == [line for n, _, line in want if n == chrom]


def test_compare(spark):
    left = parse_vcf(lines_of(spark, [("chr1", 1, "A", "C"), ("chr1", 1, "A", "C"), ("chr1", 2, "A", "C"), ("chrX", 1, "A", "C")]))
    right = parse_vcf(lines_of(spark, [("chr1", 1, "A", "C"), ("chrX", 1, "A", "C"), ("chr9", 9, "A", "C"), ("chr1", 2, "A", "G")]))
    assert tuple(variants.compare_variants(left, right).first()) == (3, 2, 1)

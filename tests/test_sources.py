import random

import pytest
from pyspark.sql import functions as F

from millrace.sources import fastq, filmography, genome
from millrace.sources.lines import numbered_lines
from millrace.sources.pageviews import scan_pageviews
from millrace.sources.retweet_log import LOG_HEADER, scan_retweet_log


def write(tmp_path, text, name="in.txt"):
    path = tmp_path / name
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_pageviews_keep_quotes(spark, rows, tmp_path):
    path = write(tmp_path, 'en "Q" 3 10\nde.m x 4\n')
    assert rows(scan_pageviews(spark, path)) == [("de.m", "x", 4, None), ("en", '"Q"', 3, 10)]


def test_pageviews_bad_count_is_an_error(spark, tmp_path):
    with pytest.raises(Exception):
        scan_pageviews(spark, write(tmp_path, "en x many 1\n")).collect()


def test_retweet_log_rows(spark, rows, tmp_path):
    body = "(60),English,en,9,1,5,2,3,hello\n(60),English,en,9,2,5,2,3,a,b\n(60),English,en,9,3,5,2,3,\n(60),x,en,9,4,5,2,3\n"
    got = rows(scan_retweet_log(spark, write(tmp_path, LOG_HEADER + "\n" + body)), "seconds", "id", "count", "text")
    assert got == [("(60)", 1, 3, "hello"), ("(60)", 2, 3, "a")]


FILMS = (
    "Ann\tNew (2012)  <1>\n\t\t\tOld (2010)\n\t\t\tSame (2011/I) x\n"
    "\n"
    'Bob\t"Series" (2015)\n\t\t\tNone (????)\n'
    "\n"
    "Cid\tFoo (Bar) (2012)\n\t\t\tNo bracket\n\t\t\t2013) odd\n\t\t\tFive (20111)\n\t\t\tNew (2012) again\n"
    "\n\n"
)


def test_filmography(spark, rows, tmp_path):
    blocks = filmography.scan_blocks(spark, write(tmp_path, FILMS))
    assert blocks.count() == 3
    got = rows(filmography.parse_filmography(blocks, "f"), "actor", "gender", F.array_join("movies", "|"))
    assert got == [("Ann", "f", "New (2012)|Same (2011/I)"), ("Cid", "f", "2013)|Five (20111)|New (2012)")]


def test_titles_are_parsed_once(spark, rows, tmp_path):
    blocks = filmography.scan_blocks(spark, write(tmp_path, FILMS + 'Dan\t"(2012)\n\t\t\t(+201) a\n\t\t\t( 201) b\n\t\t\tx) (2012)\n\n'))
    parsed = filmography.parse_filmography(blocks, "m", 200)
    plan = parsed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1 and plan.count("slice(") == 1
    kept = dict(rows(parsed, "actor", F.array_join("movies", "|")))
    assert kept == {"Ann": "New (2012)|Old (2010)|Same (2011/I)", "Cid": "2013)|Five (20111)|New (2012)", "Dan": "(+201)"}


def test_section_extract_per_file(spark, rows, tmp_path):
    write(tmp_path, "intro\n---- early\nName\t\tTitles\n----\t---\na\n\nName Titles\nb\n-----\ntail\n", "one.list")
    write(tmp_path, "nothing here\n", "two.list")
    write(tmp_path, " Name Titles\n---\nc\nd", "three.list")
    got = filmography.section_extract(spark, str(tmp_path))
    name = F.element_at(F.split("file", "/"), -1)
    assert rows(got, name, "line_no", "value") == [
        ("one.list", 4, "a"),
        ("one.list", 5, ""),
        ("one.list", 6, "Name Titles"),
        ("one.list", 7, "b"),
        ("three.list", 2, "c"),
        ("three.list", 3, "d"),
    ]


def test_section_limits_in_different_splits(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(filmography, "NOTED_LINES", 16)
    rng = random.Random(3)
    want = {}
    for n in range(4):
        # The title may end one split and the rule below it begin the next.
        head = [f"--- early {i}" + "x" * rng.randrange(60) for i in range(40 + n)]
        body = [f"{n}: {i}" + "y" * rng.randrange(80) for i in range(300)]
        tail = ["----", *(f"---- after {i}" for i in range(120)), "Name Titles", "lost"]
        lines = [*head, "Name\t\tTitles", "----\t------", *body, *(tail if n else [])]
        write(tmp_path, "\n".join(lines) + "\n", f"{n}.list")
        want |= {(f"{n}.list", len(head) + 2 + i): line for i, line in enumerate(body)}
    keep = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in (64, 500, 3000):
            spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
            found = filmography.section_extract(spark, str(tmp_path)).collect()
            assert {(r.file.split("/")[-1], r.line_no): r.value for r in found} == want
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", keep)


def test_numbered_lines_over_many_splits(spark, tmp_path):
    texts = {f"f{n}.txt": [f"{n}:{i}" + "x" * (i % 50) for i in range(1000 + n)] for n in range(3)}
    for name, lines in texts.items():
        write(tmp_path, "\n".join(lines) + "\n", name)
    keep = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        per_file = {(r.file.split("/")[-1], r.line_no): r.value for r in numbered_lines(spark, str(tmp_path)).collect()}
        running = {r.line_no: r.value for r in numbered_lines(spark, str(tmp_path), per_file=False).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", keep)
    assert per_file == {(name, i): line for name, lines in texts.items() for i, line in enumerate(lines)}
    assert running == dict(enumerate(line for name in sorted(texts) for line in texts[name]))


DICT = "@HD\tVN:1.0\n@SQ\tSN:chrM\tLN:100\n@SQ\tSN:chr1\tLN:oops\n@SQ SN:chrX LN:300"


def test_seq_dict(spark, rows, tmp_path):
    assert rows(genome.scan_seq_dict(spark, write(tmp_path, DICT))) == [(0, "chrM", 100), (1, "chr1", 0), (2, "chrX", 300)]


def test_reads(spark, rows, tmp_path):
    names = genome.scan_seq_dict(spark, write(tmp_path, DICT, "dict"))
    text = "@HD\tVN:1\nr1\t0\tchr1\t7\t60\t5M\t=\t9\t2\tACGTA\tIIIII\nr2\t4\t*\tx\t0\t*\t*\t0\t0\t*\t*\nshort\t16\tchrX\n"
    got = rows(genome.scan_reads(spark, write(tmp_path, text, "sam"), names), "qname", "flag", "ref_index", "pos", "qual")
    assert got == [("r1", 0, 1, 7, "IIIII"), ("r2", 4, None, None, "*"), ("short", 16, 2, None, None)]


def test_bed(spark, rows, tmp_path):
    path = write(tmp_path, "track name=x\n#c\nbrowser pos\nchr1\t0\t5\tgene\t+\nchr2\t3\t4\n")
    assert rows(genome.scan_bed(spark, path)) == [("chr1", 0, 5, "gene\t+"), ("chr2", 3, 4, "")]


def test_vcf(spark, rows, tmp_path):
    path = write(tmp_path, "##contig=<ID=chr1>\nchr10\t5\t.\tA\tC\nchrX\t6\t.\tA\tC\nchrY\t7\t.\tA\tC\nchrM\t8\t.\tA\tC\n")
    got = rows(genome.scan_vcf(spark, path).where("chrom >= 0"), "chrom", "pos", "ref", "alt")
    assert got == [(0, 8, "A", "C"), (10, 5, "A", "C"), (23, 6, "A", "C"), (24, 7, "A", "C")]


def test_unknown_chromosome_is_an_error(spark, tmp_path):
    with pytest.raises(Exception):
        genome.scan_vcf(spark, write(tmp_path, "chrQ\t5\t.\tA\tC\n")).collect()


def test_input_files_are_named(spark, rows, tmp_path):
    write(tmp_path, "a\nb\n", "1.txt")
    write(tmp_path, "c\n", "2.txt")
    got = rows(genome.scan_input_files(spark, str(tmp_path)), F.element_at(F.split("file", "/"), -1), "value")
    assert got == [("1.txt", "a"), ("1.txt", "b"), ("2.txt", "c")]


def test_fastq(spark, rows, tmp_path):
    path = write(tmp_path, "@r0\nAC\n+\nII\n@r1\nGT\n+r1\n@@\n")
    assert rows(fastq.scan_fastq(spark, path)) == [(0, "r0", "AC", "II"), (1, "r1", "GT", "@@")]

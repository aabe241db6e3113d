from pyspark.sql import functions as F

from millrace.functions.cigar import alignment_end, soft_clip_to, unclipped_five_prime
from millrace.functions.counts import count_growth
from millrace.functions.languages import LANGUAGE_NAMES, with_language_name
from millrace.functions.qualities import decode_qualities, quality_score
from millrace.functions.text import clean_text, one_line, script_fix


def values(spark, inputs, make, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(make(F.col("v"))).collect()]


def test_clean_text(spark):
    texts = ["RT @bob: hi RT http://x.y/z there", "a\nRT b", "no marks", "@å_1 @x@y https://q\nnext", ""]
    assert values(spark, texts, clean_text) == [" : hi RT there", "a\n b", "no marks", "_1  next", ""]


def test_one_line_replaces_each_break(spark):
    assert values(spark, ["a\r\nb\nc"], one_line) == ["a  b c"]


def test_script_fix(spark):
    texts = [("lt", "ひ"), ("lt", "한"), ("lt", "한ひ"), ("lt", "abc"), ("en", "ひ한")]
    df = spark.createDataFrame(texts, "code string, text string")
    got = [r[0] for r in df.select(script_fix(F.col("code"), F.col("text"))).collect()]
    assert got == ["ja", "ko", "ja", "lt", "en"]


def test_count_modes(spark):
    df = spark.createDataFrame([(5, 5), (9, 4)], "a int, b int")
    for mode, want in (("floor_one", [1, 5]), ("diff", [0, 5]), ("diff_plus_one", [1, 6])):
        assert [r[0] for r in df.select(count_growth(F.col("a"), F.col("b"), mode)).collect()] == want


def test_language_names(spark):
    df = spark.createDataFrame([("en",), ("FR",), ("zh-min-nan",), ("",)], "code string")
    got = {r["code"]: r["language"] for r in with_language_name(df, "code").collect()}
    assert got == {"en": "English", "FR": "French", "zh-min-nan": "zh-min-nan", "": ""}


def test_language_names_agree_with_java(spark):
    locale = spark._jvm.java.util.Locale
    common = ["en", "de", "fr", "es", "ja", "ko", "lt", "ru", "zh", "pt", "ar", "he", "id", "nb", "el", "fa", "hi"]
    english = getattr(locale, "ENGLISH")
    assert {c: locale(c).getDisplayLanguage(english) for c in common} == {c: LANGUAGE_NAMES[c] for c in common}
    assert set(LANGUAGE_NAMES) >= set(locale.getISOLanguages()) - {"sh"}


def test_alignment_end(spark):
    cigars = ["10M", "3S10M", "10M2D5M", "10M1I4M", "5M100N5M", "2H6=4X3S", "*"]
    assert values(spark, cigars, lambda c: alignment_end(F.lit(100), c)) == [109, 109, 116, 113, 209, 109, 99]


def test_five_prime(spark):
    forward = values(spark, ["3S10M2S", "2H1S10M", "10M"], lambda c: unclipped_five_prime(F.lit(50), c, F.lit(False)))
    reverse = values(spark, ["3S10M2S", "10M4S1H", "10M"], lambda c: unclipped_five_prime(F.lit(50), c, F.lit(True)))
    assert forward == [47, 47, 50]
    assert reverse == [61, 64, 59]


def test_soft_clip(spark):
    cases = {
        ("10M", 4): "4M6S",
        ("3S10M", 4): "3S4M6S",
        ("10M2D5M", 11): "10M5S",
        ("10M2D5M", 14): "10M2D2M3S",
        ("10M1I4M", 10): "10M5S",
        ("2H10M3S1H", 6): "2H6M7S1H",
        ("10M2S", 10): "10M2S",
    }
    for (cigar, allowed), want in cases.items():
        assert values(spark, [cigar], lambda c: soft_clip_to(c, F.lit(allowed))) == [want]


def test_qualities(spark):
    assert values(spark, ["!0I", "*", ""], decode_qualities) == [[0, 15, 40], [], []]
    assert values(spark, ["!0I", "*", "//"], quality_score) == [55, 0, 0]


def test_library_size_solves_the_saturation_equation(spark):
    from math import exp

    from millrace.functions.library import library_size

    rows = [(0, 0), (5, 5), (5, 0), (5, 1), (None, 1), (1000, 999), (1000, 950), (10**9, 3 * 10**8), (10**6, 2), (10**6, 1)]
    got = spark.createDataFrame(rows, "reads bigint, distinct bigint").select(
        "reads", "distinct", library_size(F.col("reads"), F.col("distinct")).alias("size")
    )
    for r in got.collect():
        if not r.reads or not r.distinct or r.reads == r.distinct:
            assert r.size is None
        else:
            lost = lambda x: x * (1 - exp(-r.reads / x)) - r.distinct
            assert lost(max(r.size - 0.51, 0.4)) <= 1e-6 and lost(r.size + 0.51) >= -1e-6, r

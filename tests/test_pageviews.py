from millrace.operators.pageviews import ranked_pageviews
from millrace.sinks.files import PAGEVIEW_HEADER, write_pageview_report

VIEWS = [
    ("en", "Apple", 5, 1),
    ("en.b", "Pear", 9, 1),
    ("en.m", "Fig", 9, 1),
    ("en", "en", 1000, 1),
    ("de.m", "Haus", 7, 1),
    ("qq", 'say "hi"', 50, 1),
]


def views(spark):
    return spark.createDataFrame(VIEWS, "project string, title string, views bigint, size bigint")


def test_totals_and_top_page(spark):
    got = [tuple(r) for r in ranked_pageviews(views(spark)).collect()]
    assert got == [
        ("qq", "qq", 50, 'say "hi"', 50),
        ("English", "en", 23, "Fig", 9),
        ("German", "de", 7, "Haus", 7),
    ]


def test_report_file(spark, tmp_path):
    path = str(tmp_path / "report")
    write_pageview_report(views(spark), path)
    lines = [r.value for r in spark.read.text(path).collect()]
    assert lines == [
        PAGEVIEW_HEADER,
        'qq, qq, 50, "say "hi"", 50',
        'English, en, 23, "Fig", 9',
        'German, de, 7, "Haus", 7',
    ]

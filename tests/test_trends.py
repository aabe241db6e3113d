import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import trends
from millrace.sources.retweet_log import LOG_HEADER
from millrace.sources.statuses import stream_source
from millrace.streaming.trends import close_stream, close_stream_log, retweet_stream, retweet_stream_log

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "ts timestamp_ntz, is_retweet boolean, id bigint, retweet_count int, lang string, text string"


def statuses(spark, items):
    data = [(T0 + dt.timedelta(seconds=s), r, i, n, lang, text) for s, r, i, n, lang, text in items]
    return spark.createDataFrame(data, SCHEMA)


def at(window_end):
    return (window_end - T0).total_seconds()


def random_items(seed, n=400, span=300):
    rng = random.Random(seed)
    return sorted(
        (rng.random() * span, rng.random() < 0.8, rng.randrange(12), rng.randrange(50), rng.choice("ab"), rng.choice("xyz"))
        for _ in range(n)
    )


def brute_windows(items, window, slide):
    ends = {}
    for s, is_retweet, post, n, lang, text in items:
        if not is_retweet:
            continue
        first = int(s // slide) * slide + slide
        for end in range(first, first + window, slide):
            ends.setdefault((end, post), []).append((s, lang, text, n))
    counted = {}
    for key, seen in ends.items():
        top, low = max(x[3] for x in seen), min(x[3] for x in seen)
        counted[key] = (min(seen)[1], min(seen)[2], top, low, 1 if top == low else top - low)
    totals = {}
    for (end, _), (lang, _, _, _, count) in counted.items():
        totals[end, lang] = totals.get((end, lang), 0) + count
    return sorted(
        (end, post, lang, text, top, low, count, totals[end, lang])
        for (end, post), (lang, text, top, low, count) in counted.items()
    )


def collect_windows(df):
    return sorted(
        (at(r.window_end), r.id, r.language_code, r.text, r.max_count, r.min_count, r["count"], r.total_lang_count)
        for r in df.collect()
    )


def test_windows_match_brute_force(spark):
    items = random_items(1)
    got = collect_windows(trends.retweet_windows(statuses(spark, items), "60 seconds", "5 seconds"))
    assert got == brute_windows(items, 60, 5)


@pytest.mark.parametrize("window, slide", [("60 seconds", "5 seconds"), ("10 seconds", "4 seconds"), ("60 seconds", "7 seconds")])
def test_panes_change_nothing(spark, window, slide):
    seen = trends.retweet_filter(statuses(spark, random_items(2)))
    direct = trends.build_windows(seen, window, slide)
    paned = trends.build_windows(trends.pane_counts(seen, window, slide), window, slide)
    assert direct.exceptAll(paned).count() == 0 and paned.exceptAll(direct).count() == 0


def test_slide_that_does_not_divide_the_window(spark):
    # One sighting a second with a rising count, windows of 10 seconds every 4.
    items = [(s, True, 1, s, "en", "t") for s in range(20)]
    got = {at(r.window_end): r.max_count for r in trends.retweet_windows(statuses(spark, items), "10 seconds", "4 seconds").collect()}
    assert got == {end: min(end - 1, 19) for end in range(2, 29, 4)}


def test_true_maximum_whatever_the_order(spark):
    # Partial results (10, 5) and (20, 12) give 20, not 12.
    items = [(1, True, 7, 5, "en", "t"), (1.5, True, 7, 10, "en", "t"), (6, True, 7, 20, "en", "t"), (7, True, 7, 12, "en", "t")]
    full = trends.retweet_windows(statuses(spark, items), "60 seconds", "5 seconds").where("max_count = 20 and min_count = 5")
    assert {r["count"] for r in full.collect()} == {15}


def test_ranks(spark):
    items = [(1, True, 1, 5, "en", "a"), (2, True, 1, 9, "en", "a"), (2, True, 2, 3, "en", "b"), (3, True, 3, 1, "de", "c"), (4, False, 4, 1, "de", "d")]
    data = statuses(spark, items)
    posts = trends.ranked_posts(trends.retweet_windows(data, "5 seconds", "5 seconds"))
    assert [(r["rank"], r.id, r.total_lang_count) for r in posts.orderBy("rank").collect()] == [(0, 1, 5), (1, 2, 5), (2, 3, 1)]
    langs = trends.ranked_language_totals(data, "5 seconds", "5 seconds")
    assert [(r["rank"], r.language, r.total_lang_count) for r in langs.orderBy("rank").collect()] == [(0, "English", 5), (1, "German", 1)]


def test_warmup_and_log_lines(spark):
    items = [(2, True, 1, 5, "en", "line\nbreak"), (63, True, 1, 9, "en", "later")]
    lines = trends.log_lines(trends.log_after_warmup(statuses(spark, items), "60 seconds", "5 seconds"))
    got = {(at(r.window_end), r.value) for r in lines.collect()}
    # The first boundary is 5 s; windows ending from 65 s on are logged.
    assert min(got) == (65.0, "(60),English,en,1,1,9,9,1,later")
    assert max(got)[0] == 120.0 and len(got) == 12


def test_log_totals(spark):
    schema = "seconds string, language string, language_code string, total_lang_count bigint, id bigint, max_count bigint, min_count bigint, count bigint, text string"
    log = [
        ("(65)", "x", "en", 0, 1, 10, 5, 5, "late"),
        ("(60)", "x", "en", 0, 1, 8, 4, 4, "early"),
        ("(60)", "x", "en", 0, 2, 6, 5, 1, "small"),
        ("(60)", "x", "de", 0, 3, 30, 1, 29, "big"),
        ("(60)", "x", "de", 0, 4, 3, 3, 1, "none"),
    ]
    got = [tuple(r) for r in trends.log_totals(spark.createDataFrame(log, schema)).collect()]
    assert got == [("German", "de", 29, 3, 29, "big"), ("English", "en", 7, 1, 6, "early")]


@pytest.fixture
def stream_folder(spark, tmp_path):
    """Three files in time order, so the stream takes three batches."""
    items = random_items(3, 600, 600)
    folder = tmp_path / "in"
    for n in range(3):
        part = statuses(spark, items[n * 200 : (n + 1) * 200])
        part.coalesce(1).write.mode("append").parquet(str(folder))
    return items, str(folder)


def open_statuses(spark, folder):
    rows = stream_source(spark, folder, SCHEMA, max_files_per_batch=1)
    return rows.withColumn("ts", F.col("ts").cast("timestamp"))


def test_stream_equals_batch_on_closed_windows(spark, tmp_path, stream_folder):
    items, folder = stream_folder
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    job = retweet_stream(open_statuses(spark, folder), out, state, "60 seconds", "5 seconds", "5 seconds", {"availableNow": True})
    job.awaitTermination()
    got = collect_windows(spark.read.parquet(out).withColumn("window_end", F.col("window_end").cast("timestamp_ntz")))
    closed = max(s for s, *rest in items if rest[0]) - 5
    assert got == [w for w in brute_windows(items, 60, 5) if w[0] <= closed]


def test_closed_stream_equals_batch(spark, tmp_path, stream_folder):
    items, folder = stream_folder
    out, state = str(tmp_path / "out"), str(tmp_path / "state")

    def run():
        retweet_stream(open_statuses(spark, folder), out, state, "60 seconds", "5 seconds", "5 seconds", {"availableNow": True}).awaitTermination()

    def written():
        return collect_windows(spark.read.parquet(out).withColumn("window_end", F.col("window_end").cast("timestamp_ntz")))

    close_stream(spark, out, state)  # never ran
    run()
    for _ in range(2):  # a repeated closing changes nothing
        close_stream(spark, out, state)
        assert written() == brute_windows(items, 60, 5)
    # More input: windows closed too early are open again, and closed with all their rows.
    later = [(s + 590, *rest) for s, *rest in random_items(4, 100, 200)]
    statuses(spark, later).coalesce(1).write.mode("append").parquet(folder)
    run()
    close_stream(spark, out, state)
    assert written() == brute_windows(items + later, 60, 5)


def test_log_of_a_stream_in_which_nothing_closed(spark, tmp_path):
    items, folder = [(s, *rest) for s, *rest in random_items(6, 50, 3)], str(tmp_path / "in")
    statuses(spark, items).coalesce(1).write.parquet(folder)
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    args = (out, state, "10 seconds", "5 seconds", "60 seconds", {"availableNow": True})
    retweet_stream_log(open_statuses(spark, folder), *args).awaitTermination()
    close_stream_log(spark, out, state, "10 seconds")
    lines = [r.value for r in spark.read.text(f"{out}/log").collect()]
    wanted = brute_windows(items, 10, 5)
    first_end = min(w[0] for w in wanted)
    want = [
        f"({end - first_end}),{lang},{lang},{total},{post},{top},{low},{count},{text}"
        for end, post, lang, text, top, low, count, total in wanted
        if first_end + 10 <= end
    ]
    assert sorted(lines) == sorted([LOG_HEADER, *want])


def test_log_survives_restart(spark, tmp_path, stream_folder):
    items, folder = stream_folder
    out, state = str(tmp_path / "out"), str(tmp_path / "state")

    def run():
        args = (out, state, "60 seconds", "5 seconds", "5 seconds", {"availableNow": True})
        retweet_stream_log(open_statuses(spark, folder), *args).awaitTermination()

    run()
    later = [(s + 600, *rest) for s, *rest in random_items(4, 100, 200)]
    statuses(spark, later).coalesce(1).write.mode("append").parquet(folder)
    run()
    lines = [r.value for r in spark.read.text(f"{out}/log").collect()]
    everything = items + later
    first_end = int(min(s for s, *rest in items if rest[0]) // 5) * 5 + 5
    closed = max(s for s, *rest in everything if rest[0]) - 5
    want = [
        f"({end - first_end}),{lang},{lang},{total},{post},{top},{low},{count},{text}"
        for end, post, lang, text, top, low, count, total in brute_windows(everything, 60, 5)
        if first_end + 60 <= end <= closed
    ]
    assert lines.count(LOG_HEADER) == 1
    assert sorted(line for line in lines if line != LOG_HEADER) == sorted(want)


def test_stream_keeps_one_row_per_pane_and_post(spark, tmp_path, stream_folder):
    """Windows are twelve times as many as panes, so the state must not hold windows; closed panes leave it."""
    items, folder = stream_folder
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    job = retweet_stream(open_statuses(spark, folder), out, state, "60 seconds", "5 seconds", "5 seconds", {"availableNow": True})
    job.awaitTermination()
    assert sum(s["numRowsTotal"] for p in job.recentProgress for s in p["stateOperators"]) == 0
    last = max(int(p.name) for p in (tmp_path / "state" / "panes").iterdir())
    closed = max(s for s, *rest in items if rest[0]) - 5
    needed = {(s // 5 * 5, post) for s, retweet, post, *_ in items if retweet and s // 5 * 5 + 60 > closed}
    assert spark.read.parquet(f"{state}/panes/{last}/open").count() == len(needed)


@pytest.mark.parametrize("job, close", [(retweet_stream, close_stream), (retweet_stream_log, close_stream_log)])
def test_late_rows_count_in_open_windows_and_a_repeated_batch_changes_nothing(spark, tmp_path, job, close):
    first = [(100, True, 1, 5, "en", "a"), (170, True, 2, 7, "en", "b")]
    late = [(130, True, 1, 9, "en", "a"), (171, True, 2, 9, "en", "b")]
    folder, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    for part in (first, late):
        statuses(spark, part).coalesce(1).write.mode("append").parquet(folder)
    run = lambda: job(open_statuses(spark, folder), out, state, "60 seconds", "5 seconds", "5 seconds", {"availableNow": True}).awaitTermination()

    def written():
        rows = spark.read.text(f"{out}/log") if job is retweet_stream_log else spark.read.parquet(out).drop("batch")
        return sorted(tuple(r) for r in rows.drop("batch").collect())

    run()
    close(spark, out, state)
    before = written()
    if job is retweet_stream:
        highest = {(r[1] - T0).total_seconds(): r[6] for r in before if r[5] == 1}
        # Windows that ended 5 s before the newest row, at 170 s, were written without the late row.
        assert highest == {end: 5 if end <= 165 else 9 for end in range(105, 191, 5) if end != 165}
    (tmp_path / "state" / "commits" / "1").unlink()
    for crc in (tmp_path / "state" / "commits").glob(".1.crc"):
        crc.unlink()
    run()
    close(spark, out, state)
    assert written() == before

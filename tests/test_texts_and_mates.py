import re
from collections import Counter

from millrace.operators import language_id
from millrace.operators.language_id import detect_language, identify_language, language_profiles
from millrace.operators.mates import interleave_chunks, unpaired_records
from millrace.sinks.files import write_chunks
from millrace.sources.fastq import scan_fastq

SAMPLES = [("en", "the cat and the hat are in the house\nand the dog"), ("de", "der hund und die katze sind in dem haus"), ("fr", "le chat et le chien sont dans la maison")]


def grams(text):
    framed = " " + re.sub(r"[^a-zé]+", " ", text.lower()).strip() + " "
    return Counter(framed[i : i + 3] for i in range(len(framed) - 2))


def ranks(counter, size):
    return {g: i + 1 for i, (g, _) in enumerate(sorted(counter.items(), key=lambda x: (-x[1], x[0]))[:size])}


def test_language_matches_brute_force(spark):
    size = 12
    texts = ["the house and the hat", "die katze und der hund", "la maison et le chat", "zzz qqq", "", "x"]
    profiles = {lang: ranks(grams(text), size) for lang, text in SAMPLES}
    want = {}
    for i, text in enumerate(texts):
        mine = ranks(grams(text) if text else Counter(), size)
        scored = [(sum(abs(r - p[g]) if g in p else size for g, r in mine.items()), lang) for lang, p in profiles.items()]
        distance, lang = min(scored)
        want[i] = (lang, distance)
    known = language_profiles(spark.createDataFrame(SAMPLES, "lang string, text string"), size)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: (r.language, r.distance) for r in identify_language(docs, known, size).collect()}
    assert got == want


def test_detection_in_batch_and_stream(spark, tmp_path):
    known = language_profiles(spark.createDataFrame(SAMPLES, "lang string, text string"))
    texts = ["RT @bob: the house and\nthe hat https://x.y/z", "die katze und der hund", "la maison et le chat", None, "RT RT"]
    posts = spark.createDataFrame(list(enumerate(texts)), "id bigint, text string")
    batch = {r.id: (r.lang, r.text) for r in detect_language(posts, known).collect()}
    assert batch[0] == ("en", " : the house and the hat ") and batch[1][0] == "de" and batch[2][0] == "fr"
    posts.write.parquet(str(tmp_path / "posts"))
    stream = detect_language(spark.readStream.schema(posts.schema).parquet(str(tmp_path / "posts")), known)
    query = stream.writeStream.format("memory").queryName("detected").trigger(availableNow=True).start()
    query.awaitTermination(120)
    assert {r.id: (r.lang, r.text) for r in spark.table("detected").collect()} == batch


def fastq(tmp_path, name, count, side):
    path = tmp_path / name
    path.write_text("".join(f"@r{i}/{side}\nAC{i}\n+\nII\n" for i in range(count)))
    return str(path)


def test_interleave(spark, tmp_path):
    first = scan_fastq(spark, fastq(tmp_path, "1.fq", 11, 1))
    second = scan_fastq(spark, fastq(tmp_path, "2.fq", 10, 2))
    chunked = interleave_chunks(first, second, 4)
    got = [tuple(r) for r in chunked.orderBy("pair", "mate").select("chunk", "pair", "mate", "name").collect()]
    assert got == [(i * 4 // 10, i, m, f"r{i}/{m}") for i in range(10) for m in (1, 2)]
    assert tuple(unpaired_records(first, second).first()) == (1, 0)
    write_chunks(chunked, str(tmp_path / "chunks"))
    lines = []
    for chunk in range(4):
        for part in sorted((tmp_path / "chunks" / f"chunk={chunk}").glob("part-*")):
            lines += part.read_text().splitlines()
    assert lines[0::4] == [f"@r{i}/{m}" for i in range(10) for m in (1, 2)]
    assert lines[1::4] == [f"AC{i}" for i in range(10) for _ in (1, 2)]


def test_texts_of_a_batch_do_not_mix():
    rows = [("a", "abc", 1), ("a", "bcd", 2), ("b", "bcd", 1), ("b", "xyz", 2)]
    profiles = language_id.Profiles(rows, 3)
    texts = ["ab", "cd", "abc", "", "xyzxyz", "bcd", "\U0001f600ab"]
    langs, distances = profiles.nearest(texts)
    # A text without a known trigram has the first code and 3 per ranked trigram.
    assert langs == ["a", "a", "a", "a", "b", "b", "a"]
    assert distances.tolist() == [0, 0, 0, 0, 7, 0, 3]
    assert [profiles.nearest([t])[1][0] for t in texts] == distances.tolist()


def test_long_texts_are_batches_of_their_own(monkeypatch):
    monkeypatch.setattr(language_id, "BATCH_LETTERS", 10)
    texts = ["a" * 4, "b" * 6, "c" * 50, "", "d"]
    assert list(language_id._batches(texts)) == [texts[:2], texts[2:3], texts[3:]]
    assert list(language_id._batches([])) == []

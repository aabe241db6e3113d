import duckdb
from llm_cases import ALNUM, EDGES, documents, prose, words

from millrace.llm import licenses as op
from millrace.llm.queries import OP9_SQL

def wrapped(seed, notice):
    """A notice over lines of seven words, in the middle of other text."""
    w = notice.title().split()
    lines = [" ".join(w[i : i + 7]) for i in range(0, len(w), 7)]
    return prose(seed, 20 + seed % 9) + " " + ",\n * ".join(lines) + ".\n" + prose(seed + 1, 30)


TEXTS = [
    *EDGES,
    "Released under the MIT License.",
    "under the MIT license under the mit License, under the MIT licenses",
    "Apache License, Version 2.0 and CC-BY-NC 4.0\nunder the mit license",
    "under the mit\nlicense",
    prose(1, 50) + "\nThis work is licensed under the GNU General Public License, version 3.\n" + prose(2, 50),
    "License MIT the under licensed",
    "all rights reserved " * 3,
    "under the \u212aMIT license",  # a Kelvin sign is no k
    "x " * 3000 + "cc by nc",
    *(wrapped(5 * i, template) for i, (_, template, _, _) in enumerate(op.TEMPLATES)),
    *(wrapped(i, "x " * i + " ".join(template.split()[i % 7 :])) for i, (_, template, _, _) in enumerate(op.TEMPLATES)),
    "all rights of the authors named below are and will be reserved",
]


def brute(text):
    w = words(text, ALNUM)
    places, labels = [], set()
    for phrase, label in op.PHRASES.items():
        p = phrase.split()
        for i in range(len(w) - len(p) + 1):
            if w[i : i + len(p)] == p:
                places.append(i)
                labels.add(label)
    best, more = 0.0, set()
    for label, template, must, without in op.TEMPLATES:
        length, own = len(template.split()), set(template.split())
        for start in range(0, len(w), length):
            block = set(w[start : start + 2 * length])
            shared = len(block & own)
            if shared >= op.need(len(own), op.PERCENT) and block >= set(must.split()) and not block & set(without.split()):
                more.add(label)
                best = max(best, shared / len(own))
    first, last = (min(places), max(places)) if places else (None, None)
    return len(w), len(places), first, last, ",".join(sorted(labels)), ",".join(sorted(labels | more)), 1.0 if places else best


def test_scan_matches_brute_force(spark):
    rows = [*enumerate(TEXTS), (3, "one"), (None, TEXTS[-1])]
    got = op.license_scan(documents(spark, rows)).collect()
    assert sorted((tuple(r) for r in got), key=repr) == sorted(((i, *brute(t)) for i, t in rows), key=repr)


def test_sql_agrees_with_brute_force():
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", list(enumerate(TEXTS)))
    result = con.execute(OP9_SQL).fetchall()
    assert sorted(result) == sorted((i, *brute(t)) for i, t in enumerate(TEXTS))


def test_notices_of_one_family_are_told_apart(spark):
    texts = {
        "This work is licensed under the GNU General Public License, version 3.": "gpl-3",
        "This work is licensed under the GNU General Public License, version 2.": "gpl-2",
        "This work is licensed under the GNU General Public License.": "",
        "Licensed under the GNU Lesser General Public License, version 3": "lgpl",
        "Licensed under the GNU Affero General Public License, version 3": "agpl-3",
        "Licensed under CC BY-NC 4.0.": "cc-by-nc",
        "Licensed under CC BY-SA 4.0.": "cc-by-sa",
        "Licensed under CC BY 4.0.": "cc-by",
        "Licensed under CC BY-NC-SA 4.0.": "cc-by-nc",  # by the phrase alone
        "Licensed under the Mozilla Public License, version 2.0": "",
        "a" * 100 + " rights " + "b " * 200 + "all reserved": "",
    }
    got = op.license_scan(documents(spark, [prose(i, 40) + "\n" + t + "\n" + prose(i + 1, 40) for i, t in enumerate(texts)]))
    assert [r.labels for r in got.orderBy("doc_id").collect()] == list(texts.values())


def test_notices_over_several_lines_are_found(spark):
    long = [t for t in op.TEMPLATES if len(t[1].split()) > 15]
    got = op.license_scan(documents(spark, [wrapped(i, t[1]) for i, t in enumerate(long)])).orderBy("doc_id").collect()
    assert len(long) >= 6 and [r.labels for r in got] == [t[0] for t in long] and all(r.score == 1.0 for r in got)


def test_prefix_has_two_words_of_every_block_found():
    for t in op.TEMPLATES:
        own = set(t[1].split())
        prefix = op.prefix_words(t, {}, op.PERCENT)
        missing = len(own) - op.need(len(own), op.PERCENT)
        assert len(set(prefix)) - missing == 2


def test_empty_table(spark):
    assert op.license_scan(documents(spark, ["a"]).limit(0)).count() == 0

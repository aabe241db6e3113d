import os
import random
import tempfile
import tracemalloc

import numpy as np
import pytest
from llm_cases import EDGES, documents, prose

from millrace.cluster import BATCH_BYTES
from millrace.llm import toxicity, words

SF = "/root/testdata/sf0.01"


def index_of(seed, n, terms, k):
    rng = np.random.default_rng(seed)
    dense = rng.random((n, terms)) * (rng.random((n, terms)) < 0.15)
    dense[:: 7] = dense[0]  # ties
    norm = np.linalg.norm(dense, axis=1, keepdims=True)
    dense = np.divide(dense, norm, out=np.zeros_like(dense), where=norm > 0)
    row, term = np.nonzero(dense)
    vectors = toxicity.Vectors(np.searchsorted(row, np.arange(n + 1)), term, dense[row, term])
    toxic = (rng.random(n) < 0.3).astype(int)
    return dense, vectors, toxicity.Index(np.arange(terms, dtype=np.uint64), np.ones(terms), vectors, toxic, k)


def test_neighbours_are_exact():
    dense, vectors, index = index_of(3, 900, 40, 10)
    for i in range(0, 900, 13):
        a, b = vectors.at[i], vectors.at[i + 1]
        cosine = np.round(dense @ dense[i], 12)
        want = np.lexsort((np.arange(900), -cosine))
        want = [j for j in want if cosine[j] > 0][:10]
        found, value = index.nearest(vectors.term[a:b], vectors.weight[a:b])
        assert found.tolist() == want and np.allclose(value, cosine[want])


def test_most_blocks_stay_closed():
    rng = np.random.default_rng(5)
    n, terms, k = 4000, 200, 10
    topic = rng.integers(0, 40, n)  # five terms of a topic each, and a little of two others
    dense = np.zeros((n, terms))
    for i in range(n):
        dense[i, topic[i] * 5 + rng.permutation(5)[:4]] = 1 + rng.random(4)
        dense[i, rng.integers(0, terms, 2)] += 0.2
    dense /= np.linalg.norm(dense, axis=1, keepdims=True)
    row, term = np.nonzero(dense)
    vectors = toxicity.Vectors(np.searchsorted(row, np.arange(n + 1)), term, dense[row, term])
    index = toxicity.Index(np.arange(terms, dtype=np.uint64), np.ones(terms), vectors, (topic < 12).astype(int), k)
    queries = range(0, n, 40)
    for i in queries:
        a, b = vectors.at[i], vectors.at[i + 1]
        cosine = np.round(dense @ dense[i], 12)
        cosine[i] = 0
        want = np.lexsort((np.arange(n), -cosine))[:k]
        found, _ = index.nearest(vectors.term[a:b], vectors.weight[a:b], without=i)
        assert found.tolist() == want.tolist()
    assert index.blocks == 125 and index.opened < 0.2 * index.blocks * len(queries)


def test_terms_in_many_blocks_have_tables_of_bounded_size():
    rng = np.random.default_rng(8)
    n, terms = 3000, 300
    share = np.where(np.arange(terms) < 10, 0.3, 0.001)  # a few terms in all blocks, the others in a few
    dense = (rng.random((n, terms)) + 0.1) * (rng.random((n, terms)) < share)
    norm = np.linalg.norm(dense, axis=1, keepdims=True)
    dense = np.divide(dense, norm, out=np.zeros_like(dense), where=norm > 0)
    row, term = np.nonzero(dense)
    vectors = toxicity.Vectors(np.searchsorted(row, np.arange(n + 1)), term, dense[row, term])
    index = toxicity.Index(np.arange(terms, dtype=np.uint64), np.ones(terms), vectors, np.zeros(n, int), 9)
    assert 10 <= len(index.full_max) < 50 and index.full_part.size <= toxicity.FULL * len(index.part_at)
    for i in range(0, n, 61):
        a, b = vectors.at[i], vectors.at[i + 1]
        cosine = np.round(dense @ dense[i], 12)
        want = [j for j in np.lexsort((np.arange(n), -cosine)) if cosine[j] > 0][:9]
        assert index.nearest(vectors.term[a:b], vectors.weight[a:b])[0].tolist() == want


def test_prefixes_are_fingerprints_of_first_bytes():
    data = np.frombuffer("Wordless ab \u00e9t\u00e9s x".encode(), np.uint8)
    row, value = toxicity.terms(data, np.array([0, 12, len(data)]))
    held = (b"wordless", "\u00e9t\u00e9s".encode())
    short = [w[:n] for n in toxicity.PREFIXES for w in held if len(w) > n]
    at = np.cumsum([0, *map(len, short)])
    joined = np.frombuffer(b"".join(short), np.uint8)
    size = np.diff(at).astype(np.uint64)
    want = toxicity.mix(words.fingerprints(joined, at[:-1], at[1:]) + size)
    assert len(value) == 4 + len(want) and (value[4:] == want).all()
    assert row.tolist() == [0, 0, 1, 1, 0, 1, 0, 1, 0, 1, 0]


def test_fingerprints_do_not_hold_the_text_several_times():
    word = "caf\u00e9".encode() + b" "
    data = np.frombuffer(b"x" * (words.RUN_BYTES + 9) + b" " + word * (3 << 18), np.uint8)  # a word longer than a run, 4.5 MB
    tracemalloc.start()
    found = words.find_words(data, np.array([0, len(data)]), words.ALNUM)
    tracemalloc.reset_peak()
    value = words.fingerprints(found.data, found.start, found.end)
    held = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert held[1] - held[0] < 5 * len(data) and sum(p.nbytes for p in words._powers) < len(data) + (1 << 20)
    alone = words.fingerprints(data[found.start[-1] : found.end[-1]], np.array([0]), np.array([len(word) - 1]))
    assert len(value) == 1 + (3 << 18) and (value[1:] == alone).all() and value[0] != alone
    assert value[0] == words.fingerprints(data[: found.end[0]], np.array([0]), found.end[:1])[0]


def test_fit_reads_texts_in_batches_bounded_by_bytes(spark, monkeypatch):
    rows = [(i, "x" * 100_000 + (" vile" if i % 4 == 0 else "")) for i in range(200)]
    docs = documents(spark, rows).coalesce(1)
    folder = tempfile.mkdtemp()
    whole = words.text_buffers

    def noted(column):
        if column.nbytes > 2 * BATCH_BYTES:
            open(f"{folder}/{os.getpid()}-{column.nbytes}", "w").close()
        return whole(column)

    monkeypatch.setattr(toxicity, "text_buffers", noted)
    toxicity.fit(docs, labelled(spark, [(i, 1, int(i % 4 == 0)) for i, _ in rows]))
    assert os.listdir(folder) == []


def test_equal_examples_do_not_open_all_blocks():
    n = 3200
    vectors = toxicity.Vectors(np.arange(n + 1), np.zeros(n, np.int64), np.ones(n))
    index = toxicity.Index(np.arange(1, dtype=np.uint64), np.ones(1), vectors, np.arange(n) % 2, 25)
    found, cosine = index.nearest(np.array([0]), np.array([1.0]))
    assert found.tolist() == list(range(25)) and (cosine == 1).all() and index.opened <= 6


def test_fewer_examples_than_neighbours():
    dense, vectors, index = index_of(9, 5, 6, 10)
    a, b = vectors.at[1], vectors.at[2]
    cosine = np.round(dense @ dense[1], 12)
    want = [j for j in np.lexsort((np.arange(5), -cosine)) if cosine[j] > 0]
    assert index.nearest(vectors.term[a:b], vectors.weight[a:b])[0].tolist() == want


def labelled(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


def test_scores(spark):
    rng = random.Random(1)
    texts, labels = [], []
    for i in range(300):
        bad = i % 4 == 0
        texts.append(prose(i, 60) + (" vilenes" + rng.choice("abc") if bad else ""))
        if i < 200:
            labels.append((i, 1, int(bad)))
    rows = [*enumerate(texts), *((1000 + i, t) for i, t in enumerate(EDGES)), (None, "vilenesa"), (7, texts[7])]
    labels += [(None, 1, 1), (5, 0, None), (99999, 1, 1), (8, 1, 1)]
    docs = documents(spark, rows)
    index = toxicity.fit(docs, labelled(spark, labels))
    got = toxicity.score_toxicity(docs, index).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    by_id = {r.doc_id: r for r in got}
    held = range(200, 300)
    assert sum(by_id[i].predicted == (i % 4 == 0) for i in held) >= 97
    assert by_id[None].predicted == 1 and by_id[1000].predicted == 0
    assert by_id[200].evidence and by_id[200].evidence[0].toxic == 1
    carried = toxicity.score_toxicity(docs, index, carry=["doc_id", "text", "lang"]).columns
    assert carried == ["doc_id", "text", "lang", "score", "predicted", "evidence"]


def test_rare_toxic_word_is_a_term_among_many_examples(spark):
    # Chi-squared of the word is 27: beyond the bound of 20, under one per cent of the examples.
    rare = (10, 1010, 2010)
    rows = [(i, prose(i, 6) + (" vile" if i % 10 == 0 and i not in rare else "") + (" zxq" if i in rare else "")) for i in range(3000)]
    docs = documents(spark, [*rows, *((5000 + i, "zxq" if i < 2 else "plain") for i in range(300))])
    index = toxicity.fit(docs, labelled(spark, [(i, 1, int(i % 10 == 0)) for i, _ in rows]))
    got = {r.doc_id: r for r in toxicity.score_toxicity(docs.where("doc_id >= 5000"), index).collect()}
    assert {int(e.doc_id) for e in got[5000].evidence} >= set(rare) and got[5000].predicted == 1
    assert not got[5299].evidence and got[5299].predicted == 0
    # Document frequencies come from all 3300 rows, of which 5 hold the word.
    assert np.isclose(index.idf, np.log(3301 / 6) + 1).any()


def test_without_labels_or_rows(spark):
    docs = documents(spark, ["a b", None])
    index = toxicity.fit(docs, labelled(spark, [(1, 1, 1)]).limit(0))
    assert [r.score for r in toxicity.score_toxicity(docs, index).collect()] == [0.0, 0.0]
    assert toxicity.score_toxicity(docs.limit(0), index).count() == 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")
def test_held_out_accuracy(spark):
    from millrace.llm.queries import op1_toxicity

    labels = spark.read.parquet(f"{SF}/labels.parquet")
    english = spark.read.parquet(f"{SF}/documents.parquet").where("lang = 'en'").select("doc_id")
    rows = op1_toxicity(spark, SF).where("held_out").join(labels, "doc_id").join(english, "doc_id").collect()
    assert sum(r.predicted == r.toxic for r in rows) >= 0.93 * len(rows)

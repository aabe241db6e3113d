import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_cases import EDGES, SPACED, documents, prose, words
from pyspark.sql import functions as F

from millrace.llm import byte_contexts, ctw


def kt(zeros, ones):
    g = math.lgamma
    return g(zeros + 0.5) + g(ones + 0.5) - math.log(math.pi) - g(zeros + ones + 1)


class Tree:
    """The weighted tree by its definition, for one class."""

    def __init__(self, tokens):
        self.n = defaultdict(lambda: [0, 0])
        self.children = defaultdict(set)
        for data, times in tokens.items():
            for at in range(len(data)):
                for depth in range(ctw.DEPTH + 1):
                    context = self.context(data, at, depth)
                    for bit in range(8):
                        prefix = (1 << bit) | (data[at] >> (8 - bit))
                        self.n[context, prefix][data[at] >> (7 - bit) & 1] += times
                        if depth:
                            self.children[context[:-1], prefix].add(context)
        self.weighted = {}

    @staticmethod
    def context(data, at, depth):
        before = [data[at - k] if at >= k else 32 if at == k - 1 else 0 for k in range(1, depth + 1)]
        return tuple(before)

    def pw(self, context, prefix):
        key = context, prefix
        if key not in self.weighted:
            own = kt(*self.n[key])
            if len(context) < ctw.DEPTH:
                below = sum(self.pw(c, prefix) for c in self.children[key])
                own = np.logaddexp(own, below) - math.log(2)
            self.weighted[key] = own
        return self.weighted[key]

    def log10(self, data):
        total = 0.0
        for at in range(len(data)):
            for bit in range(8):
                prefix, actual = (1 << bit) | (data[at] >> (8 - bit)), data[at] >> (7 - bit) & 1
                value = None
                for depth in range(ctw.DEPTH, -1, -1):
                    key = self.context(data, at, depth), prefix
                    if key not in self.n:
                        continue
                    own = (self.n[key][actual] + 0.5) / (sum(self.n[key]) + 1)
                    if value is None:
                        value = own
                    else:
                        share = math.exp(kt(*self.n[key]) - math.log(2) - self.pw(*key))
                        value = share * own + (1 - share) * value
                total += math.log10(0.5 if value is None else value)
        return total


def pieces(text):
    return [w.encode() + b" " for w in words(text, SPACED)] + [b"\n"]


@pytest.mark.parametrize("head", [1 << 20, 20])
def test_scores_match_the_definition(spark, head):
    texts = [t for t in EDGES if len(t or "") < 6000] + [prose(i, 30, 60) for i in range(20)] + ["das ist die zeit"] * 3
    rows = [*enumerate(texts), (3, "one"), (None, "no id")]
    docs = documents(spark, rows).withColumn("lang", F.when(F.col("text").startswith("das"), "de").otherwise(F.col("lang")))
    train = F.col("doc_id") % 3 != 1
    got = ctw.ctw_scores(docs, train, F.col("lang"), head=head).collect()
    learnt = [t for i, t in rows if i is not None and i % 3 != 1]
    parts = [[t for t in learnt if (t or "").startswith("das") == german] for german in (False, True)]
    trees = [Tree(Counter(p for t in part for p in pieces(t))) for part in parts]
    counts = Counter(w for t in learnt for w in words(t, SPACED))
    n, v = sum(counts.values()) + len(learnt), len(counts) + 1
    want = []
    for i, t in rows:
        w = words(t, SPACED)
        base = sum(math.log10((c + 0.5) / (n + 0.5 * (v + 1))) for c in [*(counts[x] for x in w), len(learnt)])
        each = [math.log10(len(p) / len(learnt)) + sum(map(tree.log10, pieces(t))) for p, tree in zip(parts, trees, strict=True)]
        score = max(each) + math.log10(sum(10 ** (e - max(each)) for e in each))
        size = sum(map(len, pieces(t)))
        want.append((i, size, len(w) + 1, sum(counts[x] > 0 for x in w) + 1, n, base, score))
    have = [(r.doc_id, r.n_bytes, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got]
    for x, y in zip(sorted(have, key=repr), sorted(want, key=repr), strict=True):
        assert x[:5] == y[:5] and x[5:] == pytest.approx(y[5:], rel=1e-6)


def test_long_texts_and_no_training_rows(spark):
    docs = documents(spark, [*EDGES])
    rows = ctw.ctw_scores(docs, F.lit(None).cast("boolean")).collect()
    assert len(rows) == len(EDGES) and all(r.score == pytest.approx(-8 * r.n_bytes * math.log10(2), rel=1e-6) for r in rows)
    assert ctw.ctw_scores(docs.limit(0), F.lit(True)).count() == 0


class TextTree(Tree):
    """The tree over whole texts: an end mark before the first byte, zeros before that."""

    @staticmethod
    def context(data, at, depth):
        return tuple(data[at - k] if at >= k else 10 if at == k - 1 else 0 for k in range(1, depth + 1))


@pytest.mark.parametrize("head, chunk_bytes", [(1 << 20, 1 << 20), (20, 900)])
def test_contexts_across_words_match_the_definition(spark, head, chunk_bytes):
    texts = [t for t in EDGES if len(t or "") < 6000] + [prose(i, 30, 60) for i in range(12)] + ["das ist die zeit"] * 3
    rows = [*enumerate(texts), (3, "one"), (None, "no id")]
    docs = documents(spark, rows).withColumn("lang", F.when(F.col("text").startswith("das"), "de").otherwise(F.col("lang")))
    got = ctw.ctw_scores(docs, F.col("doc_id") % 3 != 1, F.col("lang"), head=head, across=True, chunk_bytes=chunk_bytes).collect()
    learnt = [t for i, t in rows if i is not None and i % 3 != 1]
    parts = [[t for t in learnt if (t or "").startswith("das") == german] for german in (False, True)]
    trees = [TextTree(Counter(b"".join(pieces(t)) for t in part)) for part in parts]
    counts = Counter(w for t in learnt for w in words(t, SPACED))
    n, v = sum(counts.values()) + len(learnt), len(counts) + 1
    want = []
    for i, t in rows:
        w = words(t, SPACED)
        base = sum(math.log10((c + 0.5) / (n + 0.5 * (v + 1))) for c in [*(counts[x] for x in w), len(learnt)])
        each = [math.log10(len(p) / len(learnt)) + tree.log10(b"".join(pieces(t))) for p, tree in zip(parts, trees, strict=True)]
        score = max(each) + math.log10(sum(10 ** (e - max(each)) for e in each))
        want.append((i, sum(map(len, pieces(t))), len(w) + 1, sum(counts[x] > 0 for x in w) + 1, n, base, score))
    have = [(r.doc_id, r.n_bytes, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got]
    for x, y in zip(sorted(have, key=repr), sorted(want, key=repr), strict=True):
        assert x[:5] == y[:5] and x[5:] == pytest.approx(y[5:], rel=1e-6)


def test_pieces_of_a_tree_change_nothing(monkeypatch):
    rng = np.random.default_rng(1)
    keys = np.unique(np.frombuffer(rng.integers(97, 100, 8 * 3000, dtype=np.uint8).tobytes(), "<u8"))
    counts = rng.integers(0, 4, (len(keys), 2)).astype(float)
    whole = ctw.tree(keys, counts, 1, True)
    monkeypatch.setattr(ctw, "PIECE", 16)
    level, row, bits = ctw.tree(keys, counts, 1, True)
    assert (row == whole[1]).all() and np.allclose(bits, whole[2], equal_nan=True)
    assert all(np.allclose(a, b) for a, b in zip(level.log_pw, whole[0].log_pw, strict=True))


def test_whole_texts_without_training_rows_and_of_any_word_order(spark):
    docs = documents(spark, [*EDGES])
    rows = ctw.ctw_scores(docs, F.lit(None).cast("boolean"), across=True).collect()
    assert len(rows) == len(EDGES) and all(r.score == pytest.approx(-8 * r.n_bytes * math.log10(2), rel=1e-6) for r in rows)
    assert ctw.ctw_scores(docs.limit(0), F.lit(True), across=True).count() == 0


def test_query_scores_depend_on_word_order(spark, tmp_path):
    from millrace.llm.queries import op8_lm_scoring

    said = "the cat sat on the mat and the dog ran"
    documents(spark, [said] * 20 + [" ".join(reversed(said.split()))]).write.parquet(str(tmp_path / "documents.parquet"))
    scores = {r.doc_id: r.score for r in op8_lm_scoring(spark, str(tmp_path)).collect()}
    assert scores[20] < scores[0] - 1


def test_parts_of_a_chunk_hold_all_its_windows(monkeypatch):
    texts = [prose(k, 40) for k in range(50)] + ["", "x" * 900]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.append(0, np.cumsum([len(t) for t in texts]))
    stream, size, counts = byte_contexts.text_stream(data, offsets)
    assert counts.tolist() == [len(t.split()) for t in texts] and size.tolist() == [sum(map(len, pieces(t))) for t in texts]
    kind = np.arange(len(texts)) % 3 - 1
    want = Counter()
    for t, c in zip(texts, kind, strict=True):
        said = b"".join(pieces(t))
        for at in range(len(said)):
            before = TextTree.context(said, at, 7)
            want[c, sum(v << (8 * (7 - k)) for k, v in enumerate(before)) | said[at]] += 1
    monkeypatch.setattr(byte_contexts, "PART_BYTES", 500)
    got = Counter()
    for c, seen, n in byte_contexts.part_windows(stream, size, kind, 2):
        got.update({(c, int(k)): int(m) for k, m in zip(seen, n, strict=True)})
    assert got == want
    known = np.unique(np.array([k for _, k in want], np.uint64))
    some = np.arange(2 * len(known)).reshape(-1, 2)
    back, n = byte_contexts.unpacked(byte_contexts.packed(known, some), len(known), 2)
    assert (back == known).all() and (n == some).all()
    assert (known[byte_contexts.Places(known).of(known[::-1])] == known[::-1]).all()

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from llm_cases import EDGES, documents, prose
from tokenizers import Tokenizer

from millrace.llm import packing

PATH = str(public_tokenizers.path("byte_bpe_50k.json"))


def test_pieces_and_sequences(spark):
    odd = ["It's we'll I'M  two  spaces\n\nlines ", "日本語 текст ½ ² 🙂", "<|endoftext|> inside", "a\x1cb c d", "x_y 12ab"]
    texts = [*EDGES, *odd, *(prose(i, 40 + 37 * i) for i in range(60))]
    rows = [*enumerate(texts), (None, "no id"), (3, "one")]
    got = packing.pack(documents(spark, rows), PATH).collect()
    tokenizer = Tokenizer.from_file(PATH)
    ids = {i: np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [0], "<u4") for i, t in rows}
    places = defaultdict(list)
    for r in got:
        part = ids[r.doc_id][r.start : r.start + r.length]
        assert len(part) == r.length and zlib.crc32(part.tobytes()) == r.ids_crc32
        places[r.sequence_id].append((r.offset, r.length))
    for i, own in ids.items():
        pieces = sorted((r.piece, r.start, r.length) for r in got if r.doc_id == i)
        copies = sum(j == i for j, _ in rows)
        assert sum(n for _, _, n in pieces) == copies * len(own)
        assert all(n == packing.CAPACITY for p, _, n in pieces if p > 0)
        if len(own) <= packing.CAPACITY:
            assert len(pieces) == copies
    for spans in places.values():
        end = 0
        for offset, length in sorted(spans):
            assert offset == end
            end += length
        assert end <= packing.CAPACITY
    least = -(-sum(r.length for r in got) // packing.CAPACITY)
    assert len(places) <= 1.1 * least + 1


def test_new_words_are_encoded_together(monkeypatch):
    encode = packing.Encoder(PATH)
    texts = [f"{prose(i, 300)} \u00c0 la\u00a0 na\u00efve fa\u00e7ade\u00a0 w{i}\n  end" for i in range(20)]
    want = encode.whole(texts)
    alone: list[str] = []
    monkeypatch.setattr(encode, "whole", lambda own, whole=encode.whole: alone.extend(own) or whole(own))
    assert encode.apart and encode(texts) == want
    assert len(encode.memo) > 20 and not any(p[0] == " " and p[1:].isalpha() for p in alone)
    encode.apart = False  # a vocabulary whose tokens reach over the end of a word
    encode.memo.clear()
    assert encode(texts) == want and " fa\u00e7ade" in alone


def test_best_fit_and_closing():
    bins = packing.OpenBins(10, 2, 0)
    assert bins.place(6) == (0, 0) and bins.place(7) == (1, 0)
    assert bins.place(3) == (1, 7)  # the fullest that has room, now full
    assert bins.place(8) == (2, 0)
    assert bins.place(5) == (3, 0)  # two are open: the fullest, with 8, closes
    assert bins.place(2) == (0, 6)
    assert sorted(bins.rest()) == [(0, 8), (3, 5)]


def test_empty_table(spark):
    assert packing.pack(documents(spark, ["a"]).limit(0), PATH).count() == 0

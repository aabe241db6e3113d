"""Benchmark decontamination by suffix arrays over the training text.

Each run of documents (a shard of a few MB) gets a suffix array of its words. Every suffix of every
benchmark item is then looked up in it by binary search, one word further at a time, which yields
all places of its windows and how far each match goes on. Shards are independent, so nothing is
shuffled; the suffix arrays live only as long as their shard.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.words import ALNUM, find_words, slices, text_buffers

WINDOW = 13
SHARD_BYTES = 4 << 20
BLOCK_BYTES = 32 << 20  # benchmark text that is sent to the executors at once

_LONG = T.LongType()
_MATCH = T.StructType().add("item", T.StringType()).add("item_start", _LONG).add("start", _LONG).add("length", _LONG)
_STATE = (
    T.StructType()
    .add("n_words", _LONG)
    .add("n_hit", _LONG)
    .add("spans", T.ArrayType(_LONG))
    .add("items", T.ArrayType(T.StringType()))
    .add("longest", _MATCH)
)


def suffix_array(ranks: np.ndarray, n_ranks: int, depth: int) -> np.ndarray:
    """Word positions (rank 0 marks a document's end and is left out) in the order of what follows them.

    The order is right for the first ``depth`` words at least. Doubling: suffixes sorted by k words
    are sorted by 2k words with the ranks k words further on; only ties are sorted again.
    """
    order = np.argsort(ranks, kind="stable")
    order = order[np.searchsorted(ranks[order], 1) :]
    n = len(order)
    place = np.zeros(len(ranks) + 1, np.int64)  # a suffix's first slot among its equals, from 1; 0 at ends

    def regroup(slots: np.ndarray, key: np.ndarray) -> np.ndarray:
        """Name equal keys by their first slot; the slots that still have equals."""
        new = np.ones(len(slots), bool)
        new[1:] = key[1:] != key[:-1]
        first = np.flatnonzero(new)
        size = np.diff(np.append(first, len(slots)))
        place[order[slots]] = np.repeat(slots[first] + 1, size)
        return slots[np.repeat(size > 1, size)]

    active = regroup(np.arange(n), ranks[order])
    k = 1
    while k < depth and len(active):
        at = order[active]
        key = place[at] * (n + 2) + place[np.minimum(at + k, len(ranks))]
        by = np.argsort(key)
        order[active] = at[by]
        active = regroup(active, key[by])
        k *= 2
    return order


class Suffixes:
    """All suffixes of a block of benchmark items, as fingerprints."""

    def __init__(self, names: list[str], texts: list[str], window: int):
        data, offsets = text_buffers(pa.array(texts, pa.large_string()))
        words = find_words(data, offsets, ALNUM)
        n = words.counts()
        self.names = np.array(names, object)
        self.fp = words.fp
        self.item = words.row
        first = np.cumsum(n) - n
        self.begin = np.arange(len(words.fp)) - first[words.row]
        self.left = n[words.row] - self.begin
        self.window = np.minimum(window, n)[words.row]
        self.depth = int(n.max()) if len(n) else 0


def search(text: np.ndarray, order: np.ndarray, query: np.ndarray, items: Suffixes) -> tuple[np.ndarray, np.ndarray]:
    """Range of ``order`` whose suffixes start with each item suffix's window (empty if none do)."""
    low = np.zeros(len(query), np.int64)
    high = np.full(len(query), len(order), np.int64)
    alive = np.flatnonzero((items.left >= items.window) & (query > 0))
    low_out, high_out = np.zeros_like(low), np.zeros_like(high)
    for depth in range(int(items.window.max()) if len(query) else 0):
        if not len(alive):
            break
        wanted = query[alive + depth]
        for side in (0, 1):  # the first slot not below the word, then the first above it
            a, b = low[alive], high[alive]
            while True:
                open_ = a < b
                if not open_.any():
                    break
                mid = (a + b) >> 1
                word = text[np.minimum(order[np.minimum(mid, len(order) - 1)] + depth, len(text) - 1)]  # closed ranges aside
                right = open_ & ((word < wanted) if side == 0 else (word <= wanted))
                a = np.where(right, mid + 1, a)
                b = np.where(open_ & ~right, mid, b)
            if side == 0:
                first = a
            else:
                low[alive], high[alive] = first, a
        alive = alive[low[alive] < high[alive]]
        done = alive[items.window[alive] == depth + 1]
        low_out[done], high_out[done] = low[done], high[done]
        alive = alive[items.window[alive] > depth + 1]
        alive = alive[query[alive + depth + 1] > 0]
    return low_out, high_out


def find_matches(words, items: Suffixes) -> tuple[np.ndarray, ...]:
    """Every place of every window: word number in the shard, item suffix, words matched from there on."""
    n = words.counts()
    ends = np.cumsum(n) + np.arange(len(n))  # a mark after each row
    at = np.arange(len(words.fp)) + words.row
    known, rank = np.unique(words.fp, return_inverse=True)
    text = np.zeros(len(words.fp) + len(n) + 1, np.int64)
    text[at] = rank + 1
    found = np.minimum(np.searchsorted(known, items.fp), max(len(known) - 1, 0))
    query = np.where(known[found] == items.fp, found + 1, 0) if len(known) else np.zeros(len(items.fp), np.int64)
    if not (query > 0).any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), ends
    order = suffix_array(text, len(known), items.depth)
    low, high = search(text, order, query, items)
    many = high - low
    suffix = np.repeat(np.arange(len(many)), many)
    place = order[np.repeat(low, many) + np.arange(len(suffix)) - np.repeat(np.cumsum(many) - many, many)]
    length = items.window[suffix].copy()
    going = np.flatnonzero(items.left[suffix] > length)
    while len(going):
        same = text[place[going] + length[going]] == query[suffix[going] + length[going]]
        same &= query[suffix[going] + length[going]] > 0
        going = going[same]
        length[going] += 1
        going = going[items.left[suffix[going]] > length[going]]
    return place, suffix, length, ends


def _merge(spans: list[tuple[int, int]]) -> list[int]:
    flat: list[int] = []
    for begin, end in sorted(spans):
        if flat and begin <= flat[-1]:
            flat[-1] = max(flat[-1], end)
        else:
            flat += [begin, end]
    return flat


def _batches(shared, kept: list[str]):
    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items: Suffixes = shared.value
        for batch in source:
            data, offsets = text_buffers(batch.column("text"))
            total = np.zeros(len(batch), np.int64)
            spans: list[list[int]] = [[]] * len(batch)
            names: list[list[str]] = [[]] * len(batch)
            longest: list[dict | None] = [None] * len(batch)
            if "spans" in batch.schema.names:  # an earlier block's matches
                spans, names, longest = (batch.column(c).to_pylist() for c in ("spans", "items", "longest"))
            for begin, end in slices(offsets, SHARD_BYTES):
                words = find_words(data, offsets[begin : end + 1], ALNUM)
                n = words.counts()
                total[begin:end] = n
                if not len(items.fp) or not len(words.fp):
                    continue
                place, suffix, length, ends = find_matches(words, items)
                row = np.searchsorted(ends, place, "right")
                place = place - (ends - n)[row]
                by = np.lexsort((suffix, place, row))
                cuts = np.flatnonzero(np.diff(row[by], prepend=-1, append=-1)) if len(by) else np.zeros(0, int)
                for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                    own = by[a:b]
                    r = begin + int(row[own[0]])
                    size = items.window[suffix[own]]
                    steps = np.unique(np.stack([place[own], place[own] + size], axis=1), axis=0)
                    before = list(zip(spans[r][::2], spans[r][1::2], strict=True))
                    spans[r] = _merge([*before, *map(tuple, steps.tolist())])
                    names[r] = sorted({*names[r], *items.names[np.unique(items.item[suffix[own]])]})
                    best = own[np.lexsort((place[own], items.begin[suffix[own]], items.item[suffix[own]], -length[own]))[0]]
                    if longest[r] is None or longest[r]["length"] < length[best]:
                        longest[r] = {
                            "item": items.names[items.item[suffix[best]]],
                            "item_start": int(items.begin[suffix[best]]),
                            "start": int(place[best]),
                            "length": int(length[best]),
                        }
            struct = pa.struct(
                [("item", pa.string()), ("item_start", pa.int64()), ("start", pa.int64()), ("length", pa.int64())]
            )
            columns = {
                **{c: batch.column(c) for c in kept},
                "n_words": pa.array(total),
                "n_hit": pa.array([sum(s[1::2]) - sum(s[::2]) for s in spans], pa.int64()),
                "spans": pa.array(spans, pa.list_(pa.int64())),
                "items": pa.array(names, pa.list_(pa.string())),
                "longest": pa.array(longest, struct),
            }
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return batches


def benchmark_blocks(benchmark: DataFrame, window: int, block_bytes: int = BLOCK_BYTES) -> Iterator[tuple[bool, Suffixes]]:
    """The items in blocks of about ``block_bytes`` of text, one in memory at a time; true with the last."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("name"), "text").where(
        "text IS NOT NULL"
    )
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    for k in range(blocks):
        own = items.where(F.pmod(F.xxhash64("name", "text"), F.lit(blocks)) == k).orderBy("name", "text").collect()
        yield k == blocks - 1, Suffixes([r["name"] for r in own], [r["text"] for r in own], window)


def match_benchmark(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Per row of ``docs(doc_id, text)``: where ``benchmark(item_id, text)`` occurs in it.

    Words are ASCII letters and digits and all other characters beyond ASCII, with A-Z lower-cased.
    A window is ``window`` consecutive words of an item, or the whole item if it is shorter; items
    without words have none. ``spans`` lists the hit words as merged ranges (begin, end, begin, ...),
    ``items`` the items with occurring windows as strings, ``longest`` the longest verbatim match
    (ties: the smaller item name, then the earlier place in the item and in the document). A null
    text has no words. Rows repeat as given; a missing item id is named ``null``. Other columns are
    ignored but for those named in ``carry``, which stay beside the result. The benchmark is the stated query set: it passes in blocks of bounded size, each
    broadcast in turn; reading it runs jobs.
    """
    kept = list(carry) or ["doc_id"]
    state = docs.select("doc_id", "text", *(c for c in kept if c not in ("doc_id", "text")))
    schema = state.schema
    for last, block in benchmark_blocks(benchmark, window, block_bytes):
        shared = docs.sparkSession.sparkContext.broadcast(block)
        names = kept if last else schema.names
        state = state.mapInArrow(_batches(shared, names), T.StructType([schema[c] for c in names] + _STATE.fields))
    return state


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, share: int = 20, carry: Sequence[str] = ()) -> DataFrame:
    """Match counts per document and the verdict: hit words are at least one in ``share`` of its words."""
    return (
        match_benchmark(docs, benchmark, window, carry=carry)
        .select(
            *(carry or ["doc_id"]),
            "n_words",
            "n_hit",
            F.size("items").cast("long").alias("n_items"),
            F.sha2(F.array_join(F.array_sort("items"), ",").cast("binary"), 256).alias("items_sha256"),
            ((F.col("n_hit") > 0) & (F.col("n_hit") * share >= F.col("n_words"))).alias("contaminated"),
            "spans",
            "items",
            "longest",
        )
    )

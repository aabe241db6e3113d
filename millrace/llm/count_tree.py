"""Similarity join of shingle sets over R-trees of count vectors.

Shingles are hashed into groups; a document is the point of its counts by group. Two sets
share at most the sum of the smaller counts, and points under two tree nodes at most the sum of the
smaller upper corners, so a node pair is left as soon as that is less than the overlap its sizes ask for.

Documents with equal sets are one point. Trees are built per shard: a shard holds the points that have a
certain shingle among their first ones (rarest cells first, so that two linked sets always meet in one), and
shards with equal members are one. A small shard is one page of nodes; a large one is cut into pages by
size. Surviving pairs are checked on the full sets. A page with many surviving pairs first gives each
point its best partner and the page's centre; the others are held back, and only those that then join two components are
checked. In large shards the centres of components meet in further turns, and at last all points outside a shard's
largest component meet the others, page by page.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.cluster import checkpointed, narrowed, small_side
from millrace.llm.count_points import PAGE, Tree, closer_pairs, grouped, pack, pack_fine, pairs_with_outsiders, sorted_points, surviving
from millrace.llm.graph import compact, components, name_rows
from millrace.llm.near_dup import _set_batches, confirmed_pairs, shingle_sets
from millrace.llm.words import mix, signed

CELL_BITS = 18  # cells in which shingles are counted, to put rare ones first
MANY = 4  # surviving pairs a point of a page, beyond which only the best are given at first
TURNS = 2  # in which centres of components meet


_U = np.uint64


def _cell_batches(size: int):
    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(1 << CELL_BITS, np.int64)
        for batch in source:
            for _, values, _ in shingle_sets(batch.column("text"), size):
                n += np.bincount((values >> _U(64 - CELL_BITS)).astype(np.int64), minlength=len(n))
        cell = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(n[cell])], names=["cell", "n"])

    return batches


def rarity(docs: DataFrame, size: int) -> np.ndarray:
    """Class of each cell's count of shingles over all documents: its binary logarithm. A table of fixed size."""
    counted = docs.select("text").mapInArrow(_cell_batches(size), "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    out = np.zeros(1 << CELL_BITS, np.uint8)
    for row in counted.collect():
        out[row["cell"]] = int(row["n"]).bit_length()
    return out


def first_shingles(n: int | np.ndarray, percent: int):
    """How many first shingles of a set of ``n`` meet one of every set that is similar enough."""
    return n - (percent * n + 99) // 100 + 1


def _point_batches(size: int, percent: int, shared):
    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rare = shared.value
        for batch in source:
            for begin, values, at in shingle_sets(batch.column("text"), size):
                n = np.diff(at)
                row = np.repeat(np.arange(len(n)), n)
                group = (values >> _U(7)).astype(np.int64)
                own = [group[at[i] : at[i + 1]] for i in range(len(n))]
                by = np.lexsort((values, rare[(values >> _U(64 - CELL_BITS)).astype(np.int64)], row))
                many = np.where(n > 0, first_shingles(n, percent), 0)
                first = by[np.arange(len(values)) - np.repeat(at[:-1], n) < np.repeat(many, n)]
                key_at = np.zeros(len(n) + 1, np.int32)
                np.cumsum(many, out=key_at[1:])
                digest = np.zeros((2, len(n)), _U)
                full = np.flatnonzero(n)
                if len(full):
                    digest[0, full] = np.add.reduceat(mix(values ^ _U(0x5A5A5A5A5A5A5A5A)), at[:-1][full])
                    digest[1, full] = np.add.reduceat(mix(values + _U(0x7654321076543210)), at[:-1][full])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(begin, len(n)),
                        pa.array(n.astype(np.int64)),
                        pa.array(signed(digest[0])),
                        pa.array(signed(digest[1])),
                        pa.array([pack(g) for g in own], pa.binary()),
                        pa.array([pack_fine(g) for g in own], pa.binary()),
                        pa.ListArray.from_arrays(pa.array(key_at), pa.array(signed(values[first]))),
                    ],
                    names=["doc_id", "n_shingles", "d1", "d2", "counts", "fine", "keys"],
                )

    return batches


def _meet_batches(percent: int, page_size: int, many: int):
    """Pairs of each page's points that may link: ``(a, b, later)``; ``later`` marks what a page with many pairs holds back."""

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, pages in grouped(source, page_size):
            ids = batch.column("id").to_numpy()
            part = batch.column("component").to_numpy()
            tree = Tree(batch.column("counts").to_pylist(), batch.column("n_shingles").to_numpy(), pages)
            firsts = np.array(tree.first)
            single = firsts[:-1][np.diff(firsts) == 1]
            left, right = [single], [single]
            for p in np.flatnonzero(np.diff(firsts) > 1).tolist():
                i, j = np.triu_indices(firsts[p + 1] - firsts[p])
                left.append(firsts[p] + i)
                right.append(firsts[p] + j)
            i, j, ratio = surviving(tree, tree, np.concatenate(left), np.concatenate(right), percent)
            i, j = tree.rows[i], tree.rows[j]
            other = part[i] != part[j]
            i, j, ratio = i[other], j[other], ratio[other]
            page = np.searchsorted(pages, i, "right") - 1
            n = np.bincount(page, minlength=len(pages) - 1)
            crowded = n > many * np.diff(pages)
            kept = ~crowded[page]
            if crowded.any():
                degree = np.bincount(i, minlength=len(ids)) + np.bincount(j, minlength=len(ids))
                centre = np.zeros(len(pages) - 1, np.int64)
                for p in np.flatnonzero(crowded).tolist():
                    centre[p] = pages[p] + degree[pages[p] : pages[p + 1]].argmax()
                kept |= (i == centre[page]) | (j == centre[page])
                order = np.argsort(-ratio, kind="stable")
                for side in (i, j):
                    _, best = np.unique(side[order], return_index=True)
                    kept[order[best]] = True
            low, high = np.minimum(ids[i], ids[j]), np.maximum(ids[i], ids[j])
            yield pa.RecordBatch.from_arrays([pa.array(low), pa.array(high), pa.array(~kept)], names=["a", "b", "later"])

    return batches


def similar_sets(docs: DataFrame, size: int = 4, percent: int = 85, page: int = PAGE, many: int = MANY) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` per row of ``docs(doc_id, text)``.

    Shingles are ``size`` words of the text with A-Z lower-cased; a text of fewer words is one shingle; a null or
    empty text has none and is linked with nothing. Two documents are linked if their sets overlap by at least
    ``percent`` of the union; a component is named by the smallest ``doc_id`` reachable. Repeated rows stay and share
    a component, as do rows of one ``doc_id``; the component of a row without ``doc_id`` is null. Other
    columns are ignored. ``page`` and ``many`` change the work, not the result. Runs jobs; tables go to the shared folder.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rare = docs.sparkSession.sparkContext.broadcast(rarity(docs, size))
    fields = "doc_id long, n_shingles long, d1 long, d2 long, counts binary, fine binary, keys array<long>"
    points = checkpointed(docs.mapInArrow(_point_batches(size, percent, rare), fields))
    rare.unpersist()
    rows = points.count()
    digest = ["n_shingles", "d1", "d2"]
    known = points.where("doc_id IS NOT NULL AND n_shingles > 0")
    classes = compact(known.groupBy(*digest).agg(F.min("doc_id").alias("rep")), rows)
    # One point a set: other rows of the same set go, so the wide rows need not move when those are few.
    sized = known.groupBy(*digest).agg(F.min("doc_id").alias("rep"), F.count("*").alias("n")).where("n > 1")
    copies = known.select("doc_id", *digest).join(small_side(sized), digest).where("doc_id <> rep").select("doc_id", *digest).distinct()
    heads = known.join(small_side(copies), ["doc_id", *digest], "left_anti")
    if known.groupBy("doc_id", *digest).count().where("count > 1").take(1):  # repeated rows
        heads = heads.dropDuplicates(["doc_id", *digest])
    heads = compact(heads, rows, 5_000)  # written once: every turn below reads them

    keyed = heads.select(F.col("doc_id").alias("id"), F.explode("keys").alias("key"))
    # Keys move once, ids are hashed after that. Two exclusive sums of the hashes tell members apart, so shards with equal ones become one.
    shard = Window.partitionBy("key")
    sums = (F.bit_xor(F.xxhash64("id", *salt)).over(shard).alias(c) for c, salt in (("x", ()), ("y", (F.lit(1),))))
    members = keyed.repartition("key").select("key", "id", F.count("*").over(shard).alias("n"), *sums).where("n > 1")
    members = compact(members, 20 * rows, 200_000)
    shards = checkpointed(members.groupBy("n", "x", "y").agg(F.min("key").alias("key")).select("key"))
    shared = compact(members.select("key", "id", "n").join(shards, "key", "left_semi"), 20 * rows, 200_000)
    points_of = heads.select(F.col("doc_id").alias("id"), "n_shingles", "counts", "fine")
    look, finer = points_of.drop("fine"), points_of.drop("counts")

    def laid(rows_of: DataFrame, whole: bool = False) -> DataFrame:
        """``rows_of``: a written table."""
        return sorted_points(rows_of.join(narrowed(look, "id", rows_of.select("id")), "id"), whole)

    alone = F.col("id").alias("component")
    small, large = shared.where(F.col("n") <= page), checkpointed(shared.where(F.col("n") > page))
    pairs_type = "a long, b long, later boolean"
    # Those held back are at most half a page for each point.
    met = checkpointed(laid(small.select("key", "id", alone), True).mapInArrow(_meet_batches(percent, page, many), pairs_type))
    first, later = met.where("NOT later").select("a", "b"), met.where("later").select("a", "b").distinct()
    if large.take(1):
        most = laid(large.select("key", "id", alone)).mapInArrow(_meet_batches(percent, page, many), pairs_type)
        first = first.union(most.where("NOT later").select("a", "b"))  # the pages of large shards meet once more below
    found_pairs = checkpointed(closer_pairs(checkpointed(first.distinct()), finer, percent))
    held = large.select("key", "id")
    narrow = found_pairs.union(later)
    ids = narrow.select(F.col("a").alias("doc_id")).union(narrow.select("b")).union(held.select("id")).distinct()
    texts = docs.where("doc_id IS NOT NULL").join(checkpointed(ids), "doc_id", "left_semi")
    sets = compact(texts.mapInArrow(_set_batches(size), "doc_id long, shingles binary"), rows, 2_000)

    links = confirmed_pairs(found_pairs, sets, percent)
    found = components(links)
    seen = found_pairs

    def fresh(pairs: DataFrame) -> DataFrame:
        return checkpointed(closer_pairs(checkpointed(pairs.distinct().join(seen, ["a", "b"], "left_anti")), finer, percent))

    if large.take(1):

        def placed() -> DataFrame:
            named = held.join(found.withColumnRenamed("node", "id"), "id", "left")
            return checkpointed(named.select("key", "id", F.coalesce("component", "id").alias("component")))

        for _ in range(TURNS):
            degrees = links.select(F.col("a").alias("id")).union(links.select("b")).groupBy("id").agg(F.count("*").alias("degree"))
            ranked = placed().join(degrees, "id", "left").withColumn("degree", F.coalesce("degree", F.lit(0)))
            centre = F.max_by("id", F.struct("degree", -F.col("id"))).alias("id")
            centres = checkpointed(ranked.groupBy("key", "component").agg(centre).select("key", "id", "component"))
            several = centres.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
            open_ = laid(checkpointed(centres.join(checkpointed(several), "key", "left_semi")))
            near = open_.mapInArrow(_meet_batches(percent, page, many), pairs_type).where("NOT later").select("a", "b")
            near = fresh(near)
            more = confirmed_pairs(near, sets, percent)
            seen = seen.union(near)
            if not more.take(1):
                break
            links = links.union(more)
            found = components(links)
        named = placed()
        several = named.groupBy("key").agg(F.min("component").alias("a"), F.max("component").alias("b")).where("a <> b")
        open_ = checkpointed(named.join(checkpointed(several.select("key")), "key", "left_semi"))
        near = fresh(pairs_with_outsiders(open_.join(narrowed(points_of, "id", open_.select("id")), "id"), percent, page))
        more = confirmed_pairs(near, sets, percent)
        seen = seen.union(near)
        if more.take(1):
            links = links.union(more)
            found = components(links)
    x, y = (found.select(F.col("node").alias(c), F.col("component").alias(f"in_{c}")) for c in ("a", "b"))
    apart = later.join(x, "a", "left").join(y, "b", "left")
    apart = apart.where(F.coalesce("in_a", "a") != F.coalesce("in_b", "b")).select("a", "b")
    more = confirmed_pairs(fresh(apart), sets, percent)
    if more.take(1):
        found = components(links.union(more))
    members_of = classes.select(F.col("rep").alias("id"), *digest).join(found.withColumnRenamed("node", "id"), "id", "left")
    members_of = members_of.select(*digest, F.coalesce("component", "id").alias("component"))
    return name_rows(points, known, members_of, digest, rows).select("doc_id", "n_shingles", "component_id")

"""Near-duplicate documents by MinHash bands, odd sketches and a check on full sets.

Documents with equal shingle sets form a class; everything after that works on one row per class.
Classes sharing a band of MinHash values are candidates. A candidate pair must first agree by odd
sketch (a bitmap of parities into which all MinHash samples are folded; the population count of
the XOR of two gives the number of differing samples), then is checked on the full sets.

No bucket is expanded into its pairs. Members first meet a few centres of their bucket only, and
the links found are merged into components; members still outside their bucket's largest component meet
more centres of it in a few further turns. In buckets that then hold several components, the
members outside the largest one then meet all members of other components page by page, where counts
of hashed shingles bound the overlap of a pair (``count_points``): sketches of pairs a little below the
threshold cannot be told from those above. Pairs within one component are never compared: they cannot change the result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.cluster import checkpointed, narrowed
from millrace.llm.count_points import pack, pack_fine, pairs_with_outsiders
from millrace.llm.graph import compact, components, name_rows
from millrace.llm.words import SPACED, find_words, grams, mix, signed, slices, text_buffers

BANDS = 40  # a pair at similarity 0.8 shares no band in 5 of 10^6 cases; at 0.9 in one of 10^14
ROWS = 6
SKETCH_BITS = 512
PAIRS_PER_TASK = 4_000  # pairs of full sets that a task compares
ROUNDS = 2  # turns in which members outside a bucket's largest component meet further centres of it
CENTRES = (0, 0x5555555555555555, 0x3333333333333333, 0x0F0F0F0F0F0F0F0F)

_U = np.uint64
_SKETCH = [f"s{i}" for i in range(SKETCH_BITS // 64)]


def max_flips(similarity: float, bands: int = BANDS, rows: int = ROWS, bits: int = SKETCH_BITS) -> int:
    """Largest XOR count that a pair of the given similarity reaches, six standard deviations up."""
    samples = bands * rows
    differing = 2 * samples * (1 - similarity)
    expected = bits / 2 * (1 - math.exp(-2 * differing / bits))
    slope = math.exp(-2 * differing / bits)
    from_samples = slope * 2 * math.sqrt(samples * similarity * (1 - similarity))
    from_folding = math.sqrt(max(bits / 4 * (1 - slope**2), 1.0))
    return math.ceil(expected + 6 * math.hypot(from_samples, from_folding))


def shingle_sets(text: pa.Array, size: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Sorted distinct shingle fingerprints of runs of rows: first row, values, range per row."""
    data, offsets = text_buffers(text)
    for begin, end in slices(offsets):
        values, at, _ = grams(find_words(data, offsets[begin : end + 1], SPACED), size)
        for i in range(end - begin):
            values[at[i] : at[i + 1]].sort()
        new = np.ones(len(values), bool)
        new[1:] = values[1:] != values[:-1]
        new[at[:-1][at[:-1] < len(values)]] = True
        kept = np.zeros(len(values) + 1, np.int64)
        np.cumsum(new, out=kept[1:])
        yield begin, values[new], kept[at]


def _minhashes(values: np.ndarray, first: np.ndarray, samples: int) -> np.ndarray:
    """One row per sample: the least of its permuted fingerprints in each set."""
    low = (values ^ (values >> _U(32))).astype(np.uint32)
    high = (values >> _U(29)).astype(np.uint32)
    factors = (mix(np.arange(1, samples + 1, dtype=_U) * _U(0x9E3779B97F4A7C15)).astype(np.uint32)) | np.uint32(1)
    out = np.empty((samples, len(first)), np.uint32)
    for k in range(samples):
        out[k] = np.minimum.reduceat((low * factors[k]) ^ (high if k & 1 else high >> np.uint32(3)), first)
    return out


def _signature_batches(size: int, bands: int, rows: int):
    samples = bands * rows
    band_ids = mix(np.arange(1, bands + 1, dtype=_U))
    sample_ids = (mix(np.arange(1, samples + 1, dtype=_U) + _U(77)))[:, None]

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            sizes, digests, sketches, keys = [], [], [], []
            counts: list[bytes] = []
            fine: list[bytes | None] = []
            for _, values, at in shingle_sets(batch.column("text"), size):
                n = np.diff(at)
                full = np.flatnonzero(n)
                group = (values >> _U(7)).astype(np.int64)
                counts += [pack(group[at[i] : at[i + 1]]) for i in range(len(n))]
                fine += [pack_fine(group[at[i] : at[i + 1]]) for i in range(len(n))]
                digest = np.zeros((2, len(n)), _U)
                sketch = np.zeros((len(n), SKETCH_BITS // 64), np.int64)
                key = np.zeros((len(n), bands), _U)
                if len(full):
                    first = at[:-1][full]
                    digest[0, full] = np.add.reduceat(mix(values ^ _U(0xA5A5A5A5A5A5A5A5)), first)
                    digest[1, full] = np.add.reduceat(mix(values + _U(0x0123456789ABCDEF)), first)
                    least = _minhashes(values, first, samples)
                    bit = (mix(least.astype(_U) ^ sample_ids) & _U(SKETCH_BITS - 1)).astype(np.int64)
                    cell = (np.arange(len(full)) * SKETCH_BITS)[None, :] + bit
                    parity = np.bincount(cell.ravel(), minlength=len(full) * SKETCH_BITS) & 1
                    packed = np.packbits(parity.astype(np.uint8).reshape(len(full), SKETCH_BITS), axis=1)
                    sketch[full] = packed.view(np.int64)
                    joined = np.broadcast_to(band_ids[:, None], (bands, len(full))).copy()
                    for r in range(rows):
                        joined = mix(joined * _U(0x9E3779B97F4A7C15) + least[r::rows][:bands].astype(_U))
                    key[full] = joined.T
                sizes.append(n)
                digests.append(digest)
                sketches.append(sketch)
                keys.append(key)
            if not sizes:
                continue
            n = np.concatenate(sizes)
            digest = np.concatenate(digests, axis=1)
            sketch = np.concatenate(sketches)
            key = np.concatenate(keys)[n > 0]
            list_at = np.zeros(len(n) + 1, np.int32)
            np.cumsum(np.where(n > 0, bands, 0), out=list_at[1:])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    pa.array(n.astype(np.int64)),
                    pa.array(signed(digest[0])),
                    pa.array(signed(digest[1])),
                    *(pa.array(np.ascontiguousarray(sketch[:, i])) for i in range(len(_SKETCH))),
                    pa.ListArray.from_arrays(pa.array(list_at), pa.array(signed(key.ravel()))),
                    pa.array(counts, pa.binary()),
                    pa.array(fine, pa.binary()),
                ],
                names=["doc_id", "n_shingles", "d1", "d2", *_SKETCH, "bands", "counts", "fine"],
            )

    return batches


def signatures(docs: DataFrame, size: int, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """Set size, set digest, odd sketch, band keys and counts by group of every row of ``docs(doc_id, text)``."""
    fields = ["doc_id long", "n_shingles long", "d1 long", "d2 long", *(f"{s} long" for s in _SKETCH)]
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _signature_batches(size, bands, rows), ", ".join(fields) + ", bands array<long>, counts binary, fine binary"
    )


def _set_batches(size: int):
    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            blobs: list[bytes] = []
            for _, values, at in shingle_sets(batch.column("text"), size):
                blobs += [values[at[i] : at[i + 1]].tobytes() for i in range(len(at) - 1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(blobs, pa.binary())], names=["doc_id", "shingles"]
            )

    return batches


def _confirm_batches(percent: int):
    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            good = np.zeros(len(batch), bool)
            for i, (x, y) in enumerate(zip(batch.column("x"), batch.column("y"), strict=True)):
                left, right = np.frombuffer(x.as_buffer(), _U), np.frombuffer(y.as_buffer(), _U)
                both = np.concatenate([left, right])
                both.sort()
                shared = int(np.count_nonzero(both[1:] == both[:-1]))
                good[i] = 100 * shared >= percent * (len(both) - shared)
            yield pa.RecordBatch.from_arrays(
                [batch.column("a").filter(pa.array(good)), batch.column("b").filter(pa.array(good))], names=["a", "b"]
            )

    return batches


def confirmed_pairs(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of ``pairs(a, b)``, a written table, that overlap by ``percent``; by ``sets(doc_id, shingles)``. Runs jobs."""
    tasks = max(1, -(-pairs.count() // PAIRS_PER_TASK))
    sets = narrowed(sets, "doc_id", pairs.select("a").union(pairs.select("b")))
    x = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("x"))
    y = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("y"))
    both = pairs.join(x, "a").join(y, "b").coalesce(tasks)
    return checkpointed(both.mapInArrow(_confirm_batches(percent), "a long, b long"))


def _alike(x: str, y: str, percent: int, flips: int) -> Column:
    """Sizes that allow the similarity, and sketches that differ little enough."""
    differing = sum((F.bit_count(F.col(f"{x}.{s}").bitwiseXOR(F.col(f"{y}.{s}"))) for s in _SKETCH), F.lit(0))
    sizes = (F.col(f"{x}.n_shingles") * 100 >= F.col(f"{y}.n_shingles") * percent) & (
        F.col(f"{y}.n_shingles") * 100 >= F.col(f"{x}.n_shingles") * percent
    )
    return sizes & (differing <= flips)


def _pick(column: str, mask: int) -> Column:
    """The number nearest to ``mask`` in its bits: another member for another mask, found by a plain minimum."""
    bits = F.lit(mask).cast("long")
    return F.min(F.col(column).bitwiseXOR(bits)).bitwiseXOR(bits)


def near_duplicates(
    docs: DataFrame, size: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` per row of ``docs(doc_id, text)``.

    Shingles are ``size`` words of the text with A-Z lower-cased; a text of fewer words is one
    shingle; a null or empty text has none and is linked with nothing. Two documents are linked if
    their sets overlap by at least ``percent`` of the union; a component is named by its smallest
    ``doc_id``, and that document is kept. Repeated rows stay rows and share a component, as do
    rows of one ``doc_id``; a row without ``doc_id`` is alone, its component is null, and is kept.
    Other columns are ignored. Runs jobs; tables go to the shared folder.
    """
    docs = docs.select("doc_id", "text")
    signed_rows = checkpointed(signatures(docs, size, bands, rows))
    known = signed_rows.where("doc_id IS NOT NULL AND n_shingles > 0")
    digest = ["n_shingles", "d1", "d2"]
    size_of = signed_rows.count()
    classes = compact(known.groupBy(*digest).agg(F.min("doc_id").alias("rep")), size_of)
    # One row per class and band; repeated rows of a document do not count twice.
    heads = compact(
        known.join(classes.withColumnRenamed("rep", "doc_id"), [*digest, "doc_id"], "left_semi").dropDuplicates(
            [*digest, "doc_id"]
        ),
        size_of,
        5_000,
    )
    keyed = heads.select(F.col("doc_id").alias("id"), F.explode("bands").alias("key"))
    firsts = [_pick("id", m).alias(f"c{i}") for i, m in enumerate(CENTRES)]
    buckets = keyed.groupBy("key").agg(F.count("*").alias("n"), *firsts).where("n > 1")
    shared = compact(keyed.join(buckets, "key"), size_of * bands, 200_000)
    flips = max_flips(percent / 100, bands, rows)
    look = heads.select(F.col("doc_id").alias("id"), "n_shingles", *_SKETCH)

    candidates = compact(shared.select("id").distinct(), size_of)
    n_shared = shared.count()
    texts = docs.where("doc_id IS NOT NULL").join(candidates.withColumnRenamed("id", "doc_id"), "doc_id", "left_semi")
    with_heads = texts.mapInArrow(_set_batches(size), "doc_id long, shingles binary").join(
        look.select(F.col("id").alias("doc_id")), "doc_id", "left_semi"
    )
    sets = compact(with_heads, size_of, 2_000)

    def confirmed(pairs: DataFrame) -> DataFrame:
        return confirmed_pairs(compact(pairs, n_shared), sets, percent)

    def with_centres(rows_of: DataFrame, masks: Sequence[int]) -> DataFrame:
        """Pairs of a row and, for each mask, one centre of all its buckets."""
        picked = [_pick(f"c{i}", m) for i, m in enumerate(masks)]
        return (
            rows_of.groupBy("id")
            .agg(F.array_distinct(F.array(*picked)).alias("picked"))
            .select("id", F.explode("picked").alias("other"))
            .where("id <> other")
            .select(F.least("id", "other").alias("a"), F.greatest("id", "other").alias("b"))
            .distinct()
        )

    def alike_pairs(pairs: DataFrame) -> DataFrame:
        return (
            pairs.join(look.alias("x"), F.col("a") == F.col("x.id"))
            .join(look.alias("y"), F.col("b") == F.col("y.id"))
            .where(_alike("x", "y", percent, flips))
            .select("a", "b")
        )

    links = confirmed(alike_pairs(with_centres(shared, CENTRES)))
    found = components(links)

    def labelled(rows_of: DataFrame) -> DataFrame:
        return rows_of.join(found.withColumnRenamed("node", "id"), "id", "left").withColumn(
            "component", F.coalesce("component", "id")
        )

    opened = shared.select("key", "id")

    def open_rows() -> DataFrame:
        """Rows ``(key, id, component)`` of the buckets that hold several components; one that has closed stays so."""
        nonlocal opened
        placed = compact(labelled(opened), n_shared)
        several = placed.groupBy("key").agg(F.min("component").alias("a"), F.max("component").alias("b")).where("a <> b")
        placed = checkpointed(placed.join(checkpointed(several.select("key")), "key", "left_semi"))
        opened = placed.select("key", "id")
        return placed

    def open_buckets() -> tuple[DataFrame, DataFrame]:
        """Open rows with the largest component of their bucket; those outside it."""
        placed = open_rows()
        parts = checkpointed(placed.groupBy("key", "component").agg(F.count("*").alias("n")))
        main = parts.groupBy("key").agg(F.max_by("component", F.struct("n", "component")).alias("main"))
        rows_of = checkpointed(placed.join(checkpointed(main), "key"))
        return rows_of, rows_of.where("component <> main")

    for turn in range(ROUNDS):
        rows_of, outside = open_buckets()
        masks = [int(m >> _U(2)) for m in mix(np.arange(1, 9, dtype=_U) + _U(100 * turn))]
        chosen = rows_of.where("component = main").groupBy("key").agg(
            *(_pick("id", m).alias(f"c{i}") for i, m in enumerate(masks))
        )
        near = with_centres(outside.select("key", "id").join(chosen, "key"), masks)
        more = confirmed(alike_pairs(near))
        if not more.take(1):
            break
        links = links.union(more)
        found = components(links)
    points = heads.select(F.col("doc_id").alias("id"), "n_shingles", "counts", "fine")
    more = confirmed(pairs_with_outsiders(open_rows().join(points, "id"), percent))
    if more.take(1):
        found = components(links.union(more))
    members = labelled(classes.select(F.col("rep").alias("id"), *digest)).select(*digest, "component")
    return name_rows(signed_rows, known, members, digest, size_of).withColumn(
        "kept", F.coalesce(F.col("component_id") == F.col("doc_id"), F.lit(True))
    )

"""The numbered queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.count_tree import similar_sets
from millrace.llm.ctw import ctw_scores
from millrace.llm.decontaminate import contamination
from millrace.llm.extract import extract_text
from millrace.llm.hard_negatives import hard_negatives
from millrace.llm.licenses import PERCENT, TEMPLATES, license_scan, need
from millrace.llm.near_dup import near_duplicates
from millrace.llm.packing import pack
from millrace.llm.quality import quality_verdicts
from millrace.llm.toxicity import fit, score_toxicity
from millrace.llm.url_filter import filter_urls
from millrace.llm.warc import archived
from millrace.llm.whiten import whitened


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: str = "doc_id") -> Column:
    """Remainder by 5 of the checksum of the id's text."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(5))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    index = fit(docs, labels.where(fold() != 0))
    scored = score_toxicity(docs, index)
    held_out = F.coalesce(fold() == 0, F.lit(False))  # a row without an id is in no fold
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted", "evidence")


def vocabulary() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), vocabulary())


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_verdicts(table(spark, sf_dir, "documents"))


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archived(table(spark, sf_dir, "pages")).drop("url")


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = ctw_scores(table(spark, sf_dir, "documents"), fold() != 1, F.col("lang"), across=True)
    columns = ["n_tokens", "n_known", "train_tokens", "base_score", "score", "n_bytes"]
    return scored.select("doc_id", (fold() == 1).alias("held_out"), *columns)


def op9_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents"))


def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), size=4, percent=80)


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(table(spark, sf_dir, "embeddings"), components=4)


def op12_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_sets(table(spark, sf_dir, "documents"), size=4, percent=85)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf_dir, "embeddings").withColumn("label", moved), F.col("vec_id") % 100 == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_html_extraction": op3_html_extraction,
    "op4_quality_rules": op4_quality_rules,
    "op5_benchmark_decontamination": op5_benchmark_decontamination,
    "op6_url_filters": op6_url_filters,
    "op7_warc": op7_warc,
    "op8_lm_scoring": op8_lm_scoring,
    "op9_license_scans": op9_license_scans,
    "op10_minhash_near_dedup": op10_minhash_near_dedup,
    "op11_embedding_whitening": op11_embedding_whitening,
    "op12_ngram_jaccard_join": op12_ngram_jaccard_join,
    "op13_hard_negatives": op13_hard_negatives,
}
OP7_SQL = """
WITH page AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
hashed AS (SELECT page_id, octet_length(encode(html)) AS payload_bytes, sha1(html) AS hex FROM page),
grouped AS (SELECT *, min(page_id) OVER (PARTITION BY hex, payload_bytes) AS first FROM hashed)
SELECT page_id, payload_bytes,
  array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((('0x' || substr(hex, 1 + 5 * (i // 4), 5))::BIGINT >> (15 - 5 * (i % 4))) & 31), 1) for i in range(32)], '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM grouped
"""

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_WORDS = r"regexp_extract_all(translate({}, '" + _UPPER + "', '" + _UPPER.lower() + r"'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_TEMPLATE_ROWS = ", ".join(
    f"({i}, '{label}', {sorted(set(text.split()))}, {need(len(set(text.split())), PERCENT)}, {len(text.split())}, "
    f"{must.split()}::VARCHAR[], {without.split()}::VARCHAR[])"
    for i, (label, text, must, without) in enumerate(TEMPLATES)
)
OP9_SQL = f"""
WITH template(id, label, words, need, length, must, without) AS (VALUES {_TEMPLATE_ROWS}),
doc AS (SELECT doc_id, coalesce(text, '') AS text, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
spot AS (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS i FROM doc),
place AS (SELECT doc_id, i, CASE WHEN four = 'under the mit license' THEN 'mit' WHEN four = 'apache license version 2' THEN 'apache-2'
    WHEN four = 'cc by nc' OR starts_with(four, 'cc by nc ') THEN 'cc-by-nc' END AS label
  FROM (SELECT doc_id, i, concat_ws(' ', word, lead(word) OVER o, lead(word, 2) OVER o, lead(word, 3) OVER o) AS four
    FROM spot WINDOW o AS (PARTITION BY doc_id ORDER BY i))),
base AS (SELECT doc_id, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word,
  list_sort(list(DISTINCT label)) AS labels FROM place WHERE label IS NOT NULL GROUP BY doc_id),
token AS (SELECT id, length, unnest(words) AS word, true AS own FROM template
  UNION ALL SELECT id, length, unnest(without), false FROM template),
held AS (SELECT DISTINCT doc_id, id, word, own, unnest([i // length - 1, i // length]) AS k FROM spot JOIN token USING (word)),
block AS (SELECT doc_id, id, count(*) FILTER (own) AS shared, list(word) AS b FROM held WHERE k >= 0 GROUP BY doc_id, id, k HAVING bool_and(own)),
met AS (SELECT doc_id, label, shared, len(words) AS size, need FROM block JOIN template USING (id) WHERE list_has_all(b, must)),
more AS (SELECT doc_id, list(DISTINCT label) AS labels, max(shared / size) AS score FROM met WHERE shared >= need GROUP BY doc_id)
SELECT doc.doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
  coalesce(array_to_string(base.labels, ','), '') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(more.labels, [])))), ',') AS labels,
  CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(more.score, 0.0)::DOUBLE END AS score
FROM doc LEFT JOIN base USING (doc_id) LEFT JOIN more USING (doc_id)
"""

OP5_SQL = f"""
WITH item AS (SELECT coalesce(item_id::VARCHAR, 'null') AS name, {_WORDS.format("text")} AS q FROM benchmark WHERE text IS NOT NULL),
sized AS (SELECT name, q, least(13, len(q)) AS size FROM item WHERE len(q) > 0),
win AS (SELECT DISTINCT name, size, array_to_string(q[i:i + size - 1], ' ') AS gram
  FROM (SELECT *, unnest(range(1, len(q) - size + 2)) AS i FROM sized)),
doc AS (SELECT doc_id, coalesce({_WORDS.format("text")}, []) AS w FROM documents),
place AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM doc),
size AS (SELECT DISTINCT size FROM win),
gram AS (SELECT doc_id, i, size, array_to_string(w[i:i + size - 1], ' ') AS gram FROM place, size WHERE i + size - 1 <= len(w)),
hit AS (SELECT doc_id, i, gram.size, name FROM gram JOIN win ON win.gram = gram.gram AND win.size = gram.size),
word AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS k FROM hit) GROUP BY doc_id),
found AS (SELECT doc_id, list_sort(list(DISTINCT name)) AS names FROM hit GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(len(names), 0) AS n_items,
  sha256(coalesce(array_to_string(names, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * n_hit >= len(w) AS contaminated
FROM doc LEFT JOIN word USING (doc_id) LEFT JOIN found USING (doc_id)
"""

_SPACED = _WORDS.replace(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", r"[^\x20\x09-\x0D]+")
OP10_SQL = f"""
WITH RECURSIVE doc AS (SELECT doc_id, coalesce({_SPACED.format("text")}, []) AS w FROM documents),
gram AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM doc WHERE len(w) > 0)),
size AS (SELECT doc_id, count(*) AS n FROM gram GROUP BY doc_id),
pair AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared FROM gram a JOIN gram b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
link AS (SELECT x, y FROM pair JOIN size s ON s.doc_id = x JOIN size t ON t.doc_id = y WHERE 100 * shared >= 80 * (s.n + t.n - shared)),
reach(x, y) AS (SELECT x, y FROM link UNION SELECT r.x, l.y FROM reach r JOIN link l ON r.y = l.x),
least_of AS (SELECT x AS doc_id, min(y) AS y FROM reach GROUP BY x)
SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(y, doc_id)) AS component_id,
  doc_id <= coalesce(y, doc_id) AS kept
FROM doc LEFT JOIN size USING (doc_id) LEFT JOIN least_of USING (doc_id)
"""

OP12_SQL = OP10_SQL.replace(">= 80 *", ">= 85 *").replace("AS component_id,\n  doc_id <= coalesce(y, doc_id) AS kept", "AS component_id")
OP13_SQL = """
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, list_dot_product(a.x, b.x)::BIGINT AS score
  FROM e a JOIN e b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positive AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id, (row_number() OVER w)::INTEGER AS rank, id AS negative_id, positive_score, score AS negative_score
FROM positive JOIN scored USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) QUALIFY rank <= 10
"""

ORACLE_SQL: dict[str, str] = {
    "op5_benchmark_decontamination": OP5_SQL,
    "op7_warc": OP7_SQL,
    "op9_license_scans": OP9_SQL,
    "op10_minhash_near_dedup": OP10_SQL,
    "op12_ngram_jaccard_join": OP12_SQL,
    "op13_hard_negatives": OP13_SQL,
}

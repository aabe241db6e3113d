"""Training corpus in five stages; each is written as Parquet and read again as the next one's input."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.cluster import checkpointed
from millrace.llm.decontaminate import contamination
from millrace.llm.near_dup import near_duplicates
from millrace.llm.packing import pack
from millrace.llm.quality import quality_verdicts
from millrace.llm.queries import fold, table, vocabulary
from millrace.llm.toxicity import fit, toxicity_rate


def aside(docs: DataFrame) -> DataFrame:
    """The same columns; those that no operator reads get names that no operator uses."""
    read = ("doc_id", "text", "lang", "source")
    return docs.select(*(F.col(f"`{c}`").alias(c if c in read else f"_column{i}") for i, c in enumerate(docs.columns)))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted as toxic go; the classifier learns as the query of the operator does.

    A null or empty text has the rate of examples without terms, so it stays; the other columns do not matter. The result
    is written here, in batches of bounded size.
    """
    index = fit(docs, table(spark, sf_dir, "labels").where(fold() != 0))
    return checkpointed(docs.where(toxicity_rate(spark, index) < 0.5))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules, and outliers of their language and source, go."""
    rows = aside(docs)
    return quality_verdicts(rows, carry=rows.columns).toDF(*docs.columns)


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays; rows without an id stay.

    Of several rows with one id that stays, the first by their other columns in order does.
    """
    kept = near_duplicates(docs).where("kept AND doc_id IS NOT NULL").select("doc_id").distinct()
    others = [c for c in docs.columns if c != "doc_id"]
    first = docs.join(kept, "doc_id", "left_semi").groupBy("doc_id").agg(F.min(F.struct(*others)).alias("_first"))
    named = first.select(*(F.col(c) if c == "doc_id" else F.col(f"_first.{c}").alias(c) for c in docs.columns))
    return named.union(docs.where("doc_id IS NULL"))


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark passages go. The result is written here, in batches of bounded size."""
    rows = aside(docs)
    found = contamination(rows, table(spark, sf_dir, "benchmark"), carry=rows.columns)
    return checkpointed(found.where("NOT contaminated").select(*rows.columns).toDF(*docs.columns))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in sequences; a null text is a piece of the end id alone."""
    return pack(docs, vocabulary())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity),
    ("quality rules", quality_rules),
    ("MinHash near-dedup", minhash_near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("best-fit packing", best_fit_packing),
]

# Their results are written tables already.
WRITTEN = (toxicity, benchmark_decontamination)

# Neither the nearest labelled examples nor the packing can be stated in SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        kept = stage(spark, docs, sf_dir)
        docs = kept if stage in WRITTEN else checkpointed(kept)
    return STAGES[-1][1](spark, docs, sf_dir)

"""The numbered queries and the pipeline on the smallest tables."""

import os

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from millrace import cluster
from millrace.cluster import checkpointed
from millrace.llm.decontaminate import contamination
from millrace.llm.near_dup import near_duplicates
from millrace.llm.quality import quality_verdicts
from millrace.llm.queries import ORACLE_SQL, QUERIES, fold, table
from millrace.llm.toxicity import fit, score_toxicity
from tools.check import TABLES, canonical

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")


def test_all_are_registered():
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(queries()) and set(ORACLE_SQL) <= set(oracle_sql())
    assert len(corpus_pipeline.STAGES) == 5


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    df = QUERIES[name](spark, SF_DIR)
    result = con.execute(ORACLE_SQL[name])
    columns = [d[0] for d in result.description]
    assert canonical([tuple(r) for r in df.collect()], df.columns) == canonical(result.fetchall(), columns)


def test_pipeline_stages_take_effect(spark):
    docs = table(spark, SF_DIR, "documents")
    kept = {r.doc_id for r in docs.select("doc_id").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        # What the operator says about the rows that the stage is given.
        if name == "toxicity":
            scored = score_toxicity(docs, fit(docs, table(spark, SF_DIR, "labels").where(fold() != 0)))
            kept = {r.doc_id for r in scored.collect() if not r.predicted}
        elif name == "quality rules":
            kept = {r.doc_id for r in quality_verdicts(docs).collect() if r.kept}
        elif name == "MinHash near-dedup":
            kept = {r.doc_id for r in near_duplicates(docs).collect() if r.kept}
        else:
            kept = {r.doc_id for r in contamination(docs, table(spark, SF_DIR, "benchmark")).collect() if not r.contaminated}
        after = checkpointed(stage(spark, docs, SF_DIR))
        assert after.columns == docs.columns
        rows = [r.doc_id for r in after.collect()]
        assert sorted(rows) == sorted(kept)
        docs = after
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).collect()
    assert {r.doc_id for r in packed} == kept
    assert {(r.doc_id, r.piece) for r in corpus_pipeline.run(spark, SF_DIR).collect()} == {(r.doc_id, r.piece) for r in packed}


def test_batches_for_python_are_bounded_by_bytes(spark):
    def sizes(source):
        for batch in source:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], names=["n"])

    wide = spark.range(0, 400, 1, 1).select(F.repeat(F.lit("x"), 100_000).alias("text"))
    before = spark.conf.get(cluster.ARROW_BYTES, None)
    most = cluster.checkpointed(wide.mapInArrow(sizes, "n long")).agg(F.max("n")).first()[0]
    assert most < 2 * cluster.BATCH_BYTES and spark.conf.get(cluster.ARROW_BYTES, None) == before

"""Tables in shared storage and size-checked broadcasts."""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

# Upper row count and file size of a table that may be shipped to every executor.
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 16 << 20
# Bytes of scanned input for each partition of a wide shuffle.
TASK_BYTES = 16 << 20
MAX_PARTITIONS = 20_000
# A source of unknown size counts as the largest number.
UNKNOWN_BYTES = 1 << 60
# Bytes of a batch that goes to Python, where rows are wide; the other bound is Spark's number of rows.
BATCH_BYTES = 4 << 20
ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
FILE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Inputs rendered by this application: what and where.
_rendered: dict[tuple[str, str, str], str] = {}
# Names of its bucketed tables.
_tables: dict[str, list[str]] = {}


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach: the session's ``spark.checkpoint.dir``.

    Only where that is unset (plain local runs) a folder on this machine is used.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        root = spark.sparkContext.getCheckpointDir()
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="millrace-")
        spark.sparkContext.setCheckpointDir(root)
    return root


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, in this application's own part of it."""
    app = spark.sparkContext.applicationId
    return f"{shared_root(spark).rstrip('/')}/millrace/{app}/{name}-{uuid.uuid4().hex}"


def _on_store(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    where, store = _on_store(spark, path)
    return store.exists(where)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of what a folder holds; none if there is no folder."""
    where, store = _on_store(spark, path)
    return [f.getPath().getName() for f in store.listStatus(where)] if store.exists(where) else []


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a folder; nothing happens if there is none."""
    where, store = _on_store(spark, path)
    store.delete(where, True)


def drop_shared(spark: SparkSession) -> None:
    """Delete the tables this application wrote to the shared folder; call it when the job is done."""
    app = spark.sparkContext.applicationId
    drop_path(spark, f"{shared_root(spark).rstrip('/')}/millrace/{app}")
    for key in [k for k in _rendered if k[0] == app]:
        del _rendered[key]
    for name in _tables.pop(app, []):
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def rendered(spark: SparkSession, source: str, name: str, write: Callable[[str], None]) -> str:
    """Path of an input that is written once per application, until ``drop_shared``."""
    key = (spark.sparkContext.applicationId, source, name)
    if key not in _rendered:
        path = shared_path(spark, name)
        write(path)
        _rendered[key] = path
    return _rendered[key]


def checkpointed(df: DataFrame) -> DataFrame:
    """Write ``df`` to a table in the shared folder and read it back.

    Cuts lineage and survives lost executors like a checkpoint; unlike one, it is
    columnar and its size is known to the planner, so later joins against a
    small result need no shuffle. The shuffle files of the job go when it ends, since nothing reads them again.
    Its batches for Python hold about ``BATCH_BYTES``, so that a task's memory does not follow the width of the rows.
    """
    return written(df, shared_path(df.sparkSession, "cut"))


def written(df: DataFrame, path: str) -> DataFrame:
    """``checkpointed`` with a folder of the caller's, which the caller drops; a table already there is replaced."""
    spark = df.sparkSession
    with _setting(spark, FILE_CLEANUP, "true"), _setting(spark, ARROW_BYTES, str(BATCH_BYTES)):
        df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def collected(df: DataFrame) -> list[Row]:
    """The rows of a small result, by a job whose batches for Python hold about ``BATCH_BYTES`` like those of ``checkpointed``."""
    with _setting(df.sparkSession, ARROW_BYTES, str(BATCH_BYTES)):
        return df.collect()


def evaluated(df: DataFrame, *columns: Column | str) -> DataFrame:
    """Select ``columns``, which later filters and aggregates use as they stand instead of computing them again."""
    return df.select(F.inline(F.array(F.struct(*columns))))


def scanned_bytes(df: DataFrame) -> int:
    """Size of the tables and files that the plan reads, as far as Spark knows it."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = (int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    return sum(s for s in sizes if s < UNKNOWN_BYTES)


@contextmanager
def _setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A session setting for the jobs run within."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


SHUFFLES = "spark.sql.shuffle.partitions"


def wide_partitions(df: DataFrame, copies: int = 1) -> int:
    """The session's shuffle partitions, or one per ``TASK_BYTES`` that ``df`` reads if those are more.

    ``copies`` is the number of rows that the shuffle's tasks make of each row.
    """
    wanted = min(math.ceil(copies * scanned_bytes(df) / TASK_BYTES), MAX_PARTITIONS)
    return max(int(df.sparkSession.conf.get(SHUFFLES)), wanted)


@contextmanager
def wide_shuffles(df: DataFrame) -> Iterator[None]:
    """Shuffles of the jobs run within have at least one partition per ``TASK_BYTES`` that ``df`` reads.

    So what a task holds does not grow with the input; AQE puts small partitions together. The setting is put back.
    """
    with _setting(df.sparkSession, SHUFFLES, str(wide_partitions(df))):
        yield


def bucketed(df: DataFrame, *by: str) -> DataFrame:
    """Write ``df`` to the shared folder as one sorted bucket per shuffle partition, and read it back.

    Joins and aggregates by all of ``by`` then read the table where it lies. Each bucket comes from one
    task, so a key of unbounded size needs a further column in ``by`` that splits it.
    """
    spark = df.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"millrace_{uuid.uuid4().hex}"
    laid_out = df.repartition(buckets, *by).write.bucketBy(buckets, *by).sortBy(*by)
    laid_out.format("parquet").option("path", shared_path(spark, "buckets")).saveAsTable(name)
    _tables.setdefault(spark.sparkContext.applicationId, []).append(name)
    return spark.table(name)


def broadcast_if_small(df: DataFrame, max_rows: int | None = None) -> DataFrame:
    """Hint a broadcast only after a check of size and rows; otherwise leave the join to AQE. Runs a job.

    ``df`` should be a written table: cheap to read again, and its size is that of its files.
    """
    limit = BROADCAST_ROWS if max_rows is None else max_rows
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    small = size <= BROADCAST_BYTES and df.limit(limit + 1).count() <= limit
    return F.broadcast(df) if small else df


def narrowed(wide: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    """``wide`` for a join by ``column`` with ``ids``, a written table of one column: where those are few, without the other rows.

    They are picked where they lie, so that the join moves no others. Otherwise ``wide`` comes back as it is. Runs a job.
    """
    if ids.count() > BROADCAST_ROWS:
        return wide
    return wide.join(F.broadcast(ids.toDF(column).distinct()), column, "left_semi")


def small_side(df: DataFrame, max_rows: int | None = None) -> DataFrame:
    """Compute a reduced join side once, then broadcast it if it is small. Runs jobs.

    Keeps the big side of the join from being shuffled on a skewed key just
    because Spark cannot estimate the size of an aggregate. A larger side is a plain table, so AQE can
    split a skewed key of the join.
    """
    return broadcast_if_small(checkpointed(df), max_rows)

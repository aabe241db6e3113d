"""Session settings the pipelines are written for."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def build_session(app_name: str = "millrace", cores: int | str | None = None) -> SparkSession:
    """Local session for tests and benchmarks.

    On a cluster, submit with the same SQL settings and size
    ``spark.sql.shuffle.partitions`` to the input (about 128 MB per task);
    AQE then coalesces small partitions and splits skewed joins.
    """
    cores = cores or os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", os.environ.get("MILLRACE_DRIVER_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark

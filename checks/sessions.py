"""Local session for tests, comparison and bench."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(name: str, cores: str | None = None) -> SparkSession:
    cores = cores or os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # tests look up plans of executions in Spark's store, which forgets all but 1,000
        .config("spark.sql.ui.retainedExecutions", "5000")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark

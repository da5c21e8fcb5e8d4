"""Crawl cache and similar-item tables."""

from __future__ import annotations

import warnings

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StringType, StructType

from tagweave.operators.crawl import upsert_cache
from tagweave.schemas import CRAWL_CACHE


def read_cache(
    spark: SparkSession, path: str, format: str = "parquet", damaged: str = "error"
) -> DataFrame:
    """The cache table, Parquet, JSON lines or one JSON ``object``; empty when it is absent.

    The cache is read whole or not at all: a damaged file or line is an error, or, with
    ``damaged="empty"``, the whole cache counts as empty. A part of it is never taken for all,
    which the next write would make final. That choice costs a pass over the cache.
    """
    if damaged not in ("error", "empty"):
        raise ValueError('damaged is "error" or "empty"')
    try:
        if format == "object":
            rows = _read_object(spark, path)
        else:
            rows = spark.read.schema(CRAWL_CACHE).option("mode", "FAILFAST").format(format).load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], CRAWL_CACHE)
    if damaged == "empty":
        try:
            rows.write.format("noop").mode("overwrite").save()
        except Exception as error:  # noqa: BLE001 - whatever reader or parser raised
            warnings.warn(f"the cache at {path} counts as empty: {str(error)[:200]}", stacklevel=2)
            return spark.createDataFrame([], CRAWL_CACHE)
    return rows


def _read_object(spark: SparkSession, path: str) -> DataFrame:
    """One JSON object from key to entry; entries that are null were looked up and not found."""
    entry = StructType([f for f in CRAWL_CACHE.fields if f.name not in ("cache_key", "found")])
    whole = spark.read.text(path, wholetext=True)
    entries = F.from_json("value", MapType(StringType(), entry), {"mode": "FAILFAST"})
    found = F.col("e").isNotNull()
    return whole.select(F.explode(entries).alias("cache_key", "e")).select(
        "cache_key", found.alias("found"), *[F.col(f"e.{c}").alias(c) for c in entry.names]
    )


def write_cache(
    cache: DataFrame, fetched: DataFrame, path: str, format: str = "parquet"
) -> None:
    """Old entries plus new ones, written to a new path: readers of the old one are not
    disturbed. A cache that cannot be read whole fails here and nothing replaces it."""
    upsert_cache(cache, fetched).write.format(format).save(path)


def write_similar(edges: DataFrame, path: str) -> None:
    edges.write.parquet(path)

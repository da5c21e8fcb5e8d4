"""External feeds: several optional JSON sources in a fixed order."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, VariantType

from tagweave.functions.params import parse_int
from tagweave.schemas import EXTERNAL_FEED, EXTERNAL_RECORD
from tagweave.sources.json_array import array_records


def _path_missing(error: AnalysisException) -> bool:
    return (error.getCondition() or "") == "PATH_NOT_FOUND"


def read_external_feed(spark: SparkSession, paths: list[str]) -> DataFrame | None:
    """Records of all JSON-array files that exist, ranked by their place in ``paths``.

    A path may be a file or a folder of files. ``record_seq`` follows the files' names and the
    records' order in them, and neither the number nor the packing of tasks; large files are read
    by several. A file that is no valid JSON is an error. Counters may be numbers or text: numbers
    lose their fraction.
    """
    counters = ("playcount", "listeners")
    read_as = StructType(
        [StructField(f.name, VariantType()) if f.name in counters else f for f in EXTERNAL_RECORD]
    )
    found = []
    for rank, path in enumerate(paths):
        try:
            records = array_records(spark, path)
        except AnalysisException as error:
            if not _path_missing(error):
                raise
            continue
        parsed = F.from_json("record", read_as, {"mode": "FAILFAST"})
        found.append(
            records.select("record_seq", parsed.alias("r"))
            .select("record_seq", "r.*")
            .select(
                F.lit(rank).alias("source_rank"),
                "record_seq",
                *[_counter(c) if c in counters else F.col(c) for c in EXTERNAL_RECORD.names],
            )
        )
    return reduce(DataFrame.unionByName, found) if found else None


def _counter(name: str) -> Column:
    """A JSON counter as text: strings as they are, numbers and booleans as whole numbers."""
    value = F.col(name)
    number = F.coalesce(F.try_variant_get(value, "$", "double"), F.lit(0.0))
    exact = F.try_variant_get(value, "$", "bigint")
    kind = F.schema_of_variant(value)
    text = (
        F.when(kind == "STRING", F.try_variant_get(value, "$", "string"))
        .when(kind.isin("BIGINT", "BOOLEAN"), exact.cast("string"))
        .otherwise(parse_int(number, 0).cast("string"))
    )
    return F.when(value.isNotNull() & ~F.is_variant_null(value), text).alias(name)


def read_feed_table(spark: SparkSession, path: str, format: str = "parquet") -> DataFrame:
    """A feed that carries its own (source_rank, record_seq), from a splittable format."""
    return spark.read.schema(EXTERNAL_FEED).option("mode", "FAILFAST").format(format).load(path)

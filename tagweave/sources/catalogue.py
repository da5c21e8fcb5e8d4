"""Raw catalogue scan, processed tables, count metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, IntegerType, LongType, StringType

from tagweave.operators.features import feature_vocabulary
from tagweave.schemas import ITEMS, RAW_CATALOGUE


def read_csv_catalogue(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header, ``""`` for a quote inside quotes.

    Columns are taken by header name, whatever their order in the file, and cast to the declared
    types; nothing is inferred from the data, so the file is not read an extra time. Empty numbers
    are null, whole ones may be written with a fraction of zero or more (it is cut off), and what
    is no number is an error that names the value.
    """
    raw = spark.read.csv(path, header=True, escape='"')
    return raw.select(*[_typed(f.name, f.dataType).alias(f.name) for f in RAW_CATALOGUE.fields])


def _typed(name: str, kind: DataType) -> Column:
    text = F.col(name)
    if isinstance(kind, StringType):
        return text
    given = F.trim(text)
    number = given.try_cast(kind)
    if isinstance(kind, (LongType, IntegerType)):
        number = F.coalesce(number, F.floor(given.try_cast("double")).try_cast(kind))
    wrong = F.raise_error(F.concat(F.lit(f"{name} is no number: "), text)).cast(kind)
    return F.when(given.isNull() | (given == ""), F.lit(None).cast(kind)).otherwise(
        F.coalesce(number, wrong)
    )


def require_unique_positions(items: DataFrame) -> None:
    """Raise if a position occurs twice: it names an item everywhere else in the library."""
    repeated = items.groupBy("position").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    found = [row["position"] for row in repeated.limit(5).collect()]
    if found:
        raise ValueError(f"positions must be unique; repeated ones are {found}, ...")


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """``df`` with a row count that is filled in by whichever action runs it first."""
    observation = Observation(name)
    return df.observe(observation, F.count(F.lit(1)).alias("rows")), observation


def by_position(df: DataFrame) -> DataFrame:
    """``df`` laid out in order of position: once written, a filter on it skips row groups."""
    return df.repartitionByRange("position").sortWithinPartitions("position")


def write_index(index: DataFrame, path: str) -> None:
    """The tag index, to be read by every request. Repeated positions are an error."""
    by_position(index).write.parquet(path)
    require_unique_positions(index.sparkSession.read.parquet(path).select("position"))


def write_processed(items: DataFrame, path: str) -> dict[str, int]:
    """Write ``items`` and ``vocabulary`` under ``path`` and return the two row counts.

    The vocabulary is taken from the written items, so the plan behind them runs once. Repeated
    positions are an error.
    """
    spark = items.sparkSession
    observed, rows = counted(by_position(items), "items")
    observed.write.parquet(f"{path}/items")
    require_unique_positions(spark.read.parquet(f"{path}/items").select("position"))
    vocabulary, names = counted(
        feature_vocabulary(spark.read.parquet(f"{path}/items")), "vocabulary"
    )
    vocabulary.write.parquet(f"{path}/vocabulary")
    return {"items": rows.get["rows"], "vocabulary": names.get["rows"]}


def write_json_lines(items: DataFrame, path: str) -> None:
    """Items as JSON lines, one object per row."""
    items.write.json(path)


def write_json_arrays(records: DataFrame, files: list[str], order: list[str], path: str) -> None:
    """One file per value of ``files`` (folders under ``path``), each a JSON array of the column
    ``json`` of its rows by ``order``.

    Rows are sorted and written one by one: no array is ever held whole. ``files`` must not be
    text, as the writer would sort empty names anew and by them alone.
    """
    nothing = {c: F.lit(None).cast(records.schema[c].dataType) for c in {*order, "json"}}
    ends = records.select(*files).distinct().withColumns({**nothing, "_end": F.lit(1)})
    placed = [*files, "_end", *order]
    rows = records.withColumn("_end", F.lit(0)).unionByName(ends).repartition(*files)
    first = F.row_number().over(Window.partitionBy(*files).orderBy("_end", *order)) == 1
    text = F.when(F.col("_end") == 1, F.lit("]")).otherwise(
        F.concat(F.when(first, F.lit("[")).otherwise(F.lit(",")), "json")
    )
    lines = rows.withColumn("value", text).sortWithinPartitions(*placed)
    lines.select(*files, "value").write.partitionBy(*files).text(path)


def read_json_lines(spark: SparkSession, path: str) -> DataFrame:
    """Items as written by ``write_json_lines``; a damaged line is an error."""
    return spark.read.schema(ITEMS).option("mode", "FAILFAST").json(path).select(*ITEMS.names)


def read_processed(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(items, vocabulary) as written by ``write_processed``."""
    return spark.read.parquet(f"{path}/items"), spark.read.parquet(f"{path}/vocabulary")

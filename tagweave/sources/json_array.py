"""Large JSON arrays of objects, read by many tasks.

Files are read as text that ends at each closing brace, which Spark splits like lines. Whether a
brace lies in a string, how deep it is nested, and which record it closes are sums over all text
before it: they are added up inside each block of a file first, and then over the blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tagweave.session import stage

_PLACE = ["file", "block", "seq"]


def _count(text: Column, mark: str) -> Column:
    return F.char_length(text) - F.char_length(F.replace(text, F.lit(mark), F.lit("")))


def _before(pieces: DataFrame, value: Column, name: str) -> DataFrame:
    """``pieces`` with the sum of ``value`` over all pieces of the file before, as ``name``.

    A window holds the pieces of one block, another one the blocks of a file.
    """
    blocks = pieces.groupBy("file", "block").agg(F.sum(value).alias("_total"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select(
        "file", "block", F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_offset")
    )
    inside = Window.partitionBy("file", "block").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    summed = pieces.withColumn(name, F.coalesce(F.sum(value).over(inside), F.lit(0)))
    return (
        summed.join(offsets, ["file", "block"])
        .withColumn(name, F.col(name) + F.col("_offset"))
        .drop("_offset")
    )


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """Staged text between closing braces, with its place and what it holds.

    ``opens_0`` and ``opens_1`` are the opening braces outside strings if the piece begins outside
    or inside of one. An escape is never parted, as no escape ends in a brace.
    """
    text = spark.read.option("lineSep", "}").text(path)
    plain = F.regexp_replace("value", r"(?s)\\.", "")
    without_strings = lambda c: F.regexp_replace(c, r'"[^"]*("|$)', "")
    pieces = text.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"),
        "value",
        plain.alias("plain"),
    ).select(
        *_PLACE,
        "value",
        _count(F.col("plain"), '"').alias("quotes"),
        _count(without_strings(F.col("plain")), "{").alias("opens_0"),
        _count(without_strings(F.regexp_replace("plain", r'^[^"]*("|$)', "")), "{").alias("opens_1"),
    )
    return stage(pieces, "json-pieces")


def array_records(spark: SparkSession, path: str) -> DataFrame:
    """(record_seq, record): the JSON objects of all files of ``path``, each holding one array.

    ``record_seq`` counts from 0 in the order of the files' names and of the records in a file,
    however Spark deals the bytes. A file that is no array of objects, or is cut off, is an error;
    an empty file has no records.
    """
    pieces = _pieces(spark, path)
    last = F.lead("seq").over(Window.partitionBy("file", "block").orderBy("seq")).isNull()
    last_block = pieces.groupBy("file").agg(F.max("block").alias("last_block"))
    marked = (
        pieces.drop("value")
        .withColumn("last", last)
        .join(last_block, "file")
        .withColumn("last", F.col("last") & (F.col("block") == F.col("last_block")))
        .drop("last_block")
    )
    stated = _before(marked, F.col("quotes"), "inside").withColumn("inside", F.col("inside") % 2)
    # the text after the last brace of a file ends in none
    closes = ((F.col("inside") + F.col("quotes")) % 2 == 0) & ~F.col("last")
    opened = F.when(F.col("inside") == 0, F.col("opens_0")).otherwise(F.col("opens_1"))
    stepped = stated.select(
        *_PLACE, "last", closes.alias("closes"), (opened - closes.cast("int")).alias("step")
    )
    deep = _before(stepped, F.col("step"), "depth")
    ends = F.col("closes") & (F.col("depth") + F.col("step") == 0)
    flagged = stage(deep.select(*_PLACE, "last", ends.alias("ends")), "json-record-ends")
    numbered = _before(flagged, F.col("ends").cast("int"), "number")

    parts = numbered.select(*_PLACE, "ends", "last", "number").join(
        pieces.select(*_PLACE, "value"), _PLACE
    )
    whole = parts.groupBy("file", "number").agg(
        F.array_join(
            F.transform(
                F.array_sort(F.collect_list(F.struct("block", "seq", "value"))), lambda p: p["value"]
            ),
            "}",
        ).alias("text"),
        F.max("ends").alias("ended"),
    )
    first = F.col("number") == 0
    begins = F.when(first, F.col("text").rlike(r"^\s*\[")).otherwise(F.col("text").rlike(r"^\s*,"))
    closing = F.when(first, r"^\s*\[\s*\]\s*$").otherwise(r"^\s*\]\s*$")
    fine = F.when(F.col("ended"), begins).otherwise(F.rlike("text", closing))
    message = F.concat(F.lit("no array of JSON objects, or cut off: "), F.col("file"))
    checked = F.when(fine, F.col("ended")).otherwise(F.raise_error(message).cast("boolean"))
    object_ = F.concat(F.regexp_replace("text", r"^\s*[\[,]", ""), F.lit("}"))
    firsts = flagged.groupBy("file").agg(F.sum(F.col("ends").cast("int")).alias("n")).select(
        "file",
        F.coalesce(
            F.sum("n").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("first"),
    )
    # what is no record is null, so that a parser that runs before the filter does not see it
    return (
        whole.withColumn("record", F.when(checked, object_))
        .filter(F.col("record").isNotNull())
        .join(firsts, "file")
        .select((F.col("first") + F.col("number")).alias("record_seq"), "record")
    )

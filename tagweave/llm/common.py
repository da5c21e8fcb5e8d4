"""What several operators share: word patterns, and running a plain function over documents."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tagweave.session import stage

# White space of the quality and SimHash contracts: blank and the five ASCII controls.
BLANKS = " \t\n\x0b\x0c\r"
BLANK_RUN = r"[\x20\x09-\x0D]+"

# Rows turned into Python objects at a time, whatever the size of an Arrow batch.
SLICE_ROWS = 128


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(df: DataFrame, *names: str) -> list[str]:
    """``names``, each with as many underscores behind it as make it no column of ``df``."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def settle(build: Callable[[], DataFrame], name: str) -> DataFrame:
    """Stage what ``build`` returns, then let Spark's cleaner delete the shuffle files behind it.

    The cleaner acts when nothing refers to a plan any more and the driver collects its garbage,
    which a job of many large steps cannot wait for. Hence a function: no caller holds the plan.
    """
    out = stage(build(), name)
    gc.collect()
    out.sparkSession.sparkContext._jvm.System.gc()
    return out


def blank_words(text: Column) -> Column:
    """Runs of other characters than ``BLANKS``; null and blank texts have none."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, BLANK_RUN)
    )


def map_rows(
    df: DataFrame,
    keep: list[str],
    inputs: list[str],
    schema: str,
    start: Callable[[], Callable[..., tuple]],
) -> DataFrame:
    """The columns ``keep`` of each row, and the ``schema`` columns a plain function gives for it.

    Nothing is shuffled. ``start`` runs once per task and returns the function, so that models are
    unpacked once; it is called with the ``inputs``. Kept columns stay in Arrow. Rows become Python
    objects a slice at a time, which bounds memory with very long texts.
    """
    new = StructType.fromDDL(schema)
    fields = StructType([*df.select(*keep).schema.fields, *new.fields])
    out_schema, types = to_arrow_schema(fields), [f.type for f in to_arrow_schema(new)]
    columns = list(dict.fromkeys([*keep, *inputs]))
    kept, read = [columns.index(c) for c in keep], [columns.index(c) for c in inputs]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_row = start()
        for batch in batches:
            for first in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(first, SLICE_ROWS)
                rows = zip(*[part.column(i).to_pylist() for i in read], strict=True)
                made = zip(*[of_row(*row) for row in rows], strict=True)
                arrays = [pa.array(v, type=t) for v, t in zip(made, types, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(i) for i in kept], *arrays], schema=out_schema
                )

    return df.select(*columns).mapInArrow(run, fields)

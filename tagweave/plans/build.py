"""Raw inputs to the processed catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagweave.operators.external import append_external
from tagweave.operators.features import build_items
from tagweave.operators.variants import consolidate_variants
from tagweave.session import stage


def build_catalogue(
    raw: DataFrame, enrichment: DataFrame | None = None, feed: DataFrame | None = None
) -> DataFrame:
    """Parse and featurize, append the feed, consolidate variants, renumber.

    Append and consolidation each read their input several times, so it is staged in between.
    """
    items = stage(build_items(raw, enrichment), "items")
    appended = stage(append_external(items, feed), "appended") if feed is not None else items
    return consolidate_variants(appended)


def build_metrics(before: DataFrame, appended: DataFrame, merged: DataFrame) -> DataFrame:
    """One row: items read, external rows added, rows removed by consolidation, items kept."""
    count = lambda df: df.agg(F.count(F.lit(1)).alias("n")).scalar()
    return before.agg(F.count(F.lit(1)).alias("read")).select(
        "read",
        (count(appended) - F.col("read")).alias("added"),
        (count(appended) - count(merged)).alias("removed"),
        count(merged).alias("kept"),
    )

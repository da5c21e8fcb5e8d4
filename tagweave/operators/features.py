"""Parsed catalogue, feature maps, vocabularies and their counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagweave.fixed import DESCRIPTOR_PREFIX, PRIMARY_PREFIX, SECONDARY_PREFIX, TAG_PREFIX
from tagweave.functions.lists import feature_map, or_empty, parse_list
from tagweave.schemas import ITEMS

LIST_COLUMNS = ("primary_genres", "secondary_genres", "descriptors")


def parse_lists(raw: DataFrame) -> DataFrame:
    """Replace the three comma-text columns by arrays."""
    return raw.withColumns({name: parse_list(F.col(name)) for name in LIST_COLUMNS})


def attach_tags(items: DataFrame, enrichment: DataFrame | None) -> DataFrame:
    """Add ``lastfm_tags`` by position; null where the enrichment has no entry."""
    if enrichment is None:
        return items.withColumn("lastfm_tags", F.lit(None).cast("array<string>"))
    tags = enrichment.select("position", F.col("tag_list").alias("lastfm_tags"))
    return items.join(tags, "position", "left")


def conform(items: DataFrame) -> DataFrame:
    """Project to the item schema; optional columns that are absent become null."""
    present = set(items.columns)
    return items.select(
        *[
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in ITEMS.fields
        ]
    )


def build_items(raw: DataFrame, enrichment: DataFrame | None = None) -> DataFrame:
    """Raw catalogue to items: parse, attach tags, build feature maps, project with casts."""
    parsed = attach_tags(parse_lists(raw), enrichment)
    return conform(
        parsed.withColumns(
            {
                "features": feature_map(*[F.col(c) for c in LIST_COLUMNS], F.col("lastfm_tags")),
                "avg_rating": F.coalesce(F.col("avg_rating").cast("double"), F.lit(0.0)),
                "rating_count": F.coalesce(F.col("rating_count").cast("int"), F.lit(0)),
            }
        )
    )


def features_long(items: DataFrame) -> DataFrame:
    """One row per (position, feature).

    A plain ``explode`` first filters on the size of the map, which builds each map twice when
    the items are not stored yet; the outer form does not.
    """
    rows = items.select("position", F.explode_outer("features").alias("feature", "weight"))
    return rows.filter(F.col("feature").isNotNull())


def feature_vocabulary(items: DataFrame) -> DataFrame:
    """Sorted distinct feature names."""
    names = items.select(F.explode(F.map_keys("features")).alias("feature"))
    return names.distinct().orderBy("feature")


def _kinded(values: Column, kind: str, prefix: str) -> Column:
    return F.transform(
        or_empty(values),
        lambda v: F.struct(
            F.lit(kind).alias("kind"), F.concat(F.lit(prefix), v).alias("feature")
        ),
    )


def list_vocabulary(items: DataFrame) -> DataFrame:
    """Distinct prefixed values per kind, straight from the lists, empty items included.

    One scan and one shuffle for all four kinds.
    """
    everything = F.concat(
        _kinded(F.col("primary_genres"), "primary", PRIMARY_PREFIX),
        _kinded(F.col("secondary_genres"), "secondary", SECONDARY_PREFIX),
        _kinded(F.col("descriptors"), "descriptor", DESCRIPTOR_PREFIX),
        _kinded(F.col("lastfm_tags"), "tag", TAG_PREFIX),
    )
    return items.select(F.explode(everything).alias("e")).select("e.kind", "e.feature").distinct()


def vocabulary_counts(items: DataFrame) -> DataFrame:
    """Vocabulary size per kind and in total (kind ``all``)."""
    per_kind = list_vocabulary(items).groupBy("kind").agg(F.count(F.lit(1)).alias("n"))
    return (
        per_kind.rollup("kind")
        .agg(F.sum("n").alias("n"))
        .select(F.coalesce("kind", F.lit("all")).alias("kind"), "n")
    )


def enriched_item_count(items: DataFrame) -> DataFrame:
    """Items with a feature name that contains the tag prefix anywhere."""
    has_tag = F.exists(F.map_keys("features"), lambda k: F.contains(k, F.lit(TAG_PREFIX)))
    return items.agg(F.count_if(has_tag).alias("enriched"), F.count(F.lit(1)).alias("items"))


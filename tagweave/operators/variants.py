"""Consolidation of variant releases into one item."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagweave.fixed import DEFAULT_SOURCE
from tagweave.functions.lists import or_empty
from tagweave.functions.text import norm_title
from tagweave.operators.features import conform
from tagweave.operators.indexing import dense_index
from tagweave.operators.skew import spread_join
from tagweave.session import stage

GROUP_KEYS = ["_artist", "_title"]
_NO_FEATURES = "map<string,float>"


def with_group_keys(items: DataFrame) -> DataFrame:
    """Lower-cased artist and normalized title. The artist keeps its inner white space here."""
    return items.withColumns(
        {
            "_artist": F.lower(F.coalesce("artist_name", F.lit(""))),
            "_title": F.lower(norm_title(F.col("release_name"))),
        }
    )


def variant_groups(items: DataFrame) -> DataFrame:
    """One row per group: its keys, the first position, the number of members."""
    return (
        with_group_keys(items)
        .groupBy(*GROUP_KEYS)
        .agg(F.min("position").alias("base"), F.count(F.lit(1)).alias("members"))
    )


def merged_contents(items: DataFrame, groups: DataFrame) -> DataFrame:
    """Per group with several members: summed features, and the descriptors its base lacks.

    Members are tagged with the base position (a hot group is spread over several tasks by its
    known size), then reduced per (group, feature) and (group, descriptor) with
    map-side partial aggregation. Only those reduced rows meet per group. A descriptor's place
    is the smallest ``position << 32 | index``, a plain bigint, so hash aggregation applies.
    """
    several = groups.filter(F.col("members") > 1)
    members = spread_join(
        with_group_keys(items).select("position", *GROUP_KEYS, "features", "descriptors"),
        several.select(*GROUP_KEYS, "base"),
        GROUP_KEYS,
        spread_by="position",
        counts=several.select(*GROUP_KEYS, F.col("members").alias("rows")),
    )
    place = lambda i: F.col("position").cast("bigint") * F.lit(2**32) + i
    no_place = F.lit(None).cast("bigint")
    entry = lambda is_feature, key, weight, at: F.struct(
        F.lit(is_feature).alias("is_feature"),
        key.alias("key"),
        weight.cast("double").alias("weight"),
        at.alias("place"),
    )
    features = F.transform(
        F.map_entries(F.coalesce("features", F.create_map().cast(_NO_FEATURES))),
        lambda e: entry(True, e["key"], e["value"], no_place),
    )
    descriptors = F.transform(
        or_empty(F.col("descriptors")), lambda d, i: entry(False, d, F.lit(0.0), place(i))
    )
    reduced = (
        members.select("base", F.explode(F.concat(features, descriptors)).alias("e"))
        .select("base", "e.*")
        .groupBy("base", "is_feature", "key")
        .agg(F.sum("weight").alias("weight"), F.min("place").alias("place"))
    )
    from_later = ~F.col("is_feature") & (F.col("place") >= place(0) + F.lit(2**32))
    feature = F.when(
        F.col("is_feature"), F.struct("key", F.col("weight").cast("float").alias("value"))
    )
    later = F.when(from_later, F.struct("place", "key"))
    return (
        reduced.withColumn("position", F.col("base"))
        .groupBy("position")
        .agg(
            F.map_from_entries(F.collect_list(feature)).alias("merged_features"),
            F.transform(F.sort_array(F.collect_list(later)), lambda x: x["key"]).alias(
                "later_descriptors"
            ),
        )
    )


def consolidate_variants(items: DataFrame) -> DataFrame:
    """Merge each variant group into its first member and renumber positions 1..n.

    The new numbers belong to the narrow group table, so the join that picks the first members
    brings them along and the wide rows are not shuffled for numbering. Group sizes, numbers and
    hot keys are all read from that table, so it is staged instead of grouping five times.
    """
    groups = stage(variant_groups(items), "groups")
    numbered = dense_index(groups.select("base", "members"), "base", "number")
    bases = items.join(numbered.withColumnRenamed("base", "position"), "position")
    merged = F.col("members") > 1
    rows = bases.join(merged_contents(items, groups), "position", "left").withColumns(
        {
            "features": F.when(merged, F.col("merged_features")).otherwise(F.col("features")),
            "descriptors": F.when(
                merged, F.concat(or_empty(F.col("descriptors")), F.col("later_descriptors"))
            ).otherwise(F.col("descriptors")),
            "source": F.when(merged, F.coalesce("source", F.lit(DEFAULT_SOURCE))).otherwise(
                F.col("source")
            ),
            "lastfm_tags": F.when(~merged, F.col("lastfm_tags")),
            "variant_count": F.when(merged, F.col("members").cast("int")).otherwise(
                F.col("variant_count")
            ),
        }
    )
    return conform(rows.withColumn("position", F.col("number")))

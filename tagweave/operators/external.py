"""Appending an external feed to the catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagweave.fixed import EXTERNAL_DESCRIPTORS, EXTERNAL_RELEASE_TYPE, EXTERNAL_SOURCE
from tagweave.functions.lists import feature_map, no_strings, tag_names
from tagweave.functions.params import parse_count
from tagweave.functions.text import norm
from tagweave.operators.features import conform
from tagweave.operators.indexing import dense_index
from tagweave.schemas import SIMILAR
from tagweave.session import stage

KEYS = ["_artist", "_title"]


def _with_keys(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {"_artist": norm(F.col("artist_name")), "_title": norm(F.col("release_name"))}
    )


def named_records(feed: DataFrame) -> DataFrame:
    """Records with both a non-empty artist and a non-empty title."""
    return feed.filter(
        (F.coalesce("artist_name", F.lit("")) != "")
        & (F.coalesce("release_name", F.lit("")) != "")
    )


def new_records(items: DataFrame, feed: DataFrame) -> DataFrame:
    """(source_rank, record_seq) of the first record per key, for keys the catalogue lacks.

    Only names take part, never tags. ``row_number() = 1`` is limited per map task before the
    shuffle, so a key that fills a third of the feed sends one row per task. The anti-join
    reuses the window's partitioning.
    """
    named = named_records(feed).select("source_rank", "record_seq", "artist_name", "release_name")
    order = Window.partitionBy(*KEYS).orderBy("source_rank", "record_seq")
    first = (
        _with_keys(named).withColumn("_n", F.row_number().over(order)).filter(F.col("_n") == 1)
    )
    known = _with_keys(items).select(*KEYS).distinct()
    return first.join(known, KEYS, "left_anti").select("source_rank", "record_seq")


def external_items(items: DataFrame, feed: DataFrame) -> DataFrame:
    """The new records as items, numbered on from the catalogue's last position.

    Which records are kept, and under which number, is settled on narrow rows; the wide ones
    are then shuffled once, to meet their number. Numbering reads its keys twice: they are staged.
    """
    kept = stage(new_records(items, feed), "new_records")
    numbers = dense_index(kept, "record_seq", "_number", within="source_rank")
    numbered = feed.join(numbers, ["source_rank", "record_seq"])
    last = items.agg(F.coalesce(F.max("position"), F.lit(0)).alias("last")).scalar()
    shaped = numbered.withColumns(
        {
            "position": last + F.col("_number"),
            "_names": tag_names(F.col("tags")),
            "release_type": F.lit(EXTERNAL_RELEASE_TYPE),
            "primary_genres": no_strings(),
            "secondary_genres": no_strings(),
            "avg_rating": F.lit(0.0),
            "rating_count": F.lit(0),
            "source": F.lit(EXTERNAL_SOURCE),
            "lastfm_playcount": parse_count(F.col("playcount")),
            "lastfm_listeners": parse_count(F.col("listeners")),
            "lastfm_similar_albums": F.coalesce("similar_albums", F.array().cast(SIMILAR)),
        }
    ).withColumn("descriptors", F.slice("_names", 1, EXTERNAL_DESCRIPTORS))
    features = feature_map(no_strings(), no_strings(), F.col("descriptors"), F.col("_names"))
    return conform(shaped.withColumn("features", features))


def append_external(items: DataFrame, feed: DataFrame | None) -> DataFrame:
    """Catalogue plus the feed's new records; without a feed the catalogue as it is."""
    if feed is None:
        return conform(items)
    return conform(items).unionByName(external_items(items, feed))

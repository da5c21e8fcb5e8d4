"""Cleaning crawled community tags, and the crawl cache."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagweave.fixed import MAX_SIMILAR, MIN_CRAWL_TAG_LENGTH, NOISE_TAGS
from tagweave.functions.lists import let
from tagweave.functions.params import parse_count, parse_int
from tagweave.functions.text import cache_key, clean_tag
from tagweave.operators.skew import spread_join
from tagweave.schemas import SIMILAR

def similar_list(similar: Column) -> Column:
    """The first twelve entries, then those of them that name both artist and title."""
    return F.filter(
        F.slice(F.coalesce(similar, F.array().cast(SIMILAR)), 1, MAX_SIMILAR),
        lambda s: (s["artist"] != "") & (s["title"] != ""),
    )


def _last_weights(in_order: Column) -> Column:
    """Of tags sorted by (name, index), the last of each name with its weight."""
    last = F.filter(
        in_order,
        lambda t, i: (i + 1 == F.size(in_order)) | (F.get(in_order, i + 1)["name"] != t["name"]),
    )
    return F.transform(
        last, lambda t: F.struct(t["name"].alias("key"), t["weight"].alias("value"))
    )


def clean_crawl(raw: DataFrame) -> DataFrame:
    """Raw crawl results to cache entries; items that were not found keep null contents.

    The tag list keeps duplicates, the weight map takes a name's last occurrence: of the sorted
    (name, index) pairs, the last of each run. Everything stays inside the row.
    """
    named = F.transform(
        F.coalesce("tags", F.array().cast(raw.schema["tags"].dataType)),
        lambda t, i: F.struct(
            clean_tag(t["name"]).alias("name"), i.alias("i"), parse_int(t["weight"], 1).alias("weight")
        ),
    )
    useful = F.filter(
        named,
        lambda t: (F.length(t["name"]) >= MIN_CRAWL_TAG_LENGTH) & ~t["name"].isin(NOISE_TAGS),
    )
    weights = F.map_from_entries(let(F.sort_array(useful), _last_weights))
    found = F.coalesce(F.col("found"), F.lit(False))
    return raw.select(
        "cache_key",
        found.alias("found"),
        F.when(found, weights).alias("tags"),
        F.when(found, F.transform(useful, lambda t: t["name"])).alias("tag_list"),
        F.when(found, similar_list(F.col("similar"))).alias("similar_albums"),
        F.when(found, parse_count(F.col("playcount"))).alias("playcount"),
    )


def _keyed(items: DataFrame) -> DataFrame:
    return items.select(
        "position", cache_key(F.col("artist_name"), F.col("release_name")).alias("cache_key")
    )


def crawl_states(items: DataFrame, cache: DataFrame) -> DataFrame:
    """Each item with the state of its cache entry and, on a hit, the entry's lists."""
    entries = cache.select(
        "cache_key", F.col("found").alias("_found"), "tag_list", "similar_albums"
    ).withColumn("_cached", F.lit(True))
    hit = F.col("_cached") & F.col("_found") & F.col("tag_list").isNotNull()
    return _keyed(items).join(entries, "cache_key", "left").select(
        "position",
        "cache_key",
        F.when(hit, F.lit("hit"))
        .when(F.col("_cached"), F.lit("missing"))
        .otherwise(F.lit("absent"))
        .alias("state"),
        F.when(hit, F.col("tag_list")).alias("tag_list"),
        F.when(hit, F.col("similar_albums")).alias("similar_albums"),
    )


def first_fetches(fetched: DataFrame, order: str | None = None) -> DataFrame:
    """One entry per key: the one with the smallest ``order`` (a column with the fetch's place).

    Without such a column found entries come first, then those with the smallest contents, so
    that the choice does not depend on the order of the rows.
    """
    contents = F.struct(~F.col("found"), "playcount", "tag_list", "similar_albums")
    entry = F.struct(*[c for c in fetched.columns if c not in ("cache_key", order)])
    best = F.min_by(entry, contents if order is None else F.col(order))
    return fetched.groupBy("cache_key").agg(best.alias("e")).select("cache_key", "e.*")


def upsert_cache(
    cache: DataFrame, fetched: DataFrame, order: str | None = None
) -> DataFrame:
    """Old entries win; entries for keys the cache lacks are added, not-found ones included. Of
    repeated keys ``first_fetches`` decides."""
    fresh = first_fetches(fetched, order).join(
        cache.select("cache_key"), "cache_key", "left_anti"
    )
    return cache.unionByName(fresh.select(*cache.columns))


def apply_crawl_cache(
    items: DataFrame,
    cache: DataFrame,
    fetched: DataFrame | None = None,
    order: str | None = None,
) -> DataFrame:
    """Tags and similar items per position: from the cache, else from freshly crawled entries.

    Positions without either have no row. A cached similar list is kept even when empty, a
    fresh one only when it holds something.
    """
    keyed = _keyed(items)
    hits = cache.filter("found AND tag_list IS NOT NULL").select(
        "cache_key", "tag_list", "similar_albums"
    )
    cached = keyed.join(hits, "cache_key").select("position", "tag_list", "similar_albums")
    if fetched is None:
        return cached
    absent = keyed.join(cache.select("cache_key"), "cache_key", "left_anti")
    # the first item of a key is the one that fetches; later ones find its entry in the cache
    keys = absent.groupBy("cache_key").agg(
        F.min("position").alias("_first"), F.count(F.lit(1)).alias("rows")
    )
    # the first fetch of a key decides, as in the cache it goes to, also if it found nothing
    entries = first_fetches(fetched, order).filter("found").join(keys.drop("rows"), "cache_key")
    keep_similar = (F.size("similar_albums") > 0) | (F.col("position") > F.col("_first"))
    tagged = spread_join(
        absent, entries, ["cache_key"], spread_by="position", counts=keys.drop("_first")
    )
    fresh = tagged.select(
        "position",
        "tag_list",
        F.when(keep_similar, F.col("similar_albums")).alias("similar_albums"),
    )
    return cached.unionByName(fresh)


def similar_edges(enrichment: DataFrame) -> DataFrame:
    """One row per (position, rank) of the similar-item lists."""
    return enrichment.select("position", F.posexplode("similar_albums").alias("i", "s")).select(
        "position", (F.col("i") + 1).alias("rank"), "s.artist", "s.title"
    )

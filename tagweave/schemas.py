"""Declared schemas of every table the library reads or writes."""

from __future__ import annotations

from pyspark.sql import types as T

_STRINGS = T.ArrayType(T.StringType())
SIMILAR = T.ArrayType(
    T.StructType([T.StructField("artist", T.StringType()), T.StructField("title", T.StringType())])
)

RAW_CATALOGUE = T.StructType(
    [
        T.StructField("position", T.LongType()),
        T.StructField("artist_name", T.StringType()),
        T.StructField("release_name", T.StringType()),
        T.StructField("release_date", T.StringType()),
        T.StructField("release_type", T.StringType()),
        T.StructField("primary_genres", T.StringType()),
        T.StructField("secondary_genres", T.StringType()),
        T.StructField("descriptors", T.StringType()),
        T.StructField("avg_rating", T.DoubleType()),
        T.StructField("rating_count", T.IntegerType()),
    ]
)

ITEMS = T.StructType(
    [
        T.StructField("position", T.LongType()),
        T.StructField("artist_name", T.StringType()),
        T.StructField("release_name", T.StringType()),
        T.StructField("release_date", T.StringType()),
        T.StructField("release_type", T.StringType()),
        T.StructField("primary_genres", _STRINGS),
        T.StructField("secondary_genres", _STRINGS),
        T.StructField("descriptors", _STRINGS),
        T.StructField("features", T.MapType(T.StringType(), T.FloatType())),
        T.StructField("avg_rating", T.DoubleType()),
        T.StructField("rating_count", T.IntegerType()),
        T.StructField("lastfm_tags", _STRINGS),
        T.StructField("source", T.StringType()),
        T.StructField("variant_count", T.IntegerType()),
        T.StructField("lastfm_playcount", T.LongType()),
        T.StructField("lastfm_listeners", T.LongType()),
        T.StructField("lastfm_similar_albums", SIMILAR),
    ]
)

NAMED_TAGS = T.ArrayType(T.StructType([T.StructField("name", T.StringType())]))

EXTERNAL_RECORD = T.StructType(
    [
        T.StructField("artist_name", T.StringType()),
        T.StructField("release_name", T.StringType()),
        T.StructField("tags", NAMED_TAGS),
        T.StructField("playcount", T.StringType()),
        T.StructField("listeners", T.StringType()),
        T.StructField("similar_albums", SIMILAR),
    ]
)

EXTERNAL_FEED = T.StructType(
    [
        T.StructField("source_rank", T.IntegerType()),
        T.StructField("record_seq", T.LongType()),
        *EXTERNAL_RECORD.fields,
    ]
)

RAW_CRAWL = T.StructType(
    [
        T.StructField("cache_key", T.StringType()),
        T.StructField("found", T.BooleanType()),
        T.StructField(
            "tags",
            T.ArrayType(
                T.StructType(
                    [T.StructField("name", T.StringType()), T.StructField("weight", T.StringType())]
                )
            ),
        ),
        T.StructField("similar", SIMILAR),
        T.StructField("playcount", T.StringType()),
    ]
)

CRAWL_CACHE = T.StructType(
    [
        T.StructField("cache_key", T.StringType()),
        T.StructField("found", T.BooleanType()),
        T.StructField("tags", T.MapType(T.StringType(), T.LongType())),
        T.StructField("tag_list", _STRINGS),
        T.StructField("similar_albums", SIMILAR),
        T.StructField("playcount", T.LongType()),
    ]
)

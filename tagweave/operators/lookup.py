"""Item lookups by position and by exact names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagweave.operators.skew import spread_join

DETAIL = [
    "position",
    "artist_name",
    "release_name",
    "release_date",
    "release_type",
    "descriptors",
    "avg_rating",
    "rating_count",
    "primary_genres",
    "secondary_genres",
]


def item_detail(items: DataFrame, position: int) -> DataFrame:
    """Details of one item; the filter reaches the scan."""
    return items.filter(F.col("position") == position).select(*DETAIL)


def lookup(items: DataFrame, requests: DataFrame) -> DataFrame:
    """Details for a table of (request_id, position); unknown positions give no row."""
    wanted = requests.select("request_id", F.col("position").try_cast("bigint").alias("position"))
    return wanted.join(items.select(*DETAIL), "position")


def find_exact(items: DataFrame, pairs: DataFrame) -> DataFrame:
    """First item whose names equal (request_id, artist, title) apart from case.

    Items are reduced to the first position per name pair before the join, so each request
    meets at most one row however often a pair occurs among the items; pairs that many requests
    ask for are spread.
    """
    keys = ["_artist", "_title"]
    first = items.groupBy(
        F.lower("artist_name").alias("_artist"), F.lower("release_name").alias("_title")
    ).agg(F.min("position").alias("position"))
    wanted = pairs.select(
        "request_id", F.lower("artist").alias("_artist"), F.lower("title").alias("_title")
    )
    found = spread_join(wanted, first, keys, spread_by="request_id")
    return found.select("request_id", "position").join(items.select(*DETAIL), "position")

"""Text form of recommendation rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagweave.fixed import DISPLAY_DESCRIPTORS


def two_decimals(value: Column) -> Column:
    """Exactly rounded to two decimals, ties upwards.

    ``format_number`` rounds the exact binary value, ties to even. A double ties at two
    decimals only if it is an odd number of eighths, and those are moved off the tie.
    """
    eighths = value * 8
    tie = (eighths == F.floor(eighths)) & (F.pmod(F.floor(eighths), F.lit(2)) == 1)
    moved = F.when(tie, value + F.lit(0.001)).otherwise(value)
    return F.replace(F.format_number(moved, 2), F.lit(","), F.lit(""))


def _joined(values: Column) -> Column:
    return F.when(F.size(values) > 0, F.array_join(values, ", ", ""))


def display_rows(recommendations: DataFrame) -> DataFrame:
    """Heading, rating, genre and score texts; null where the page shows nothing."""
    score = F.col("score")
    whole = score == F.floor(score)
    rated = F.col("avg_rating").isNotNull() & F.col("rating_count").isNotNull()
    more = F.when(F.size("descriptors") > DISPLAY_DESCRIPTORS, F.lit("...")).otherwise(F.lit(""))
    return recommendations.select(
        "request_id",
        "rank",
        "position",
        F.concat(F.lit("#"), F.col("rank"), F.lit(": "), F.col("release_name")).alias("heading"),
        F.col("artist_name").alias("artist"),
        F.when(rated, F.concat(two_decimals(F.col("avg_rating")), F.lit("/5.0"))).alias("rating"),
        F.when(rated, F.format_number("rating_count", 0)).alias("ratings"),
        F.concat(
            F.when(whole, score.cast("bigint").cast("string")).otherwise(
                F.replace(F.format_number(score.cast("double"), 1), F.lit(","), F.lit(""))
            ),
            F.lit(" pts"),
        ).alias("points"),
        _joined(F.col("primary_genres")).alias("primary"),
        _joined(F.col("secondary_genres")).alias("secondary"),
        F.concat(_joined(F.slice("descriptors", 1, DISPLAY_DESCRIPTORS)), more).alias(
            "descriptors"
        ),
    )

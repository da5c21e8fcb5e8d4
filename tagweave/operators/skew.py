"""Joining many rows to one row per key when a few keys hold most of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key with more rows than this is spread over several tasks.
HOT_ROWS = 262_144


def spread_join(
    many: DataFrame,
    one: DataFrame,
    keys: list[str],
    spread_by: str,
    counts: DataFrame | None = None,
    hot_rows: int | None = None,
) -> DataFrame:
    """Inner join of ``many`` with ``one``, which has at most one row per key.

    Adaptive skew handling splits a join only where both inputs come straight from a shuffle;
    here ``one`` usually is an aggregate. So hot keys are salted: a key with n rows in ``many``
    gets ``ceil(n / hot_rows)`` copies in ``one``, and its rows go to the copies by the hash of
    ``spread_by``. All other keys keep one copy. ``counts`` (keys, ``rows``) may be given if it
    is known already. The hot keys are broadcast: there are at most rows / hot_rows of them,
    which is thousands where ``many`` has billions.
    """
    limit = hot_rows or HOT_ROWS
    if counts is None:
        counts = many.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    hot = F.broadcast(
        counts.filter(F.col("rows") > limit).select(
            *keys, F.ceil(F.col("rows") / F.lit(limit)).cast("int").alias("_copies")
        )
    )
    salt = F.pmod(F.xxhash64(spread_by), F.col("_copies"))
    salted = many.join(hot, keys, "left").withColumn(
        "_salt", F.coalesce(salt, F.lit(0)).cast("int")
    )
    last = F.coalesce(F.col("_copies"), F.lit(1)) - 1
    copied = one.join(hot, keys, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), last))
    )
    # dealt explicitly: a join may otherwise go without the salt where its input is already
    # partitioned by some of the keys
    by_salt = [*keys, "_salt"]
    many_dealt = salted.drop("_copies").repartition(*by_salt)
    return many_dealt.join(copied.drop("_copies").repartition(*by_salt), by_salt).drop("_salt")

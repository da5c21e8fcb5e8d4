"""Dense global numbering without a global sort in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET_BITS = 16


def dense_index(
    keys: DataFrame,
    value: str,
    out: str,
    within: str | None = None,
    bits: int = BUCKET_BITS,
) -> DataFrame:
    """Number rows 1..n (bigint) in the order of (``within``, ``value``).

    ``keys`` should be narrow: it is read twice and shuffled once, and the numbers are meant to
    be joined to the wide rows. ``value`` must be an integer, unique inside ``within``. Rows fall
    into buckets of ``2^bits`` consecutive values, so no bucket can hold more rows than that
    whatever the data. The buckets' counts are summed up in the same way: buckets fall into
    buckets of ``2^bits`` consecutive ones, until what is left spans no more than that. So no
    window sees more than ``2^bits`` rows, however far the values lie apart, but the one over the
    distinct values of ``within``. Bucket membership depends on the values alone; a recomputed
    task gives the same numbers, and nothing has to be persisted.
    """
    number = F.col(value).cast("bigint")
    rows = keys.withColumns({"_b": number, "_n": F.lit(1).cast("bigint")})
    if within:
        rows = rows.withColumn("_within", F.col(within).cast("int"))
    low, high = keys.agg(F.min(number), F.max(number)).first()
    group = ["_within"] if within else []
    return (
        _with_offsets(rows, group, low or 0, high or 0, bits)
        .withColumn(out, F.col("_offset") + 1)
        .drop(*group, "_b", "_n", "_offset")
    )


def _before(group: list[str], order: str) -> Column:
    """Sum of ``_n`` over the rows before this one."""
    window = Window.partitionBy(*group).orderBy(order)
    earlier = window.rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum("_n").over(earlier), F.lit(0))


def _with_offsets(
    rows: DataFrame, group: list[str], low: int, high: int, bits: int
) -> DataFrame:
    """``rows`` with ``_offset``: the sum of ``_n`` over all smaller (``group``, ``_b``).

    ``rows`` are unique by these, with ``_b`` from low to high.
    """
    if high - low >> bits:
        cut = rows.withColumn("_up", F.shiftright("_b", bits))
        coarse = cut.groupBy(*group, F.col("_up").alias("_b")).agg(F.sum("_n").alias("_n"))
        outer = _with_offsets(coarse, group, low >> bits, high >> bits, bits).select(
            *group, F.col("_b").alias("_up"), F.col("_offset").alias("_start")
        )
        inside = _before([*group, "_up"], "_b")
        placed = cut.withColumn("_inside", inside).join(outer, [*group, "_up"]).drop("_up")
    elif group:
        totals = rows.groupBy(*group).agg(F.sum("_n").alias("_n"))
        starts = totals.select(*group, _before([], *group).alias("_start"))
        placed = rows.withColumn("_inside", _before(group, "_b")).join(starts, group)
    else:
        return rows.withColumn("_offset", _before([], "_b"))
    return placed.withColumn("_offset", F.col("_start") + F.col("_inside")).drop("_start", "_inside")

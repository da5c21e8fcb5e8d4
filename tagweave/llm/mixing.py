"""Mixing sources to target weights by Poisson replication.

A source with target share w holds a mass m (characters) of a total M. For an output of mass T its
documents have to occur w * T / m times on average. Each document gets a Poisson number with that
mean, by inverting the distribution at a uniform number hashed from its id and the seed: no
counter, no order and no state, so recomputed tasks and other cluster sizes give the same mix.
"""

from __future__ import annotations

import math
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagweave.functions.lists import let
from tagweave.llm.common import unused

SEED = 42
# Largest mean that is inverted from P(X <= 0) on; larger ones from a table around the mode.
MAX_PART = 16.0
# Largest mean that has a table (of some thousand probabilities); larger ones are the sums of
# equal parts, which share one table.
MAX_TABLE = 65536.0
# Copies that a row lists at a time.
COPY_BLOCK = 1024


def uniform(*parts: Column) -> Column:
    """Number in [0, 1) from the first 13 hex digits of an MD5."""
    digits = F.substring(F.md5(F.concat_ws(":", *[p.cast("string") for p in parts])), 1, 13)
    return F.conv(digits, 16, 10).cast("bigint") / F.lit(float(16**13))


def poisson_steps(mean: float) -> list[float]:
    """P(X <= 0), P(X <= 1), ... until the sum no longer grows in double precision."""
    term = math.exp(-mean)
    steps, total = [term], term
    for k in range(1, 1000):
        term *= mean / k
        if total + term == total and k > mean:
            break
        total += term
        steps.append(total)
    return steps


def poisson_table(mean: float) -> tuple[int, list[float]]:
    """(low, [P(X <= low), P(X <= low + 1), ...]) for large means.

    Terms relative to that of the mode, until they no longer count in double precision.
    """
    mode = int(mean)
    below, term, k = [], 1.0, mode
    while k > 0 and term > 1e-20:
        term *= k / mean
        k -= 1
        below.append(term)
    above, term, k = [], 1.0, mode
    while term > 1e-20:
        k += 1
        term *= mean / k
        above.append(term)
    terms = [*reversed(below), 1.0, *above]
    whole = math.fsum(terms)
    return mode - len(below), [p / whole for p in accumulate(terms)]


def target_rates(
    docs: DataFrame, weights: dict[str, float], rest: float, source: Column, mass: Column, scale: float
) -> dict[str | None, float]:
    """Mean repetitions per source; ``None`` stands for all sources that are not named.

    The driver sees one row per named source and one for the rest. The output mass is ``scale``
    times the input mass; a source without documents leaves its share unfilled.
    """
    named = F.when(source.isin(*weights), source)
    sums = docs.groupBy(named.alias("s")).agg(F.sum(mass).alias("m")).collect()
    masses = {row["s"]: float(row["m"] or 0) for row in sums}
    shares = {**weights, None: rest}
    total = sum(masses.values()) * scale / sum(shares.values())
    return {s: shares[s] * total / m for s, m in masses.items() if m > 0}


def copies(rates: dict[str | None, float], source: Column, key: Column, seed: int) -> Column:
    """Poisson number of the row: how many steps of its source's distribution its number passes.

    The expression has one table per source, whatever the rate.
    """

    def drawn(rate: float) -> Column:
        parts = max(1, math.ceil(rate / MAX_TABLE))
        low, table = (0, poisson_steps(rate)) if rate <= MAX_PART else poisson_table(rate / parts)
        steps = F.split(F.lit(",".join(map(repr, table))), ",").cast("array<double>")
        passed = lambda u: F.size(F.filter(steps, lambda p: p <= u))
        one = lambda i: let(uniform(key, F.lit(seed), i), passed) + F.lit(low)
        if parts == 1:
            return one(F.lit(0))
        draws = F.sequence(F.lit(0), F.lit(parts - 1))
        return F.aggregate(draws, F.lit(0), lambda n, i: n + one(i))

    # the first branch is never taken; it lets the rest be chained
    cases = F.when(F.lit(False), 0)
    for name, rate in rates.items():
        if name is not None:
            cases = cases.when(source == name, drawn(rate))
    return cases.otherwise(drawn(rates[None]) if rates.get(None) else F.lit(0))


def exploded(counted: DataFrame) -> DataFrame:
    """Rows with ``copy`` n as n rows with ``copy`` 0 to n - 1, listed in blocks."""
    copies, block = unused(counted, "copies", "block")
    last = F.col(copies) - 1
    start = F.col(block) * COPY_BLOCK
    blocks = F.sequence(F.lit(0), F.floor(last / F.lit(COPY_BLOCK)).cast("int"))
    return (
        counted.withColumnRenamed("copy", copies)
        .withColumn(block, F.explode(blocks))
        .withColumn("copy", F.explode(F.sequence(start, F.least(start + (COPY_BLOCK - 1), last))))
        .drop(copies, block)
    )


def mix_sources(
    docs: DataFrame,
    weights: dict[str, float],
    rest: float = 0.0,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    scale: float = 1.0,
    seed: int = SEED,
) -> DataFrame:
    """``docs`` repeated to the target ``weights`` (source to weight) and shuffled globally.

    ``rest`` is the weight of all other sources, null included, taken together.

    Adds ``copy`` (0, 1, ...) and ``shuffle_key``; input columns with these names are replaced.
    A document with a mean below one may well get no copy; that is the operator's sampling.

    Rows are dealt by a hash of the copy and sorted by it within the partition, which is a random
    order over the whole output and needs no range sampling. A hot source is an ordinary case: the
    few rates go into the expression, nothing is joined or grouped by source but the sums. Null
    texts have no mass and are repeated like others of their source; a null doc_id is replaced by
    a hash of the text; rows that share a doc_id get equal draws; an empty table gives an empty
    one.
    """
    keep = [c for c in docs.columns if c not in ("copy", "shuffle_key")]
    docs = docs.select(*keep)
    mass = F.char_length(F.coalesce(F.col(text), F.lit(""))).cast("bigint")
    rates = target_rates(docs, weights, rest, F.col(source), mass, scale)
    key = F.coalesce(F.col(doc_id).cast("string"), F.md5(F.coalesce(F.col(text), F.lit(""))))
    counted = docs.withColumn("copy", copies(rates, F.col(source), key, seed))
    copied = exploded(counted.filter("copy > 0"))
    order = F.md5(F.concat_ws(":", F.lit("order"), F.lit(seed), key, F.col("copy")))
    return (
        copied.withColumn("shuffle_key", order)
        .repartition("shuffle_key")
        .sortWithinPartitions("shuffle_key")
    )

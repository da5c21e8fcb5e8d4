"""Poisson replication: the distribution, the target shares, edge cases."""

import math
from collections import Counter

from pyspark.sql import functions as F

from tagweave.llm.mixing import MAX_TABLE, copies, mix_sources, poisson_steps, poisson_table


def test_steps_are_the_distribution():
    for mean in (0.01, 0.3, 1.0, 7.5, 16.0):
        steps = poisson_steps(mean)
        pmf = [math.exp(-mean + k * math.log(mean) - math.lgamma(k + 1)) for k in range(len(steps))]
        assert all(abs(s - sum(pmf[: k + 1])) < 1e-12 for k, s in enumerate(steps))
        assert 1 - steps[-1] < 1e-12


def test_counts_follow_the_distribution(spark):
    n = 20000
    for rate in (0.2, 1.5, 40.0):
        df = spark.range(n).select(copies({"s": rate}, F.lit("s"), F.col("id").cast("string"), 42).alias("k"))
        ks = [r.k for r in df.collect()]
        mean = sum(ks) / n
        variance = sum((k - mean) ** 2 for k in ks) / n
        assert abs(mean - rate) < 5 * math.sqrt(rate / n)
        assert abs(variance / rate - 1) < 0.08


def test_tables_around_the_mode():
    for mean in (16.5, 300.25, 11000.0, MAX_TABLE):
        low, steps = poisson_table(mean)
        # a unit in the last place of the exponent's terms is all the comparison can resolve
        near = 1e-13 * (1 + mean * math.log(mean))
        pmf = [math.exp(-mean + k * math.log(mean) - math.lgamma(k + 1)) for k in range(low, low + len(steps))]
        assert all(abs(b - a - p) <= near for a, b, p in zip(steps, steps[1:], pmf[1:], strict=False))
        assert steps[0] < 1e-15 or low == 0
        assert 1 - steps[-1] < 1e-12 and len(steps) < 6000


def test_large_means(spark):
    n = 3000
    for rate in (100.0, 11000.0, 675000.0):
        df = spark.range(n).select(copies({"s": rate}, F.lit("s"), F.col("id").cast("string"), 42).alias("k"))
        ks = [r.k for r in df.collect()]
        mean = sum(ks) / n
        variance = sum((k - mean) ** 2 for k in ks) / n
        assert abs(mean - rate) < 5 * math.sqrt(rate / n)
        assert abs(variance / rate - 1) < 0.13


def test_a_source_with_hardly_any_text_left(spark):
    schema = "doc_id bigint, text string, source string"
    docs = spark.createDataFrame([(0, "x", "small")] + [(i, "y" * 2000, "big") for i in range(1, 21)], schema)
    out = mix_sources(docs, {"small": 1.0, "big": 1.0})
    counts = Counter()
    for r in out.select("doc_id", "copy").collect():
        counts[r.doc_id] += 1
        counts["last"] = max(counts["last"], r.copy)
    assert abs(counts[0] - 20000) < 6 * math.sqrt(20000) and counts["last"] == counts[0] - 1
    assert out.select("doc_id", "copy").distinct().count() == out.count()


def test_target_shares_and_order(spark):
    rows = [(i, "x" * 100, "hot" if i % 3 else f"s{i % 4}", 1) for i in range(12000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, copy int")
    out = mix_sources(docs, {"hot": 1.0, "s0": 1.0, "s1": 2.0, "gone": 5.0}, rest=1.0).collect()
    mass = Counter(r.source for r in out)
    total = 12000 / 10  # per unit of weight; the source that is not there leaves its share
    for name, weight in {"hot": 1, "s0": 1, "s1": 2}.items():
        assert abs(mass[name] - weight * total) < 6 * math.sqrt(4 * total)
    assert abs(mass["s2"] + mass["s3"] - total) < 6 * math.sqrt(4 * total)
    assert len({(r.doc_id, r.copy) for r in out}) == len(out)
    again = mix_sources(docs.repartition(7), {"hot": 1.0, "s0": 1.0, "s1": 2.0, "gone": 5.0}, rest=1.0)
    assert sorted(map(str, again.collect())) == sorted(map(str, out))
    # neighbours in the output are no neighbours in the input
    steps = [abs(a.doc_id - b.doc_id) for a, b in zip(out, out[1:], strict=False)]
    assert sum(s < 100 for s in steps) < 0.1 * len(steps)


def test_nulls_repeats_and_empty(spark):
    schema = "doc_id bigint, text string, source string"
    rows = [(None, None, None), (None, "a", None), (1, None, "s"), (2, "b" * 5, "s"), (2, "b" * 5, "s"), (3, "", "t")]
    docs = spark.createDataFrame(rows, schema)
    out = mix_sources(docs, {"s": 1.0}, rest=1.0, scale=50.0)
    assert out.columns == ["doc_id", "text", "source", "copy", "shuffle_key"]
    counts = Counter(r.doc_id for r in out.collect())
    assert counts[2] % 2 == 0 and counts[2] > 0
    assert mix_sources(spark.createDataFrame([], schema), {"s": 1.0}).count() == 0
    assert mix_sources(docs.filter("text is null"), {"s": 1.0}).count() == 0

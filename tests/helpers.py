"""Small frames and a plain-Python scorer to check against."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import functions as F

from tagweave.operators.features import conform
from tagweave.operators.tags import tag_index


def one_column(spark, values, fn, ctype="string"):
    """Apply a column function to each value; results in input order."""
    df = spark.createDataFrame(list(enumerate(values)), f"i int, v {ctype}")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


def catalogue(spark, rows):
    """Items from (position, artist, title, primary, secondary, descriptors, avg, count)."""
    df = spark.createDataFrame(
        rows,
        "position int, artist_name string, release_name string, primary_genres array<string>, "
        "secondary_genres array<string>, descriptors array<string>, avg_rating double, "
        "rating_count int",
    )
    return conform(df)


SCORING = [
    (1, "A", "a", ["Rock"], ["Pop"], ["dark", "sad"], 4.0, 10),
    (2, "B", "b", ["Rock"], [], ["dark"], 3.5, 20),
    (3, "C", "c", ["Pop", "pop"], ["Rock"], ["Explicit", ""], 3.5, 10),
    (4, "D", "d", [], [], [], 5.0, 99),
    (5, "E", "e", ["Jazz"], [], [], 5.0, 99),
    (6, "F", "f", ["Rock"], ["Pop"], ["dark", "sad", "t1", "t2", "t3"], 3.0, 5),
    (7, "G", "g", [], [], ["sad", *[f"g{i}" for i in range(1, 8)]], 2.0, 1),
    (8, "H", "h", [], [], ["dark", "sad", "pop", *[f"h{i}" for i in range(1, 6)]], 2.0, 1),
]


def scoring_index(spark):
    items = catalogue(spark, SCORING)
    return items, tag_index(items)


def naive_scores(weights, ratings, selected):
    """{position: (score, raw)} by the pairwise definition, in rank order."""
    out = []
    chosen = [weights[p] for p in selected if p in weights]
    for position, tags in weights.items():
        if position in selected or not tags:
            continue
        raw = sum(s[t] + tags[t] for s in chosen for t in s.keys() & tags.keys())
        if raw > 0:
            score = round((raw / len(tags)) * 100.0 * min(1.0, len(tags) / 7.0))
            out.append((-score, -ratings[position][0], -ratings[position][1], position, raw))
    return [(p, raw, -score) for score, _, _, p, raw in sorted(out)]


@contextmanager
def plan_of_writes(spark):
    """Texts of the plans of what is executed inside, from Spark's own store of executions."""
    store = spark._jsparkSession.sharedState().statusStore()
    before = store.executionsCount()
    plans = []
    yield plans
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    found = store.executionsList()
    plans += [found.apply(i).physicalPlanDescription() for i in range(before, found.size())]

from pyspark.sql import functions as F

from tagweave.functions.lists import feature_map, parse_list, tag_names
from tagweave.operators import features
from tests.helpers import one_column

LISTS = [
    (None, []),
    ("", []),
    ("NA", []),
    ("Art Rock, Space Rock", ["Art Rock", "Space Rock"]),
    ('"a, b"', ["a", "b"]),
    ("a,,b", ["a", "", "b"]),
    ("a, ", ["a", ""]),
    (" NA ", ["NA"]),
    ("   ", [""]),
    ('"', [""]),
    ('"a', ['"a']),
    (' "a " ', ["a"]),
]


def test_parse_list(spark):
    values, expected = zip(*LISTS)
    assert one_column(spark, values, parse_list) == list(expected)


def test_feature_map(spark):
    df = spark.createDataFrame(
        [
            (["Rock", "Rock", ""], ["Pop"], ["dark"], ["dark", "dark", "x"]),
            ([], None, [""], None),
        ],
        "p array<string>, s array<string>, d array<string>, t array<string>",
    )
    rows = df.select(feature_map(*[F.col(c) for c in "psdt"]).alias("m")).collect()
    expected = {
        "primary_Rock": 4.0,
        "secondary_Pop": 2.0,
        "descriptor_dark": 2.0,
        "tag_dark": 2.0,
        "tag_x": 1.0,
    }
    assert {frozenset(r.m.items()) for r in rows} == {frozenset(expected.items()), frozenset()}


def test_long_tag_list_stays_cheap_behind_a_filter(spark):
    """A filter on the features may not make the run lengths be computed per element."""
    tags = F.transform(F.sequence(F.lit(1), F.lit(20_000)), lambda i: F.concat(F.lit("w"), i % 9_000))
    none = F.array().cast("array<string>")
    df = spark.range(4).select(feature_map(none, none, none, tags).alias("m"))
    exploded = df.select(F.explode("m").alias("k", "v"))
    assert exploded.agg(F.count("k"), F.sum("v")).first()[:] == (36_000, 80_000.0)


def test_tag_names(spark):
    df = spark.createDataFrame(
        [([(" Rock ",), ("",), (None,), ("rock",)],), (None,)], "t array<struct<name:string>>"
    )
    got = [r[0] for r in df.select(tag_names(F.col("t"))).collect()]
    assert sorted(got) == [[], ["rock", "rock"]]


def _raw(spark):
    return spark.createDataFrame(
        [
            (1, "X", "t", None, "album", "Rock, Pop", "NA", "dark, ", None, None),
            (2, "Y", "u", "2001", "album", "Rock", "Pop", "tag_x", 3.5, 7),
        ],
        "position int, artist_name string, release_name string, release_date string, "
        "release_type string, primary_genres string, secondary_genres string, "
        "descriptors string, avg_rating double, rating_count int",
    )


def test_build_items_defaults_and_enrichment(spark):
    tags = spark.createDataFrame([(2, ["x", "x"])], "position int, tag_list array<string>")
    rows = {r.position: r for r in features.build_items(_raw(spark), tags).collect()}
    assert (rows[1].avg_rating, rows[1].rating_count, rows[1].lastfm_tags) == (0.0, 0, None)
    assert rows[1].descriptors == ["dark", ""]
    assert rows[2].features["tag_x"] == 2.0 and rows[2].features["descriptor_tag_x"] == 2.0


def test_vocabularies(spark):
    items = features.build_items(_raw(spark))
    final = [r.feature for r in features.feature_vocabulary(items).collect()]
    assert final == sorted(final)
    assert "descriptor_" not in final
    first = {(r.kind, r.feature) for r in features.list_vocabulary(items).collect()}
    assert ("descriptor", "descriptor_") in first
    counts = {r.kind: r.n for r in features.vocabulary_counts(items).collect()}
    assert counts == {"primary": 2, "secondary": 1, "descriptor": 3, "all": 6}


def test_enriched_count_includes_lookalikes(spark):
    row = features.enriched_item_count(features.build_items(_raw(spark))).first()
    assert (row.enriched, row["items"]) == (1, 2)

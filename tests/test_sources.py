"""Sources: damaged input is an error and never a smaller table; types of numbers; identity."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from helpers import one_column
from tagweave.functions.params import parse_int
from tagweave.operators.crawl import apply_crawl_cache, upsert_cache
from tagweave.operators.indexing import dense_index
from tagweave.operators.recommend import clamp_top_n, recommend, recommend_batch
from tagweave.operators.tags import tag_index
from tagweave.schemas import CRAWL_CACHE, RAW_CATALOGUE
from tagweave.sources import catalogue, crawl_cache, feed

HEADER = ",".join(RAW_CATALOGUE.names)


def csv(tmp_path, *rows):
    path = tmp_path / "items.csv"
    path.write_text("\n".join([HEADER, *rows]) + "\n")
    return str(path)


def test_csv_numbers(spark, tmp_path):
    path = csv(
        tmp_path,
        '3000000000,A,"a ""q""",2001,album,Rock,NA,"x, y",3.5,12.0',
        "2,B,b,,album,,,,, ",
        "3,C,c,,album,,,,4,12.9",
    )
    rows = {r.position: r for r in catalogue.read_csv_catalogue(spark, path).collect()}
    assert set(rows) == {3000000000, 2, 3}
    assert (rows[3000000000].rating_count, rows[2].rating_count, rows[3].rating_count) == (12, None, 12)
    assert rows[3000000000].release_name == 'a "q"' and rows[2].avg_rating is None


@pytest.mark.parametrize("row", ["x,A,a,,album,,,,1,1", "1,A,a,,album,,,,high,1", "1,A,a,,album,,,,1,many"])
def test_csv_bad_number_is_an_error(spark, tmp_path, row):
    with pytest.raises(Exception, match="is no number"):
        catalogue.read_csv_catalogue(spark, csv(tmp_path, row)).collect()


RECORDS = [
    {"artist_name": "A", "release_name": "a", "playcount": 12.0, "listeners": "12.0"},
    {"artist_name": "B", "release_name": "b", "playcount": 12.9, "listeners": True},
    {"artist_name": "C", "release_name": "c", "playcount": "7", "listeners": 3000000000},
    {"artist_name": "D", "release_name": "d", "playcount": None},
]


def test_feed_counters_keep_their_type(spark, tmp_path):
    path = tmp_path / "feed.json"
    path.write_text(json.dumps(RECORDS))
    rows = feed.read_external_feed(spark, [str(path), str(tmp_path / "missing.json")])
    got = rows.select("artist_name", parse_int(F.col("playcount"), 0), parse_int(F.col("listeners"), 0))
    assert sorted(map(tuple, got.collect())) == [("A", 12, 0), ("B", 12, 1), ("C", 7, 3000000000), ("D", 0, 0)]


def test_truncated_feed_is_an_error(spark, tmp_path):
    path = tmp_path / "feed.json"
    text = json.dumps(RECORDS * 50)
    path.write_text(text[: len(text) // 2])
    with pytest.raises(Exception):  # noqa: B017 - whatever the JSON reader raises
        feed.read_external_feed(spark, [str(path)]).collect()


def names_in_order(spark, path):
    rows = feed.read_external_feed(spark, [str(path)]).select("record_seq", "artist_name").collect()
    assert sorted(r.record_seq for r in rows) == list(range(len(rows)))
    return [r.artist_name for r in sorted(rows)]


@pytest.mark.parametrize("bytes_at_once", ["128m", "97"])
def test_feed_order_is_that_of_names_and_places(spark, tmp_path, bytes_at_once):
    """One, fifty and five records, with braces and quotes in strings, nested objects and line
    breaks: in order, however the bytes are dealt."""
    odd = ["}", "{", 'a"}{"b', "\\", '\\"}', "[{]}", "é}\n", "x" * 300]
    want = []
    for part, n in enumerate([1, 50, 5, 0]):
        names = [f"{part}-{i} {odd[i % len(odd)]}" for i in range(n)]
        records = [
            {"artist_name": a, "release_name": "{", "similar_albums": [{"artist": "}", "title": '"'}] * (i % 3), "tags": []}
            for i, a in enumerate(names)
        ]
        (tmp_path / f"part{part}.json").write_text(json.dumps(records, indent=part or None))
        want += names
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", bytes_at_once)
    try:
        assert names_in_order(spark, tmp_path) == want
        assert names_in_order(spark, tmp_path / "part1.json") == want[1:51]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", kept)


@pytest.mark.parametrize(
    "text", ['[{"artist_name": "a"}', '[{"a": {"b": 1}]', "{}", "[{} {}]", "[1, {}]"]
)
def test_what_is_no_array_of_objects_is_an_error(spark, tmp_path, text):
    (tmp_path / "feed.json").write_text(text)
    with pytest.raises(Exception):  # noqa: B017
        feed.read_external_feed(spark, [str(tmp_path / "feed.json")]).collect()


def entries(spark, n=200):
    rows = [(f"k{i}", True, {"rock": 2**40}, ["rock"], [], i) for i in range(n)]
    return spark.createDataFrame(rows, CRAWL_CACHE)


@pytest.mark.parametrize("format", ["parquet", "json"])
def test_damaged_cache_is_an_error_or_empty(spark, tmp_path, format):
    path = str(tmp_path / "cache")
    entries(spark).repartition(4).write.format(format).save(path)
    assert crawl_cache.read_cache(spark, path, format).count() == 200
    first = sorted((tmp_path / "cache").glob("part-*"))[0]
    first.write_bytes(first.read_bytes()[:150])
    with pytest.raises(Exception):  # noqa: B017
        crawl_cache.read_cache(spark, path, format).collect()
    with pytest.raises(Exception):  # noqa: B017
        crawl_cache.write_cache(crawl_cache.read_cache(spark, path, format), entries(spark, 3), str(tmp_path / "new"))
    with pytest.warns(UserWarning, match="counts as empty"):
        assert crawl_cache.read_cache(spark, path, format, damaged="empty").count() == 0
    assert crawl_cache.read_cache(spark, str(tmp_path / "none"), format).count() == 0


def test_cache_as_one_object(spark, tmp_path):
    found = {"tags": {"rock": 5}, "tag_list": ["rock"], "similar_albums": [{"artist": "x", "title": "y"}], "playcount": 7}
    path = tmp_path / "cache.json"
    path.write_text(json.dumps({"A - a": found, "B - b": None}, indent=2))
    rows = {r.cache_key: r for r in crawl_cache.read_cache(spark, str(path), "object").collect()}
    assert rows["A - a"].found and rows["A - a"].tag_list == ["rock"] and rows["A - a"].tags == {"rock": 5}
    assert not rows["B - b"].found and rows["B - b"].tag_list is None
    path.write_text(path.read_text()[:-30])
    with pytest.raises(Exception):  # noqa: B017
        crawl_cache.read_cache(spark, str(path), "object").collect()


def test_json_lines_round_trip(spark, sf_dir, tmp_path):
    from tagweave.plans import star

    items = star.items(spark, sf_dir)
    catalogue.write_json_lines(items, str(tmp_path / "lines"))
    back = catalogue.read_json_lines(spark, str(tmp_path / "lines"))
    same = lambda df: sorted(str(r.asDict(True)) for r in df.select(*items.columns).collect())
    assert same(back) == same(items)
    broken = sorted((tmp_path / "lines").glob("part-*"))[0]
    broken.write_bytes(broken.read_bytes()[:-40])
    with pytest.raises(Exception):  # noqa: B017
        catalogue.read_json_lines(spark, str(tmp_path / "lines")).collect()


def test_integers_by_type(spark):
    parse = lambda v: parse_int(v, 50)
    assert one_column(spark, [3.0, 3.9, -3.9, float("nan"), float("inf"), 1e30, None], parse, "double") == [
        3, 3, -3, 50, 50, 2**63 - 1, 50,
    ]
    assert one_column(spark, [True, False, None], parse, "boolean") == [1, 0, 50]
    assert one_column(spark, [2**60, None], parse, "bigint") == [2**60, 50]
    assert one_column(spark, ["3", " 1_0 ", "3.0", "many", None], parse, "string") == [3, 10, 50, 50, 50]
    assert [clamp_top_n(v) for v in (3.0, "7", "many", None, True, float("nan"), 10**9)] == [3, 7, 50, 50, 1, 50, 5000]


def test_ratings_that_are_no_numbers_rank_alike(spark, monkeypatch):
    nan = float("nan")
    rows = [(i, "Rock", r) for i, r in enumerate([1.0, 2.0, nan, None, 4.0, 0.0, nan, 3.0], 1)]
    items = spark.createDataFrame(rows, "position bigint, g string, avg_rating double").select(
        "position", F.array("g").alias("primary_genres"), F.array().cast("array<string>").alias("secondary_genres"),
        F.array().cast("array<string>").alias("descriptors"), "avg_rating", F.lit(1).alias("rating_count"),
        F.lit("a").alias("artist_name"), F.lit("r").alias("release_name"),
    )
    index = tag_index(items)
    order = lambda df: [r.position for r in df.orderBy("rank").collect()]
    one = order(recommend(index, items, [1], 8))
    asked = spark.createDataFrame([(0, 1)], "request_id bigint, position bigint")
    assert one == order(recommend_batch(index, items, asked, 8)) == [5, 8, 2, 3, 4, 6, 7]
    monkeypatch.setattr("tagweave.operators.recommend.SHORT_SELECTION", 0)
    assert order(recommend(index, items, [1], 8)) == one


def test_positions_must_be_unique(spark, tmp_path):
    from helpers import scoring_index

    _, index = scoring_index(spark)
    with pytest.raises(ValueError, match="unique"):
        catalogue.write_index(index.unionByName(index.limit(1)), str(tmp_path / "index"))


def test_first_fetch_decides(spark):
    schema = StructType([*CRAWL_CACHE.fields, StructField("seq", IntegerType())])
    rows = [("A - a", True, None, ["x"], [], 1, 2), ("A - a", False, None, None, None, None, 1)]
    items = spark.createDataFrame([(1, "A", "a")], "position bigint, artist_name string, release_name string")
    cache = entries(spark, 1)
    for some in (rows, rows[::-1]):
        fetched = spark.createDataFrame(some, schema)
        new = upsert_cache(cache, fetched, "seq").filter("cache_key = 'A - a'").collect()
        assert [r.found for r in new] == [False]
        assert apply_crawl_cache(items, cache, fetched, "seq").count() == 0
        chosen = upsert_cache(cache, fetched.drop("seq")).filter("cache_key = 'A - a'").collect()
        assert [r.found for r in chosen] == [True]
        assert apply_crawl_cache(items, cache, fetched.drop("seq")).count() == 1


@pytest.mark.parametrize("bits", [2, 16])
def test_numbering_of_values_far_apart(spark, bits):
    import random

    rng = random.Random(1)
    values = sorted({rng.getrandbits(64) - 2**63 for _ in range(3000)})
    keys = spark.createDataFrame([(v % 3, v) for v in values], "w int, v bigint")
    got = {(r.w, r.v): r.n for r in dense_index(keys, "v", "n", within="w", bits=bits).collect()}
    want = sorted(got)
    assert [got[k] for k in want] == list(range(1, len(values) + 1))


def test_json_arrays_are_written_in_order_and_never_held_whole(spark, tmp_path):
    """Several arrays, from rows in any order with equal places: a sort writes them, no list."""
    from helpers import plan_of_writes

    rows = spark.range(3000).selectExpr(
        "cast(id % 3 as int) as file",
        "id * 7919 % 1000 as place",
        "concat('{\"artist_name\":\"', id * 7919 % 1000, '-', id, '\"}') as json",
    )
    path = str(tmp_path / "arrays")
    with plan_of_writes(spark) as plans:
        catalogue.write_json_arrays(rows, ["file"], ["place", "json"], path)
    assert not any("collect_list" in p or "collect_set" in p for p in plans)
    want = {}
    for r in rows.collect():
        want.setdefault(r.file, []).append((r.place, r.json))
    names = [json.loads(j)["artist_name"] for f in sorted(want) for _, j in sorted(want[f])]
    assert names_in_order(spark, path) == names


def test_feed_query_collects_no_array(spark, sf_dir):
    from checks.queries import source_feed
    from helpers import plan_of_writes

    with plan_of_writes(spark) as plans:
        source_feed(spark, sf_dir)
    arrays = [p for p in plans if "InsertIntoHadoopFsRelationCommand" in p and "source_rank" in p and "/sources/" in p]
    assert arrays and not any("collect_list" in p for p in arrays)

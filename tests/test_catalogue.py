import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tagweave import schemas
from tagweave.operators import crawl, external, features
from tagweave.operators.features import conform
from tagweave.operators.indexing import dense_index
from tagweave.operators.recommend import recommend
from tagweave.operators.search import search_index, suggest
from tagweave.operators.tags import tag_index
from tagweave.operators.variants import consolidate_variants
from tagweave.plans.build import build_catalogue
from tagweave.session import shared_folder, stage, staging
from tagweave.sources import catalogue, crawl_cache, feed


def _items(spark):
    df = spark.createDataFrame(
        [
            (1, "X", "Foo", {"a": 4.0, "b": 2.0}, ["d1", "d2"], ["t"]),
            (2, "x", "Foo (Deluxe)", {"a": 4.0, "c": 1.0}, ["d2", "d3", "d3"], None),
            (3, "Y", "Bar", {"z": 1.0}, ["q"], ["t"]),
        ],
        "position int, artist_name string, release_name string, features map<string,float>, "
        "descriptors array<string>, lastfm_tags array<string>",
    )
    return conform(df)


def test_consolidate(spark):
    rows = {r.position: r for r in consolidate_variants(_items(spark)).collect()}
    first, second = rows[1], rows[2]
    assert len(rows) == 2
    assert first.features == {"a": 8.0, "b": 2.0, "c": 1.0}
    assert first.descriptors == ["d1", "d2", "d3"]
    assert (first.artist_name, first.release_name) == ("X", "Foo")
    assert (first.variant_count, first.source, first.lastfm_tags) == (2, "rym", None)
    assert (second.release_name, second.features, second.descriptors) == ("Bar", {"z": 1.0}, ["q"])
    assert (second.variant_count, second.source, second.lastfm_tags) == (None, None, ["t"])


def test_merged_descriptors_keep_base_duplicates_and_order(spark):
    df = spark.createDataFrame(
        [
            (5, "a", "T clean", {}, ["m", "m", ""]),
            (9, "A", "t", {"f": 1.0}, ["z", "m", "b"]),
            (7, "a", "T", None, ["b", "a", None]),
        ],
        "position int, artist_name string, release_name string, features map<string,float>, "
        "descriptors array<string>",
    )
    rows = consolidate_variants(conform(df)).collect()
    assert [r.descriptors for r in rows] == [["m", "m", "", "b", "a", None, "z"]]
    assert rows[0].variant_count == 3 and rows[0].position == 1


def test_one_group_holding_a_third(spark):
    wide = spark.range(3000).select(
        (F.col("id") + 1).cast("int").alias("position"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("a"), "id")).alias(
            "artist_name"
        ),
        F.lit("T").alias("release_name"),
        F.array(F.concat(F.lit("d"), F.col("id") % 7)).alias("descriptors"),
        F.create_map(F.lit("f"), F.lit(1.0).cast("float")).alias("features"),
    )
    rows = consolidate_variants(conform(wide)).filter("variant_count > 1").collect()
    assert len(rows) == 1
    assert rows[0].variant_count == 1000 and rows[0].features == {"f": 1000.0}
    assert rows[0].descriptors == ["d0", "d3", "d6", "d2", "d5", "d1", "d4"]


@pytest.mark.parametrize("bits", [1, 3, 16])
def test_dense_index(spark, bits):
    df = spark.createDataFrame(
        [(1, -5), (1, 40), (0, 7), (0, 1_000_000), (1, 3), (0, 2**40)], "src int, v bigint"
    ).repartition(3)
    rows = dense_index(df, "v", "n", within="src", bits=bits).orderBy("n").collect()
    assert [(r.src, r.v, r.n) for r in rows] == [
        (0, 7, 1), (0, 1_000_000, 2), (0, 2**40, 3), (1, -5, 4), (1, 3, 5), (1, 40, 6),
    ]


def _feed(spark, records):
    return spark.createDataFrame(records, schemas.EXTERNAL_FEED)


def test_external_append(spark):
    tags = [(" Rock ",), ("",), (None,)]
    many = [(f"T{i}",) for i in range(35)]
    records = [
        (0, 0, "", "Z", [], None, None, None),
        (0, 1, "X", "FOO", [], None, None, None),
        (0, 2, "N", "New", tags, "12", "x", None),
        (1, 0, "n", " new ", many, "1", "1", None),
        (1, 1, "M", "Many", many, "5", None, [("a", "b")]),
        (1, 2, None, "Q", many, "5", None, None),
    ]
    rows = external.append_external(_items(spark), _feed(spark, records)).collect()
    new = {r.position: r for r in rows if r.source == "lastfm"}
    assert sorted(new) == [4, 5] and len(rows) == 5
    assert new[4].descriptors == ["rock"]
    assert new[4].features == {"descriptor_rock": 2.0, "tag_rock": 1.0}
    assert (new[4].lastfm_playcount, new[4].lastfm_listeners) == (12, 0)
    assert (new[4].primary_genres, new[4].lastfm_similar_albums) == ([], [])
    assert (new[4].release_type, new[4].avg_rating, new[4].rating_count) == ("album", 0.0, 0)
    assert len(new[5].descriptors) == 30 and len(new[5].features) == 65
    assert new[5].lastfm_similar_albums == [("a", "b")]


def test_no_feed_is_no_op(spark):
    assert external.append_external(_items(spark), None).count() == 3


def test_build_catalogue_order_of_steps(spark):
    raw = spark.createDataFrame(
        [
            (1, "X", "Foo", None, "album", "Rock", "NA", "d1", 4.0, 3),
            (2, "Y", "Bar", None, "album", "Pop", "NA", "d2", 4.0, 3),
        ],
        schemas.RAW_CATALOGUE,
    )
    records = [
        (0, 0, "x", "foo (deluxe)", [("new",)], "1", None, None),
        (0, 1, "Z", "Zed", [("z",)], "1", None, None),
    ]
    rows = {r.position: r for r in build_catalogue(raw, None, _feed(spark, records)).collect()}
    assert [rows[i].release_name for i in (1, 2, 3)] == ["Foo", "Bar", "Zed"]
    assert rows[1].variant_count == 2 and rows[1].descriptors == ["d1", "new"]
    assert rows[3].source == "lastfm"


CRAWL = [
    (
        "a - b",
        True,
        [("Rock", "100"), ("ok", "5"), ("Seen Live", "3"), ("rock", "50"), ("dream pop", "x"), (None, "1"), ("  ", "2")],
        [("A", "T")] * 3 + [(None, "T"), ("", "T"), ("A", None)] + [("B", "U")] * 8,
        "17",
    ),
    ("c - d", False, None, None, None),
    ("e - f", True, [], [], "many"),
]


def test_crawl_clean(spark):
    rows = {r.cache_key: r for r in crawl.clean_crawl(spark.createDataFrame(CRAWL, schemas.RAW_CRAWL)).collect()}
    hit = rows["a - b"]
    assert hit.tags == {"rock": 50, "dream pop": 1}
    assert hit.tag_list == ["rock", "rock", "dream pop"]
    assert len(hit.similar_albums) == 9 and hit.playcount == 17
    assert rows["c - d"][1:] == (False, None, None, None, None)
    assert rows["e - f"][1:] == (True, {}, [], [], 0)


def _named(spark, rows):
    return spark.createDataFrame(rows, "position int, artist_name string, release_name string")


def test_crawl_states_and_application(spark):
    cache = crawl.clean_crawl(spark.createDataFrame(CRAWL, schemas.RAW_CRAWL))
    items = _named(
        spark, [(1, "a", "b"), (2, "c", "d"), (3, "g", "h"), (4, "e", "f"), (5, "g", "h"), (6, "i", "j")]
    )
    # a found entry without a tag list counts as missing
    bare = spark.createDataFrame([("i - j", True, None, None, None, None)], schemas.CRAWL_CACHE)
    with_bare = cache.unionByName(bare)
    states = {r.position: r.state for r in crawl.crawl_states(items, with_bare).collect()}
    assert states[6] == "missing"
    assert 6 not in {r.position for r in crawl.apply_crawl_cache(items, with_bare).collect()}
    states = {r.position: r.state for r in crawl.crawl_states(items, cache).collect()}
    assert states == {1: "hit", 2: "missing", 3: "absent", 4: "hit", 5: "absent", 6: "absent"}
    fresh = [("g - h", True, [("jazz", "1")], [], "1"), ("i - j", False, None, None, None)]
    fetched = crawl.clean_crawl(spark.createDataFrame(fresh, schemas.RAW_CRAWL))
    got = {r.position: r for r in crawl.apply_crawl_cache(items, cache, fetched).collect()}
    assert sorted(got) == [1, 3, 4, 5]
    # kept on a cached hit though empty, dropped on the fetch itself, cached for the next item
    assert (got[4].similar_albums, got[3].similar_albums, got[5].similar_albums) == ([], None, [])
    merged = crawl.upsert_cache(cache, fetched.unionByName(cache))
    assert {r.cache_key: r.found for r in merged.collect()} == {
        "a - b": True, "c - d": False, "e - f": True, "g - h": True, "i - j": False,
    }
    edges = crawl.similar_edges(crawl.apply_crawl_cache(items, cache))
    assert [r["rank"] for r in edges.orderBy("rank").collect()] == list(range(1, 10))


def test_csv_by_header_name(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text(
        "release_name,position,artist_name,release_date,release_type,primary_genres,"
        "secondary_genres,descriptors,avg_rating,rating_count,review_count\n"
        '"A ""q"" title",1,Art,1999,album,"Rock, Pop",NA,dark,4.25,10,3\n'
        "Plain,2,Art,,album,Rock,NA,,,,\n"
    )
    rows = {r.position: r for r in catalogue.read_csv_catalogue(spark, str(path)).collect()}
    assert rows[1].release_name == 'A "q" title' and rows[1].primary_genres == "Rock, Pop"
    assert (rows[1].avg_rating, rows[1].rating_count) == (4.25, 10)
    built = {r.position: r for r in features.build_items(catalogue.read_csv_catalogue(spark, str(path))).collect()}
    assert (built[2].avg_rating, built[2].rating_count, built[2].descriptors) == (0.0, 0, [])


def test_feed_files(spark, tmp_path):
    first, second = tmp_path / "a.json", tmp_path / "b.json"
    second.write_text(
        json.dumps(
            [
                {"artist_name": "P", "release_name": "Q", "tags": [{"name": "x"}], "playcount": 3},
                {"artist_name": "R", "release_name": "S", "listeners": "9"},
            ]
        )
    )
    assert feed.read_external_feed(spark, [str(first)]) is None
    got = feed.read_external_feed(spark, [str(first), str(second)]).orderBy("record_seq").collect()
    assert [(r.source_rank, r.artist_name, r.playcount, r.listeners) for r in got] == [
        (1, "P", "3", None), (1, "R", None, "9"),
    ]


def test_processed_round_trip(spark, tmp_path):
    items = _items(spark)
    assert catalogue.write_processed(items, str(tmp_path / "out")) == {"items": 3, "vocabulary": 4}
    again, vocabulary = catalogue.read_processed(spark, str(tmp_path / "out"))
    assert again.schema == schemas.ITEMS
    assert sorted(r.feature for r in vocabulary.collect()) == ["a", "b", "c", "z"]
    catalogue.write_json_lines(items, str(tmp_path / "json"))
    assert spark.read.schema(schemas.ITEMS).json(str(tmp_path / "json")).count() == 3


def test_cache_files(spark, tmp_path):
    path = str(tmp_path / "cache")
    empty = crawl_cache.read_cache(spark, path)
    assert empty.count() == 0
    cleaned = crawl.clean_crawl(spark.createDataFrame(CRAWL, schemas.RAW_CRAWL))
    crawl_cache.write_cache(empty, cleaned, path)
    assert crawl_cache.read_cache(spark, path).count() == 3
    lines = str(tmp_path / "lines")
    crawl_cache.write_cache(empty, cleaned, lines, "json")
    again = crawl_cache.read_cache(spark, lines, "json")
    assert {r.cache_key: r.tags for r in again.collect()} == {
        r.cache_key: r.tags for r in cleaned.collect()
    }
    edges = crawl.similar_edges(crawl.apply_crawl_cache(_named(spark, [(1, "a", "b")]), cleaned))
    crawl_cache.write_similar(edges, str(tmp_path / "edges"))
    assert spark.read.parquet(str(tmp_path / "edges")).count() == 9


def test_staged_tables_live_in_the_shared_folder(spark):
    staged = stage(spark.range(5), "five")
    assert staged.count() == 5
    assert all(shared_folder(spark).removeprefix("file:") in f for f in staged.inputFiles())


def test_staging_scope_deletes_its_tables(spark):
    kept = stage(spark.range(3), "kept")
    with staging(spark):
        inside = stage(spark.range(5), "inside")
        folder = Path(inside.inputFiles()[0].removeprefix("file://")).parent
        assert inside.count() == 5 and folder.exists()
    assert not folder.exists()
    assert kept.count() == 3


def test_a_cluster_needs_the_setting():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(Session())
    Session.conf = {"spark.checkpoint.dir": "hdfs:///shared/"}
    assert shared_folder(Session()) == "hdfs:///shared"


def test_files_to_recommendations(spark, tmp_path):
    """CSV, feed file and crawl table to written items, read back and queried."""
    source = tmp_path / "in.csv"
    source.write_text(
        "position,artist_name,release_name,release_date,release_type,primary_genres,"
        "secondary_genres,descriptors,avg_rating,rating_count\n"
        '1,X,Foo,1999,album,"Rock, Pop",NA,dark,4.0,10\n'
        "2,X,Foo (Deluxe),1999,album,Rock,NA,sad,4.5,3\n"
        "3,Y,Bar,1999,album,Rock,Jazz,NA,3.0,7\n"
    )
    (tmp_path / "feed.json").write_text(
        json.dumps([{"artist_name": "Z", "release_name": "Zed", "tags": [{"name": "Rock"}]}])
    )
    raw = catalogue.read_csv_catalogue(spark, str(source))
    entry = [("X - Foo", True, [("mellow", "3")], [], "1")]
    cache = crawl.clean_crawl(spark.createDataFrame(entry, schemas.RAW_CRAWL))
    records = feed.read_external_feed(spark, [str(tmp_path / "no.json"), str(tmp_path / "feed.json")])
    built = build_catalogue(raw, crawl.apply_crawl_cache(raw, cache), records)
    assert catalogue.write_processed(built, str(tmp_path / "out"))["items"] == 3
    items, _ = catalogue.read_processed(spark, str(tmp_path / "out"))
    first = items.filter("position = 1").first()
    assert first.descriptors == ["dark", "sad"] and first.features["tag_mellow"] == 1.0
    catalogue.write_index(tag_index(items), str(tmp_path / "index"))
    index = spark.read.parquet(str(tmp_path / "index"))
    got = recommend(index, items, [1]).orderBy("rank").collect()
    # shared tag rock: primary with primary on Y, primary with descriptor on Z
    assert [(r.release_name, r.raw_points, r.score) for r in got] == [("Bar", 3.0, 43), ("Zed", 2.0, 29)]
    assert suggest(search_index(items), "foo", 5).first().display == "X - Foo"

import random

from tagweave.operators import display, lookup
from tagweave.operators.recommend import recommend
from tagweave.operators.search import (
    autocomplete,
    by_gram,
    gram_counts,
    gram_heads,
    gram_postings,
    search_index,
    suggest,
)
from tagweave.session import stage
from tests.helpers import catalogue, scoring_index

RADIO = [
    (1, "Radiohead", "OK Computer", [], [], [], 4.0, 100),
    (2, "Radiohead", "OK Computer (Deluxe Edition)", [], [], [], 4.0, 500),
]


def _entries(spark, rows):
    return search_index(catalogue(spark, rows))


def _texts(spark, index, query, limit=None):
    return [r.display for r in suggest(index, query, limit).collect()]


def test_one_entry_per_variant_group(spark):
    entry = _entries(spark, RADIO).first()
    assert (entry.position, entry.variant_count, entry.rating_count) == (1, 2, 100)
    assert entry.raw_search_blob == "radiohead ok computer ok computer (deluxe edition)"
    assert entry.normalized_search_blob == "radiohead ok computer"


def test_suggest(spark):
    index = _entries(spark, RADIO)
    shown = ["Radiohead - OK Computer (2 versions)"]
    for query in ("ok computer deluxe", "deluxe", "  ", "RADIOHEAD  ok"):
        assert _texts(spark, index, query) == shown, query
    assert _texts(spark, index, "o") == []
    assert _texts(spark, index, "zz") == []


def test_representative_prefers_plain_title_then_ratings_then_position(spark):
    rows = [
        (4, "a", "T", [], [], [], 1.0, 5),
        (3, "A", "t", [], [], [], 1.0, 9),
        (2, "A ", "t  ", [], [], [], 1.0, 9),
        (1, "a", "T (clean)", [], [], [], 1.0, 99),
    ]
    entry = _entries(spark, rows).first()
    assert (entry.position, entry.min_position, entry.variant_count) == (2, 1, 4)


def test_order_is_static(spark):
    rows = [
        (1, "b", "x one", [], [], [], 1.0, 1),
        (2, "B", "x two", [], [], [], 1.0, 1),
        (3, "a", "x three", [], [], [], 1.0, 1),
        (4, "z", "x four", [], [], [], 1.0, 1),
        (5, "z", "x four", [], [], [], 1.0, 1),
    ]
    index = _entries(spark, rows)
    assert _texts(spark, index, "x ", "abc") == [
        "z - x four (2 versions)", "B - x two", "a - x three", "b - x one",
    ]
    assert len(_texts(spark, index, "x ", "-4")) == 1


def test_batch_equals_scan(spark):
    """Gram lookup against a scan of all pairs, needles of every length, hot queries included."""
    rng = random.Random(2)
    words = ["ab", "abc", "b", "red", "blue ring", "é", "deluxe", "x(y", "clean cut"]
    rows = [
        (p, rng.choice(words), " ".join(rng.choice(words) for _ in range(rng.randrange(1, 4))), [], [], [], 1.0, 1)
        for p in range(1, 120)
    ]
    index = _entries(spark, rows)
    queries = ["ab", "abc deluxe", "b deluxe", "  ", "é", "e r", "blue ring b", "zzz", "x(", "a", "Deluxe", "clean"]
    requests = [(i, rng.choice(queries), rng.choice(["3", "50", "abc", None])) for i in range(60)]
    df = spark.createDataFrame(requests, "request_id bigint, query string, limit string")
    got = {}
    for r in autocomplete(index, df).collect():
        got.setdefault(r.request_id, []).append((r["rank"], r.display))
    for i, query, limit in requests:
        expected = _texts(spark, index, query, limit)
        assert [d for _, d in sorted(got.get(i, []))] == expected, (query, limit)


def test_stored_postings_and_heads_equal_scan(spark):
    """Lookups of one gram or of the rarest one, for needles of every length, against the scan."""
    rng = random.Random(3)
    words = ["ab", "abc", "b", "red", "blue ring", "é", "deluxe", "x(y", "clean cut"]
    rows = [
        (p, rng.choice(words), " ".join(rng.choice(words) for _ in range(rng.randrange(1, 4))), [], [], [], 1.0, 1)
        for p in range(1, 160)
    ]
    index = stage(_entries(spark, rows), "entries")
    postings = stage(by_gram(gram_postings(index)), "postings")
    stored = (
        postings,
        stage(by_gram(gram_counts(postings)), "counts"),
        stage(by_gram(gram_heads(index, postings)), "heads"),
    )
    assert stored[2].selectExpr("max(size(head))").first()[0] == 50
    for query in ["ab", "abc deluxe", "b deluxe", "  ", "é ", "blue ring b", "zzz", "zzzz", "x(", "a", "clean cut re"]:
        found = [r.display for r in suggest(index, query, 50, *stored).collect()]
        assert found == _texts(spark, index, query, 50), query
    queries = spark.createDataFrame([(i, q) for i, q in enumerate(["ab", "red b", "x(", "blue ring"])], "request_id bigint, query string")
    asked = queries.selectExpr("*", "'50' AS limit")
    got = {}
    for r in autocomplete(index, asked, *stored).collect():
        got.setdefault(r.request_id, []).append((r["rank"], r.display))
    for r in queries.collect():
        assert [d for _, d in sorted(got[r.request_id])] == _texts(spark, index, r.query, 50)


def test_one_keystroke_reads_its_gram_only(spark):
    index = stage(_entries(spark, RADIO), "entries")
    postings = stage(by_gram(gram_postings(index)), "postings")
    counts, heads = (stage(by_gram(t), "x") for t in (gram_counts(postings), gram_heads(index, postings)))
    plan = suggest(index, "ok", 10, postings, counts, heads)._jdf.queryExecution().toString()
    assert "EqualTo(gram,ok)" in plan and "search_blob" not in plan.split("== Physical Plan ==")[1]
    plan = suggest(index, "computer", 10, postings, counts, heads)._jdf.queryExecution().toString()
    assert "EqualTo(gram," in plan


def test_variant_counts_add_up(spark):
    rows = [(p, f"a{p % 3}", f"t{p % 5}", [], [], [], 1.0, 1) for p in range(1, 50)]
    index = _entries(spark, rows)
    assert sum(r.variant_count for r in index.collect()) == 49


def test_lookups(spark):
    items = catalogue(
        spark,
        [
            (1, "A", "Same", [], [], [], 1.0, 1),
            (2, "a", "SAME", [], [], [], 1.0, 1),
            (3, "B", " x", [], [], [], 1.0, 1),
        ],
    )
    requests = spark.createDataFrame([(0, 3), (1, 9), (2, 2**40)], "request_id bigint, position bigint")
    assert [(r.request_id, r.position) for r in lookup.lookup(items, requests).collect()] == [(0, 3)]
    assert lookup.item_detail(items, 2).first().release_name == "SAME"
    pairs = spark.createDataFrame(
        [(0, "A", "same"), (1, "b", "x"), (2, "B", " X")], "request_id bigint, artist string, title string"
    )
    found = {r.request_id: r.position for r in lookup.find_exact(items, pairs).collect()}
    assert found == {0: 1, 2: 3}


def test_display(spark):
    items, index = scoring_index(spark)
    rows = display.display_rows(recommend(index, items, [1])).orderBy("rank").collect()
    assert (rows[0].heading, rows[0].points, rows[0].primary) == ("#1: f", "86 pts", "Rock")
    assert (rows[0].rating, rows[0].ratings) == ("3.00/5.0", "5")
    assert rows[3].primary is None and rows[3].descriptors == "dark, sad, pop, h1, h2, h3, h4, h5"


def test_display_numbers(spark):
    columns = (
        "request_id bigint, rank int, position int, artist_name string, release_name string, "
        "score double, avg_rating double, rating_count int, primary_genres array<string>, "
        "secondary_genres array<string>, descriptors array<string>"
    )
    values = [(25.125, "25.13"), (2.675, "2.67"), (0.375, "0.38"), (1234.5, "1234.50"), (4.0, "4.00")]
    rows = [(0, i, i, "a", "t", 12.25, v, 1234567, [], [], list("abcdefghi")) for i, (v, _) in enumerate(values)]
    rows.append((0, 9, 9, "a", "t", 1500.0, None, 3, None, [], []))
    got = {r["rank"]: r for r in display.display_rows(spark.createDataFrame(rows, columns)).collect()}
    assert [got[i].rating for i in range(5)] == [f"{text}/5.0" for _, text in values]
    assert got[0].ratings == "1,234,567" and got[0].descriptors == "a, b, c, d, e, f, g, h..."
    assert got[9][5:] == (None, None, "1500 pts", None, None, None)

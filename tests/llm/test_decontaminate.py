"""Suffix automaton against plain search; shards, spans and verdicts."""

import random

from pyspark.sql import functions as F

from tagweave.llm.decontaminate import (
    Automaton,
    contamination_digest,
    cut_spans,
    match_benchmark,
    remove_contaminated,
    words_of,
)


def plain(items, words, window):
    hit, found, longest = set(), set(), 0
    for item, text in items:
        k = min(window, len(text))
        for a in range(len(text) - k + 1 if k else 0):
            for b in range(len(words) - k + 1):
                if words[b : b + k] == text[a : a + k]:
                    hit.update(range(b, b + k))
                    found.add(item)
        for a in range(len(text)):
            for b in range(len(words)):
                n = 0
                while a + n < len(text) and b + n < len(words) and text[a + n] == words[b + n]:
                    n += 1
                longest = max(longest, n)
    return hit, found, longest


def test_automaton_against_plain_search():
    rng = random.Random(3)
    for turn in range(300):
        alphabet = [bytes([97 + i]) for i in range(rng.choice([2, 3, 6]))]
        text = lambda n: [rng.choice(alphabet) for _ in range(n)]
        window = rng.randint(2, 6)
        items = [(i, text(rng.randint(0, 9))) for i in range(rng.randint(0, 6))]
        words = [w if rng.random() < 0.95 else b"zz" for w in text(rng.randint(0, 40))]
        longest, spans, found = Automaton(items, window).matches(words)
        hit, want, most = plain(items, words, window)
        assert {i for a, b in spans for i in range(a, b)} == hit, turn
        assert found == want
        assert sorted(spans) == spans and all(a[1] < b[0] for a, b in zip(spans, spans[1:], strict=False))
        if spans:
            assert longest == most


def test_words():
    assert words_of(None) == []
    assert words_of("A-b\x00ÉÉ 9") == [b"a", b"b", "ÉÉ".encode(), b"9"]


ITEM = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
DOCS = [
    (1, "x " * 30 + ITEM.upper()),
    (2, "x " * 5000 + ITEM),
    (3, None),
    (4, ""),
    (5, "two three four"),
    (6, "Short-item"),
    (6, "Short-item"),
    (None, ITEM),
]


def test_verdicts_spans_and_shards(spark):
    docs = spark.createDataFrame(
        [(i, t, "d", 0) for i, t in DOCS], "doc_id bigint, text string, item_id string, _state int"
    )
    items = spark.createDataFrame([(1, ITEM), (2, "short item"), (3, None), (4, "...")], "item_id bigint, text string")
    once = match_benchmark(docs, items)
    rows = sorted(once.collect(), key=str)
    got = sorted((r.doc_id or 0, r.n_words, r.n_hit, sorted(r["items"]), r.contaminated) for r in rows)
    assert got == [
        (0, 14, 14, [1], True),
        (1, 44, 14, [1], True),
        (2, 5014, 14, [1], False),
        (3, 0, 0, [], False),
        (4, 0, 0, [], False),
        (5, 3, 0, [], False),
        (6, 2, 2, [2], True),
        (6, 2, 2, [2], True),
    ]
    for few in (3, 14):
        parts = contamination_digest(match_benchmark(docs, items, shard_words=few))
        assert sorted(parts.collect(), key=str) == sorted(contamination_digest(once).collect(), key=str)
    kept = remove_contaminated(docs, items)
    assert kept.columns == docs.columns
    texts = {r.doc_id: r.text for r in kept.collect()}
    assert texts[2] == "x " * 5000 and texts[3] is None and texts[5] == "two three four"
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3, 4, 5]
    cut = docs.join(once.select("doc_id", "spans"), "doc_id").filter("doc_id = 1")
    assert cut.select(cut_spans(F.col("text"), F.col("spans"))).first()[0] == "x " * 30


def test_spans_over_the_length_limit_are_cut_and_short_items_are_not(spark):
    filler = "plain words " * 400
    rows = [(1, filler + ITEM + " " + filler + "Short-item " + ITEM.upper() + " tail", 9), (2, "short item " + filler, 9)]
    docs = spark.createDataFrame([(*r, "m") for r in rows], "doc_id bigint, text string, n_chars int, match string")
    items = spark.createDataFrame([(1, ITEM), (2, "short item")], "item_id bigint, text string")
    for few in (5, 100_000):
        kept = {r.doc_id: r for r in remove_contaminated(docs, items, shard_words=few).collect()}
        assert kept[1].text == filler + " " + filler + " tail"
        assert kept[1].n_chars == len(kept[1].text) and kept[1].match == "m"
        assert (kept[2].text, kept[2].n_chars) == (rows[1][1], 9)


def test_very_long_text(spark):
    docs = spark.createDataFrame([(1, "so it goes " * 500_000 + ITEM)], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, ITEM)], "item_id bigint, text string")
    row = match_benchmark(docs, items).first()
    assert (row.n_words, row.n_hit, row.contaminated) == (1_500_014, 14, False)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id bigint, text string")
    items = spark.createDataFrame([], "item_id bigint, text string")
    docs = spark.createDataFrame([(1, "a b")], "doc_id bigint, text string")
    assert match_benchmark(none, items).count() == 0
    row = match_benchmark(docs, items).first()
    assert (row.n_words, row.n_hit, row.contaminated) == (2, 0, False)
    assert remove_contaminated(docs, items).count() == 1

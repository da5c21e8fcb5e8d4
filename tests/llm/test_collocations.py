"""Collocations: against counting all n-grams, with collisions, cut texts and odd input."""

import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tagweave.llm import collocations as module
from tagweave.llm.collocations import Bitmap, Words, bitmap_of, collocations, windows

SCHEMA = "doc_id bigint, text string, lang string"


def slow(rows, min_count, max_words=5, top=2000):
    counts, totals = {}, Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        found = counts.setdefault(lang, Counter())
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", lowered):
            words = [w for w in re.split("[ \t]+", piece) if w]
            totals[lang] += len(words)
            for n in range(1, max_words + 1):
                found.update(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
    out = []
    for lang, found in counts.items():
        chosen = {p: a for p, a in found.items() if a >= min_count}
        gone = {
            p[i : i + m]
            for p, a in chosen.items()
            for m in range(2, len(p))
            for i in range(len(p) - m + 1)
            if a >= chosen[p[i : i + m]]
        }
        ranked = []
        for p, a in chosen.items():
            if len(p) > 1 and p not in gone:
                score, k = min(
                    (1000 * a * totals[lang] // (found[p[:k]] * found[p[k:]]), k) for k in range(1, len(p))
                )
                ranked.append((-score, -a, " ".join(p).encode(), found[p[:k]], found[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(ranked)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def rows_of(found):
    return sorted(tuple(r) for r in found.drop("near_doc_id").collect())


def corpus(seed, n=150):
    """Texts with few words, so that phrases repeat; odd blanks, ends, letters and languages."""
    rng = random.Random(seed)
    words = ["a", "B", "c", "é", "É", "ÀB", "x_y", "中", "dd", "e\x00", " "]
    gaps = [" "] * 12 + ["  ", "\t", ". ", ", ", "\n", "\r\n", "!", "\x0b"]
    langs = ["en", "de", None, "und", ""]

    def text():
        return "".join(rng.choice(words) + rng.choice(gaps) for _ in range(rng.randint(0, 60)))

    return [(i, text(), rng.choice(langs)) for i in range(n)] + [(None, None, "en"), (7, "", None), (7, " .", "fr")]


@pytest.mark.parametrize("seed", [1, 2])
def test_all_phrases_by_definition(spark, seed):
    rows = corpus(seed)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert rows_of(collocations(docs, min_count=8)) == slow(rows, 8)


def test_first_phrases_and_ties(spark):
    rows = corpus(3)
    docs = spark.createDataFrame(rows, SCHEMA)
    assert rows_of(collocations(docs, min_count=4, top=9)) == slow(rows, 4, top=9)


def test_colliding_fingerprints_change_nothing(spark, monkeypatch):
    """Frequent sets that let everything through, and words that share their fingerprint."""
    rows = corpus(4, 60)
    docs = spark.createDataFrame(rows, SCHEMA)
    monkeypatch.setattr(module, "LEAST_BITS", 6)
    monkeypatch.setattr(module, "MOST_BITS", 6)
    assert rows_of(collocations(docs, min_count=6)) == slow(rows, 6)

    words = Words(b"one two one three")
    words.hash = np.array([1, 2, 1, 1], np.uint64)
    assert words.exact_ids(np.ones(4, bool)).tolist() == [0, 1, 0, 2]
    words = Words(b"one two one oner")
    words.hash = np.array([1, 2, 1, 1], np.uint64)
    assert words.exact_ids(np.ones(4, bool)).tolist() == [0, 1, 0, 2]


def test_texts_are_cut_between_words():
    rng = random.Random(5)
    texts = ["".join(rng.choice("ab .") for _ in range(rng.randint(0, 80))).encode() for _ in range(40)]
    for limit in (1, 7, 50, 10_000):
        for n in (1, 2, 5):
            found, whole = Counter(), Counter()
            for words in windows(texts, limit):
                found.update(words.phrase(i, n) for i in words.grams(n, 0)[0])
            for text in texts:
                for piece in text.decode().split("."):
                    w = piece.split()
                    whole.update(" ".join(w[i : i + n]) for i in range(len(w) - n + 1))
            assert found == whole, (limit, n)


def test_equal_grams_have_equal_keys_wherever_they_stand():
    words = Words(b"x aa bb cc  y aa\tbb cc")
    first, keys = words.grams(3, 9)
    by_place = dict(zip(first.tolist(), keys.tolist(), strict=True))
    assert by_place[1] == by_place[5]
    assert len(set(by_place.values())) == len(by_place) - 1
    assert words.keys(np.array([1]), 3, 8)[0] != by_place[1]


def test_bitmap_holds_all_keys(spark):
    keys = np.random.default_rng(1).integers(0, 1 << 64, 5000, dtype=np.uint64)
    table = spark.createDataFrame([(int(k),) for k in keys.view(np.int64)], "key bigint")
    bitmap = bitmap_of(table)
    assert bitmap.has(keys).all()
    others = np.random.default_rng(2).integers(0, 1 << 64, 5000, dtype=np.uint64)
    assert bitmap.has(others).mean() < 0.1
    assert isinstance(bitmap_of(table.limit(0)), Bitmap)


def test_very_long_text_and_clashing_columns(spark):
    long = "so it goes. " * 200_000  # 2.4 MB
    rows = [(1, long, "en"), (2, "and so it goes", "en")]
    docs = spark.createDataFrame(rows, SCHEMA)
    for name in ("key", "times", "phrase", "score", "n", "salt", "rank"):
        docs = docs.withColumn(name, F.lit("x"))
    assert rows_of(collocations(docs)) == [
        ("en", 1, "so it goes", 200_001, 200_001, 200_001, 600_004, 1000 * 600_004 // 200_001)
    ]


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert collocations(docs).collect() == []
    nulls = spark.createDataFrame([(None, None, None)], SCHEMA)
    assert collocations(nulls).collect() == []


def test_a_window_takes_few_bytes_more_than_its_words():
    """Numbers of eight bytes are made of words and of one block of bytes, not of all bytes."""
    rng = np.random.default_rng(6)
    data = bytes(rng.choice(np.frombuffer(b"abcdefgh     .", np.uint8), 1 << 21))
    data = data.replace(b" ", b"wordy ")
    size, limit = len(data), 1 << 16
    seen = {}
    for block in (limit, 1 << 30):
        module.BLOCK_BYTES, kept = block, module.BLOCK_BYTES
        tracemalloc.start()
        try:
            words = Words(data)
            seen[block] = tracemalloc.get_traced_memory()[1], words.hash, words.exact_ids(np.ones(len(words.hash), bool))
        finally:
            tracemalloc.stop()
            module.BLOCK_BYTES = kept
    (few, hashes, ids), (_, whole, same) = seen.values()
    assert (hashes == whole).all() and (ids == same).all()
    assert few < 16 * size

"""Phrase collocation mining with Rabin-Karp fingerprints.

A text's bytes are hashed by prefix polynomials in numpy, so that each word's fingerprint, and from
those each n-gram's, is a difference of two prefixes. Fingerprints are shuffled and summed, one
length after the other: an n-gram is only counted if both n-grams inside it that are one word
shorter were frequent. Frequent fingerprints are then followed from their occurrences to the text,
compared there, and counted anew as phrases, which makes all counts exact whatever collides.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagweave.session import stage

# Fixed values of the contract.
MIN_COUNT, MAX_WORDS, TOP = 100, 5, 2000
NO_LANG = "und"

# Bytes hashed at once. Longer texts are cut between words; n-grams go on over the cut.
WINDOW_BYTES = 1 << 21
# Bytes of a window that are hashed or compared at a time: 8-byte numbers are made of these only.
BLOCK_BYTES = 1 << 17
# The set of frequent fingerprints is sent to the tasks as a bitmap, about 1 in SPARSE of its bits
# set. At its largest size it lets more infrequent n-grams through, which are then counted.
SPARSE, LEAST_BITS, MOST_BITS = 32, 16, 28
SALTS = 32

_WORD_BASE, _GRAM_BASE = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95  # odd, so they have inverses
_IN_WORD, _BLANK, _END = 0, 1, 2


def _byte_kinds() -> bytes:
    """Whether a byte belongs to a word, parts words, or ends a piece."""
    ends = set(b".,;:!?\n\x0b\x0c\r")
    return bytes(_END if b in ends else _BLANK if b in b" \t" else _IN_WORD for b in range(256))


_KINDS = _byte_kinds()
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


@cache
def _powers(base: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of ``base`` and of its inverse, modulo 2^64."""

    def rising(b: int) -> np.ndarray:
        out = np.full(1 << bits, b, np.uint64)
        out[0] = 1
        return np.cumprod(out, dtype=np.uint64)

    return rising(base), rising(pow(base, -1, 1 << 64))


def powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    return _powers(base, max(16, int(size).bit_length()))


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads differences over all bits."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def prefix_hashes(values: np.ndarray, base: int) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """Hash of ``values[a:b]`` for arrays a, b: a difference of prefix polynomials, shifted to 0."""
    up, down = powers(base, len(values))
    prefix = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], dtype=np.uint64, out=prefix[1:])
    return lambda a, b: (prefix[b] - prefix[a]) * down[a]


def blocks(end: np.ndarray, limit: int) -> Iterator[slice]:
    """Slices of words that end at the bytes ``end``, of about ``limit`` bytes, at least a word."""
    first, reached = 0, 0
    while first < len(end):
        last = max(first + 1, int(np.searchsorted(end, reached + limit, "right")))
        yield slice(first, last)
        first, reached = last, int(end[last - 1])


class Words:
    """Words of lower-cased bytes: where they are, in which piece, their fingerprints."""

    def __init__(self, data: bytes, first_new: int = 0):
        self.data, self.first_new = data, first_new
        kinds = np.frombuffer(data.translate(_KINDS), np.uint8)
        inside = np.zeros(len(kinds) + 2, np.int8)
        inside[1:-1] = kinds == _IN_WORD
        steps = np.diff(inside)
        self.start, self.end = np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)
        self.piece = np.searchsorted(np.flatnonzero(kinds == _END), self.start).astype(np.int32)
        self.bytes = np.frombuffer(data, np.uint8)
        self.hash = np.empty(len(self.start), np.uint64)
        for some in blocks(self.end, BLOCK_BYTES):
            start, end = self.start[some], self.end[some]
            values = self.bytes[start[0] : end[-1]].astype(np.uint64) + np.uint64(1)
            self.hash[some] = mixed(prefix_hashes(values, _WORD_BASE)(start - start[0], end - start[0]))
        self.of_words = prefix_hashes(self.hash, _GRAM_BASE)

    def grams(self, n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
        """(first words, keys) of the n-grams inside pieces that end in a new word."""
        first = np.arange(max(0, self.first_new - n + 1), len(self.start) - n + 1)
        first = first[self.piece[first] == self.piece[first + n - 1]]
        return first, self.keys(first, n, seed)

    def keys(self, first: np.ndarray, n: int, seed: int) -> np.ndarray:
        """Fingerprints of the n-grams that begin with the words ``first``, made unlike for each
        length and ``seed``."""
        own = np.uint64((seed + n * _WORD_BASE) % (1 << 64))
        return mixed(self.of_words(first, first + n) ^ own)

    def exact_ids(self, used: np.ndarray) -> np.ndarray:
        """A number per word (-1 where not ``used``), equal for equal words only.

        Words of equal fingerprint are compared byte by byte with the first of them; if any two
        differ, all are told apart by their bytes instead.
        """
        ids = np.full(len(self.start), -1)
        place = np.flatnonzero(used)
        if not len(place):
            return ids
        _, rep, number = np.unique(self.hash[place], return_index=True, return_inverse=True)
        like = place[rep[number]]
        size = self.end[place] - self.start[place]
        same = np.array_equal(size, self.end[like] - self.start[like])
        for some in blocks(np.cumsum(size), BLOCK_BYTES) if same else ():
            length = size[some]
            step = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
            mine, theirs = (np.repeat(self.start[p[some]], length) + step for p in (place, like))
            if not np.array_equal(self.bytes[mine], self.bytes[theirs]):
                same = False
                break
        if not same:
            words = [self.data[a:b] for a, b in zip(self.start[place], self.end[place], strict=True)]
            numbers = {w: i for i, w in enumerate(dict.fromkeys(words))}
            number = np.array([numbers[w] for w in words])
        ids[place] = number
        return ids

    def phrase(self, first: int, n: int) -> str:
        places = zip(self.start[first : first + n].tolist(), self.end[first : first + n].tolist(), strict=True)
        return b" ".join([self.data[a:b] for a, b in places]).decode()


def windows(texts: list[bytes], limit: int = WINDOW_BYTES, overlap: int = MAX_WORDS - 1) -> Iterator[Words]:
    """Words of ``texts``, about ``limit`` bytes at a time.

    Texts are parted by line breaks, so no n-gram spans two of them. A cut falls between words,
    and the ``overlap`` words before it are seen again, as words that are not new.
    """
    data = b"\n".join(texts).translate(_LOWER)
    begin, end, seen = 0, 0, 0
    while end < len(data):
        end += limit
        while end < len(data) and _KINDS[data[end]] == _IN_WORD:
            end += 1
        words = Words(data[begin:end], seen)
        yield words
        seen = min(overlap, len(words.start))
        begin = begin + int(words.start[-seen]) if seen else end


def seed_of(lang: str | None) -> int:
    """The same n-gram has another fingerprint in each language."""
    data = np.frombuffer((NO_LANG if lang is None else lang).encode() or b"\0", np.uint8).astype(np.uint64)
    return int(mixed(prefix_hashes(data, _WORD_BASE)(np.array([0]), np.array([len(data)])))[0])


class Bitmap:
    """Fixed-size set of fingerprints: by their top bits, with false positives."""

    def __init__(self, bits: int, places: np.ndarray, masks: np.ndarray):
        self.bits, self.words = bits, np.zeros(1 << (bits - 6), np.uint64)
        self.words[places] = masks.view(np.uint64)

    def has(self, keys: np.ndarray) -> np.ndarray:
        at = keys >> np.uint64(64 - self.bits)
        return (self.words[at >> np.uint64(6)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)


def bitmap_of(keys: DataFrame, bits: int | None = None) -> Bitmap:
    """Bitmap of the ``key`` column, put together by Spark: the driver gets at most its size."""
    if bits is None:
        bits = min(MOST_BITS, max(LEAST_BITS, (keys.count() * SPARSE).bit_length()))
    at = F.shiftrightunsigned("key", 64 - bits)
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), at.bitwiseAND(F.lit(63)).cast("int"))
    rows = keys.groupBy(F.shiftright(at, 6).alias("place")).agg(F.bit_or(bit).alias("mask")).toArrow()
    return Bitmap(bits, rows.column("place").to_numpy(), rows.column("mask").to_numpy())


def _by_lang(batch: pa.RecordBatch, limit: int) -> Iterator[tuple[str, int | None, list[bytes]]]:
    """(lang, smallest doc_id, texts) of some rows at a time, of about ``limit`` bytes."""
    ids, langs = (batch.column(c).to_pylist() for c in ("doc_id", "lang"))
    texts, held = batch.column("text"), {}
    for i, lang in enumerate(langs):
        text = texts[i].as_py()
        if not text:
            continue
        doc, size, some = held.get(lang, (None, 0, []))
        some.append(text.encode())
        doc = ids[i] if doc is None else doc if ids[i] is None else min(doc, ids[i])
        size += len(some[-1])
        if size >= limit:
            yield lang, doc, some
            held.pop(lang, None)
        else:
            held[lang] = (doc, size, some)
    for lang, (doc, _, some) in held.items():
        yield lang, doc, some


def _scan(docs: DataFrame, schema: str, of_words) -> DataFrame:
    """Rows that ``of_words`` (lang, smallest doc_id, words) gives as columns, from all texts."""
    names = [c.split()[0] for c in schema.split(", ")]
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}
    types = [kinds[c.split()[1]] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, doc, texts in _by_lang(batch, 2 * WINDOW_BYTES):
                for words in windows(texts):
                    columns = of_words(lang, doc, words)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, type=t) for c, t in zip(columns, types, strict=True)], names=names
                    )

    return docs.mapInArrow(run, schema)


def frequent_keys(docs: DataFrame, n: int, shorter: Bitmap | None, min_count: int) -> DataFrame:
    """(key, doc_id) of the n-grams that occur ``min_count`` times, with a document near one of
    them; colliding ones are counted together.

    Only n-grams whose parts of n - 1 words are in ``shorter`` are shuffled: once per window and
    summed by each task before.
    """
    sent = docs.sparkSession.sparkContext.broadcast(shorter)

    def count(lang, doc, words):
        seed = seed_of(lang)
        first, keys = words.grams(n, seed)
        if n > 1:
            parts = sent.value.has(words.keys(np.arange(len(words.start) - n + 2), n - 1, seed))
            keys = keys[parts[first] & parts[first + 1]]
        keys, times = np.unique(keys, return_counts=True)
        return keys.view(np.int64), times, np.full(len(keys), -1 if doc is None else doc)

    counted = _scan(docs, "key bigint, times bigint, doc_id bigint", count)
    summed = counted.groupBy("key").agg(F.sum("times").alias("times"), F.min("doc_id").alias("doc_id"))
    return summed.filter(F.col("times") >= min_count).select("key", "doc_id")


def phrase_counts(docs: DataFrame, frequent: Bitmap, max_words: int, min_count: int) -> DataFrame:
    """(lang, n_words, phrase, times, doc_id): exact counts of frequent phrases, and of all words
    of a language as those of ``n_words`` 0; ``doc_id`` is that of a document at or shortly before
    an occurrence.

    Occurrences of a frequent fingerprint are compared word by word with the first one of their
    window; only that one's text is written out. What collides gets a phrase of its own.
    """
    sent = docs.sparkSession.sparkContext.broadcast(frequent)

    def count(lang, doc, words):
        seed, found = seed_of(lang), []
        for n in range(1, max_words + 1):
            first, keys = words.grams(n, seed)
            chosen = sent.value.has(keys)
            found.append((n, first[chosen], keys[chosen]))
        used = np.zeros(len(words.start), bool)
        for n, first, _ in found:
            for k in range(n):
                used[first + k] = True
        ids = words.exact_ids(used)
        sizes, phrases, counts = [0], [None], [len(words.start) - words.first_new]
        for n, first, keys in found:
            _, rep, number, times = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
            like = first[rep[number]]
            if any((ids[first + k] != ids[like + k]).any() for k in range(n)):
                rows = np.column_stack([ids[first + k] for k in range(n)])
                _, rep, times = np.unique(rows, axis=0, return_index=True, return_counts=True)
            sizes += [n] * len(rep)
            phrases += [words.phrase(i, n) for i in first[rep].tolist()]
            counts += times.tolist()
        m = len(sizes)
        return [NO_LANG if lang is None else lang] * m, sizes, phrases, counts, [-1 if doc is None else doc] * m

    counted = _scan(docs, "lang string, n_words int, phrase string, times bigint, doc_id bigint", count)
    summed = counted.groupBy("lang", "n_words", "phrase").agg(
        F.sum("times").alias("times"), F.min("doc_id").alias("doc_id")
    )
    return summed.filter((F.col("times") >= min_count) | (F.col("n_words") == 0))


def _exact_score(a: Column, n: Column, left: Column, right: Column) -> Column:
    """floor(1000 a n / (l r)) in decimals of 38 digits."""
    wide = lambda c: c.cast("decimal(19,0)")
    return F.call_function("div", wide(a * 1000) * wide(n), wide(left) * wide(right))


def scored(counts: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, n, score, doc_id) of the phrases of two words and more, by the cut
    that scores least."""
    named = counts.filter(F.col("n_words") > 0).select("lang", "phrase", "times")
    totals = counts.filter(F.col("n_words") == 0).select("lang", F.col("times").alias("n"))
    words = F.split("phrase", " ")
    cuts = counts.filter(F.col("n_words") > 1).select(
        "lang",
        "phrase",
        F.col("times").alias("a"),
        "doc_id",
        F.explode(F.sequence(F.lit(1), F.col("n_words") - 1)).alias("k"),
    )
    parts = cuts.withColumns(
        {
            "first": F.array_join(F.slice(words, F.lit(1), F.col("k")), " "),
            "rest": F.array_join(F.slice(words, F.col("k") + 1, F.size(words) - F.col("k")), " "),
        }
    )
    left = named.select("lang", F.col("phrase").alias("first"), F.col("times").alias("l"))
    right = named.select("lang", F.col("phrase").alias("rest"), F.col("times").alias("r"))
    both = parts.join(left, ["lang", "first"]).join(right, ["lang", "rest"]).join(F.broadcast(totals), "lang")
    score = _exact_score(F.col("a"), F.col("n"), F.col("l"), F.col("r"))
    least = F.min(F.struct(score.alias("score"), "k", "l", "r", "a", "n", "doc_id")).alias("cut")
    return both.groupBy("lang", "phrase").agg(least).select("lang", "phrase", "cut.*").drop("k")


def not_swallowed(phrases: DataFrame, counts: DataFrame) -> DataFrame:
    """``phrases`` without those inside a longer one that is as frequent.

    If any longer phrase is, one longer by a single word is, since counts only fall.
    """
    words = F.split("phrase", " ")
    ends = F.array(
        F.array_join(F.slice(words, F.lit(1), F.size(words) - 1), " "),
        F.array_join(F.slice(words, F.lit(2), F.size(words) - 1), " "),
    )
    inside = (
        counts.filter(F.col("n_words") > 2)
        .select("lang", F.explode(ends).alias("phrase"), "times")
        .groupBy("lang", "phrase")
        .agg(F.max("times").alias("longer"))
    )
    joined = phrases.join(inside, ["lang", "phrase"], "left")
    return joined.filter(F.col("longer").isNull() | (F.col("longer") < F.col("a"))).drop("longer")


def top_phrases(phrases: DataFrame, top: int) -> DataFrame:
    """The first ``top`` of each language with their ``rank``.

    Each of SALTS parts of a language keeps its own first ones before these meet in one window.
    """
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS))
    own = F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))
    few = phrases.withColumn("salt", salt).withColumn("own", own).filter(F.col("own") <= top)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint")
    return few.withColumn("rank", rank).filter(F.col("rank") <= top).drop("salt", "own")


def collocations(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    min_count: int = MIN_COUNT,
    max_words: int = MAX_WORDS,
    top: int = TOP,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score, near_doc_id) of each language's first ``top`` phrases.

    A-Z are lower-cased, texts are cut into pieces at ``.,;:!?`` and line breaks and into words at
    blanks and tabs. A phrase has 2 to ``max_words`` words of one piece and occurs ``min_count``
    times. ``near_doc_id`` leads to an occurrence: it is the smallest id in one of the groups of
    documents, neighbours in the input, that have one (null where that has no id).

    Null and empty texts have no words; a null ``lang`` is ``und``; repeated rows count as
    often as they occur; ties are settled by phrase; an empty table gives an empty one; ``doc_id``
    must be an integer or null and is not used for anything else; other columns are not read.

    Texts are read once per phrase length and once for the phrases, and never shuffled. The sets
    of frequent fingerprints and the phrases' counts are staged, and joins read those.
    """
    narrow = docs.select(
        F.col(doc_id).cast("bigint").alias("doc_id"),
        F.col(text).alias("text"),
        F.col(lang).alias("lang"),
    )
    found, shorter = [], None
    for n in range(1, max_words + 1):
        keys = stage(frequent_keys(narrow, n, shorter, min_count), f"frequent-{n}-grams")
        found.append(keys.select("key"))
        shorter = bitmap_of(keys)
    every = found[0]
    for keys in found[1:]:
        every = every.unionByName(keys)
    counts = stage(phrase_counts(narrow, bitmap_of(every), max_words, min_count), "phrase-counts")
    kept = not_swallowed(scored(counts), counts)
    near = F.when(F.col("doc_id") >= 0, F.col("doc_id")).alias("near_doc_id")
    return top_phrases(kept, top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score", near)

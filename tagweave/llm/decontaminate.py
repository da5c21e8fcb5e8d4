"""Benchmark decontamination with a generalised suffix automaton.

The automaton holds all test items as sequences of words. A document's words are streamed through
it; after each word its state tells the longest stretch of words ending there that occurs in some
item. Stretches as long as a window, or as long as a whole short item, mark their words as hit.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tagweave.llm.common import SLICE_ROWS, map_rows, unused
from tagweave.session import discard, stage

# Fixed values of the contract.
WINDOW = 13
COVERAGE = 20  # contaminated if hit words * COVERAGE >= words
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")  # before lower-casing

# Item words in one automaton, which bounds what is broadcast and what a task holds.
SHARD_WORDS = 100_000

_KEEP = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
    for c in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    """Words as UTF-8, ASCII letters lower-cased; all bytes of other characters are word bytes."""
    return (text or "").encode().translate(_KEEP).split()


class Automaton:
    """Suffix automaton of several word sequences, with the items behind each window."""

    def __init__(self, items: Iterable[tuple[object, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.vocabulary: dict[bytes, int] = {}
        self.length, self.link, self.next = [0], [-1], [{}]
        known = [
            (item, [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words])
            for item, words in items
            if words
        ]
        for _, word_ids in known:
            last = 0
            for word in word_ids:
                last = self._extend(last, word)
        self.least = min((min(len(w), window) for _, w in known), default=0)
        # state -> items whose window of full length is the state's string of that length
        self.windows: dict[int, set] = {}
        # state -> (length, items) of short items that are one of the state's strings
        self.short: dict[int, tuple[int, set]] = {}
        for item, word_ids in known:
            state = 0
            for n, word in enumerate(word_ids, 1):
                state = self.next[state][word]
                if n >= window:
                    self.windows.setdefault(self._ancestor(state, window), set()).add(item)
            if len(word_ids) < window:
                found = self._ancestor(state, len(word_ids))
                self._add_short(found, len(word_ids), item)
        self._find_short()

    def _state(self, length: int, link: int, following: dict) -> int:
        self.length.append(length)
        self.link.append(link)
        self.next.append(following)
        return len(self.length) - 1

    def _split(self, before: int, word: int, state: int) -> int:
        """A copy of ``state`` for the shorter of its strings, those that end ``before`` + word."""
        copy = self._state(self.length[before] + 1, self.link[state], dict(self.next[state]))
        self.link[state] = copy
        while before != -1 and self.next[before].get(word) == state:
            self.next[before][word] = copy
            before = self.link[before]
        return copy

    def _extend(self, last: int, word: int) -> int:
        there = self.next[last].get(word)
        if there is not None:
            fits = self.length[there] == self.length[last] + 1
            return there if fits else self._split(last, word, there)
        new = self._state(self.length[last] + 1, 0, {})
        at = last
        while at != -1 and word not in self.next[at]:
            self.next[at][word] = new
            at = self.link[at]
        if at != -1:
            there = self.next[at][word]
            fits = self.length[there] == self.length[at] + 1
            self.link[new] = there if fits else self._split(at, word, there)
        return new

    def _ancestor(self, state: int, length: int) -> int:
        """The state that holds the suffix of ``length`` words."""
        while self.length[self.link[state]] >= length:
            state = self.link[state]
        return state

    def _add_short(self, state: int, length: int, item) -> None:
        self.short.setdefault(state, (length, set()))[1].add(item)

    def _find_short(self) -> None:
        """For each state the nearest one on its suffix chain that ends a short item, or -1."""
        self.short_at = [-1] * len(self.length)
        for state in sorted(range(1, len(self.length)), key=self.length.__getitem__):
            up = self.link[state]
            self.short_at[state] = state if state in self.short else self.short_at[up]

    def matches(self, words: list[bytes]) -> tuple[int, list[tuple[int, int]], set]:
        """Longest match, hit stretches of words (merged, end exclusive), items found.

        A word of no item sends the automaton back to its start, so stretches of known words are
        cut out first, and those shorter than the shortest window are passed over.
        """
        ids = list(map(self.vocabulary.get, words))
        longest, spans, items = 0, [], set()
        begin, n = 0, len(ids)
        while self.least and begin <= n - self.least:
            try:
                end = ids.index(None, begin)
            except ValueError:
                end = n
            if end - begin >= self.least:
                most = self._stream(ids, begin, end, spans, items)
                longest = max(longest, most)
            begin = end + 1
        return longest, spans, items

    def _stream(self, ids: list[int], begin: int, end: int, spans: list, items: set) -> int:
        following, link, length = self.next, self.link, self.length
        window, short_at = self.window, self.short_at
        state = matched = longest = 0
        for at in range(begin, end):
            word = ids[at]
            while word not in following[state]:
                state = link[state]
                if state == -1:
                    break
                matched = length[state]
            if state == -1:
                state = matched = 0
                continue
            state = following[state][word]
            matched += 1
            if matched > longest:
                longest = matched
            hit = 0
            if matched >= window:
                hit = window
                items |= self.windows[self._ancestor(state, window)]
            found = short_at[state]
            while found > 0:
                size, whole = self.short[found]
                if size <= matched:
                    hit = max(hit, size)
                    items |= whole
                found = short_at[link[found]]
            if hit:
                first = at + 1 - hit
                while spans and spans[-1][1] >= first:
                    first = min(first, spans.pop()[0])
                spans.append((first, at + 1))
        return longest


def item_shards(items: DataFrame, window: int, shard_words: int) -> list[Broadcast]:
    """Pickled automata, sent to the tasks, over about ``shard_words`` words each of ``items`` (item_id, text).

    The items are measured first and collected a shard at a time; an item longer than a shard is
    cut into pieces that overlap by a window less one word. Without items there is one empty one.
    """
    cut = map_rows(
        items, ["item_id"], ["text"], "pieces array<array<binary>>",
        lambda: lambda value: (_pieces(words_of(value), window, shard_words),),
    )
    pieces = cut.select("item_id", F.explode("pieces").alias("words")).distinct()
    pieces = stage(pieces, "benchmark-words")
    total = pieces.agg(F.sum(F.size("words"))).first()[0] or 0
    shards = max(1, -(-total // shard_words))
    dealt = pieces.withColumn("shard", F.pmod(F.xxhash64("item_id", "words"), F.lit(shards)))
    context, out = items.sparkSession.sparkContext, []
    for shard in range(shards):
        rows = dealt.filter(F.col("shard") == shard).select("item_id", "words").collect()
        ready = [(r.item_id, [bytes(w) for w in r.words]) for r in rows]
        out.append(context.broadcast(pickle.dumps(Automaton(ready, window))))
    discard(pieces)
    return out


def _pieces(words: list[bytes], window: int, most: int) -> list[list[bytes]]:
    most = max(most, 2 * window)
    if len(words) <= most:
        return [words] if words else []
    return [words[a : a + most] for a in range(0, len(words) - window + 1, most - window + 1)]


def _char_spans(text: str | None, spans: list[tuple[int, int]]) -> list[dict]:
    if not spans:
        return []
    places = [m.span() for m in WORD.finditer(text)]
    return [{"start": places[a][0], "end": places[b - 1][1], "words": b - a} for a, b in spans]


def _union(a: list, b: list) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for first, last in sorted([*a, *b]):
        if out and out[-1][1] >= first:
            out[-1] = (out[-1][0], max(out[-1][1], last))
        else:
            out.append((first, last))
    return out


def match_rows(
    docs: DataFrame,
    items: DataFrame,
    keep: list[str],
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    coverage: int = COVERAGE,
    shard_words: int = SHARD_WORDS,
    result: str = "match",
) -> DataFrame:
    """The columns ``keep`` of each row of ``docs`` and a struct ``result`` with its matches.

    Texts are read once. Where the benchmark needs several automata, a task goes through them with
    the words of some rows at a time and holds one automaton.
    """
    item_type = items.schema[item_id].dataType.simpleString()
    items = items.select(F.col(item_id).alias("item_id"), F.col(item_text).alias("text"))
    shards = item_shards(items, window, shard_words)
    schema = (
        f"`{result}` struct<n_words:bigint,n_hit:bigint,longest:int,"
        f"spans:array<struct<start:int,end:int,words:int>>,items:array<{item_type}>,contaminated:boolean>"
    )
    fields = StructType([*docs.select(*keep).schema.fields, *StructType.fromDDL(schema).fields])
    columns = list(dict.fromkeys([*keep, text]))
    kept, read = [columns.index(c) for c in keep], columns.index(text)
    out_schema = to_arrow_schema(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only = pickle.loads(shards[0].value) if len(shards) == 1 else None
        rows = SLICE_ROWS if only else SLICE_ROWS * len(shards)
        for batch in batches:
            for first in range(0, batch.num_rows, rows):
                part = batch.slice(first, rows)
                texts = part.column(read).to_pylist()
                words = [words_of(value) for value in texts]
                found = [(0, [], set())] * len(texts)
                for shard in shards:
                    automaton = only or pickle.loads(shard.value)
                    for i, of_row in enumerate(words):
                        longest, hits, ids = automaton.matches(of_row)
                        before = found[i]
                        hits = _union(before[1], hits) if before[1] else hits
                        found[i] = (max(longest, before[0]), hits, ids | before[2])
                made = [
                    _verdict(value, len(w), *f, coverage) for value, w, f in zip(texts, words, found, strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(i) for i in kept], pa.array(made, type=out_schema.field(len(kept)).type)],
                    schema=out_schema,
                )

    return docs.select(*columns).mapInArrow(run, fields)


def _verdict(
    text: str | None, n_words: int, longest: int, hits: list[tuple[int, int]], items: set, coverage: int
) -> dict:
    n_hit = sum(b - a for a, b in hits)
    return {
        "n_words": n_words,
        "n_hit": n_hit,
        "longest": longest,
        "spans": _char_spans(text, hits),
        "items": [*items],
        "contaminated": 0 < n_hit and n_words <= coverage * n_hit,
    }


def match_benchmark(
    docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", **options
) -> DataFrame:
    """One row per input row: ``doc_id``, ``n_words``, ``n_hit``, ``longest``, ``spans``, ``items``,
    ``contaminated``.

    ``spans`` are the hit stretches in code points, with their number of words, and ``longest`` the
    longest match in words. An
    item of fewer words than ``window`` is one window. A document is contaminated if it has hits
    that make up 1/``coverage`` of its words or more.

    Documents are not shuffled or copied. Automata of bounded size are sent to the tasks, several
    for a benchmark of many words. Null and empty
    texts have no words and are clean, repeated rows give repeated results, empty tables give
    empty results or no hits, items without words never match, other columns are not read.
    """
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return match_rows(docs, items, ["doc_id"], **options).select("doc_id", "match.*")


def remove_contaminated(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    n_chars: str = "n_chars",
    window: int = WINDOW,
    **options,
) -> DataFrame:
    """``docs`` without what the benchmark gave away.

    Documents over the coverage limit (``contaminated``) go as a whole. From others the spans of
    ``window`` words and more are cut out, and a column ``n_chars`` is brought up to date; short
    items that occur in them are no reason to cut. All other documents stay as they are. Each row
    is judged where it is by its own text, so nothing is joined back by doc_id.
    """
    (result,) = unused(docs, "match")
    found = match_rows(docs, items, docs.columns, text, window=window, result=result, **options)
    kept = found.filter(~F.col(f"{result}.contaminated"))
    long = F.filter(f"{result}.spans", lambda s: s["words"] >= window)
    changes = F.size(long) > 0
    shorter = cut_spans(F.col(text), long)
    out = kept.withColumn(text, F.when(changes, shorter).otherwise(F.col(text)))
    if n_chars in docs.columns:
        length = F.char_length(text).cast(docs.schema[n_chars].dataType)
        out = out.withColumn(n_chars, F.when(changes, length).otherwise(F.col(n_chars)))
    return out.select(*docs.columns)


def cut_spans(text: Column, spans: Column) -> Column:
    """``text`` without its matched ``spans`` (in order, not overlapping)."""
    gaps = F.transform(
        F.concat(F.array(F.lit(0)), spans["end"]),
        lambda begin, i: F.substr(
            text,
            begin + 1,
            F.coalesce(F.get(spans["start"], i), F.char_length(text)) - begin,
        ),
    )
    return F.array_join(gaps, "")


def contamination_digest(matched: DataFrame) -> DataFrame:
    ids = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    return matched.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
        "contaminated",
    )

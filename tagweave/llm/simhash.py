"""SimHash near-duplicates, found with a pigeonring filter.

A fingerprint of 64 bits is a ring of ``d + 1`` segments, where ``d`` is the largest distance of
a link. If two fingerprints differ in at most d bits, then some segment starts a chain whose
every prefix of l segments differs in at most floor(l * d / (d + 1)) = l - 1 bits: the first
segment is equal, the first two differ in at most one bit, and so on round the ring. The first
two conditions make the join key; the longer prefixes prune before the full Hamming check.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from tagweave.llm.common import map_rows, unused
from tagweave.session import stage

BITS = 64
SEED = 42
SHINGLE_WORDS = 3
MAX_DISTANCE = 3
# Members of one key that meet in one comparison; larger keys are cut into tiles of two blocks.
BLOCK = 4096
_HASHED_AT_ONCE = 1 << 16
_EDGES_AT_ONCE = 1 << 17

_hash = partial(xxh64_intdigest, seed=SEED)


def fingerprint(text: str | None, shingle: int = SHINGLE_WORDS) -> int:
    """Bits set in over half of the shingles' hashes, as a signed 64-bit number."""
    words = (text or "").encode().lower().split()  # bytes: ASCII letters and blanks only
    if not words:
        return 0
    if len(words) < shingle:
        shingles, n = [b" ".join(words)], 1
    else:
        shingles = map(b" ".join, zip(*[words[k:] for k in range(shingle)], strict=False))
        n = len(words) - shingle + 1
    hashes = np.fromiter(map(_hash, shingles), np.uint64, n)
    counts = np.zeros(BITS, np.int64)
    for first in range(0, n, _HASHED_AT_ONCE):
        some = hashes[first : first + _HASHED_AT_ONCE].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(some, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * counts > n, bitorder="little")
    return int(bits.view(np.int64)[0])


def fingerprints(docs: DataFrame, doc_id: str, text: str, shingle: int) -> DataFrame:
    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return map_rows(
        narrow, ["doc_id"], ["text"], "fp bigint", lambda: lambda t: (fingerprint(t, shingle),)
    )


def segments(max_distance: int) -> list[tuple[int, int]]:
    """(offset, width) of the ring's segments."""
    n = max_distance + 1
    ends = [BITS * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(ends, ends[1:], strict=False)]


def ring_entries(fps: DataFrame, max_distance: int) -> DataFrame:
    """(ring, key, fp, exact): the chains of two segments that a fingerprint can share.

    ``exact`` rows hold the two segments as they are. Of two fingerprints that differ in one bit
    of the second segment one has that bit set, so variants with one set bit cleared suffice: a
    pair meets where at least one of its rows is exact.
    """
    ring = segments(max_distance)

    def part(at: int) -> Column:
        offset, width = ring[at % len(ring)]
        mask = -1 if width == BITS else (1 << width) - 1
        return F.shiftrightunsigned("fp", offset).bitwiseAND(F.lit(mask).cast("bigint"))

    def chain(i: int) -> Column:
        width = ring[(i + 1) % len(ring)][1]
        both = F.shiftleft(part(i), width).bitwiseOR(part(i + 1))
        bits = F.filter(
            F.array(*[F.lit(1 << b).cast("bigint") for b in range(width)]),
            lambda bit: part(i + 1).bitwiseAND(bit) != 0,
        )
        row = lambda key, exact: F.struct(
            F.lit(i).alias("ring"), key.alias("key"), F.lit(exact).alias("exact")
        )
        return F.concat(
            F.array(row(both, True)), F.transform(bits, lambda bit: row(both.bitwiseXOR(bit), False))
        )

    chains = F.concat(*[chain(i) for i in range(len(ring))])
    return fps.select("fp", F.explode(chains).alias("e")).select(
        "e.ring", "e.key", "fp", "e.exact"
    )


def _tiles(entries: DataFrame, block: int) -> DataFrame:
    """Entries of keys that can link, with the tiles of two blocks they take part in.

    Spark takes the exploded entries for as few rows as there are fingerprints, and would send
    them all through the driver to broadcast them: hence the hint.
    """
    counts = entries.groupBy("ring", "key").agg(
        F.count(F.lit(1)).alias("n"), F.max("exact").alias("some")
    )
    shared = counts.filter((F.col("n") > 1) & F.col("some")).select(
        "ring", "key", F.ceil(F.col("n") / F.lit(block)).cast("int").alias("blocks")
    )
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    tile = lambda b: F.struct(
        F.least("own", b).alias("low"), F.greatest("own", b).alias("high")
    )
    return (
        entries.join(shared.hint("merge"), ["ring", "key"])
        .withColumn("own", own)
        .withColumn(
            "tile", F.explode(F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), tile))
        )
        .select("ring", "key", "tile.low", "tile.high", "own", "exact", "fp")
    )


def _merge(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Roots after joining a[i] with b[i]; ``parent`` maps each place to its root."""
    while True:
        x, y = parent[a], parent[b]
        open_ = x != y
        if not open_.any():
            return parent
        a, b, x, y = a[open_], b[open_], x[open_], y[open_]
        np.minimum.at(parent, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(up := parent[parent], parent):
            parent = up


def chain_viable(x: np.ndarray, ring: int, max_distance: int) -> np.ndarray:
    """Whether differences ``x`` stay within the budgets of all longer chains from ``ring``."""
    parts = segments(max_distance)
    ok = np.ones(len(x), bool)
    mask = 0
    for length in range(1, len(parts)):
        offset, width = parts[(ring + length - 1) % len(parts)]
        mask |= ((1 << width) - 1) << offset
        if length > 1:
            ok &= np.bitwise_count(x & np.uint64(mask)) <= length - 1
    return ok


def link_groups(
    group: np.ndarray, ring: np.ndarray, cross: np.ndarray, own: np.ndarray, exact: np.ndarray,
    fp: np.ndarray, max_distance: int,
) -> np.ndarray:
    """For each row the first row of its component inside its group (rows are sorted by group).

    Rows are compared at growing shifts, all groups at once. Pairs already connected are skipped,
    and only roots are kept, so memory does not grow with the number of links.
    """
    parent = np.arange(len(fp))
    waiting: list[tuple[np.ndarray, np.ndarray]] = []
    held, shift, left = 0, 1, np.arange(len(fp) - 1)
    while True:
        left = left[left + shift < len(fp)]
        left = left[group[left] == group[left + shift]]
        if not len(left):
            break
        right = left + shift
        use = (exact[left] | exact[right]) & (~cross[left] | (own[left] != own[right]))
        use &= parent[left] != parent[right]
        a, b = left[use], right[use]
        x = fp[a] ^ fp[b]
        ok = np.zeros(len(a), bool)
        for r in np.unique(ring[a]):
            here = ring[a] == r
            ok[here] = chain_viable(x[here], int(r), max_distance)
        a, b, x = a[ok], b[ok], x[ok]
        close = np.bitwise_count(x) <= max_distance
        if close.any():
            waiting.append((a[close], b[close]))
            held += int(close.sum())
        if held > _EDGES_AT_ONCE:
            parent = _merge(parent, *map(np.concatenate, zip(*waiting, strict=True)))
            waiting, held = [], 0
        shift += 1
    if waiting:
        parent = _merge(parent, *map(np.concatenate, zip(*waiting, strict=True)))
    return parent


def links(fps: DataFrame, max_distance: int, block: int = BLOCK) -> DataFrame:
    """(a, b): links between distinct fingerprints that connect all that lie within the distance.

    Each tile gives a spanning forest, at most one link per member, and not all pairs.
    """
    tiles = _tiles(ring_entries(fps, max_distance), block)
    place = ["ring", "key", "low", "high"]
    names = [*place, "own", "exact", "fp"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def forest(rows: dict[str, np.ndarray], new: np.ndarray) -> pa.RecordBatch:
            bits = rows["fp"].view(np.uint64)
            cross = rows["low"] != rows["high"]
            top = link_groups(
                np.cumsum(new), rows["ring"], cross, rows["own"], rows["exact"], bits, max_distance
            )
            out = top != np.arange(len(top))
            return pa.RecordBatch.from_arrays(
                [pa.array(rows["fp"][out]), pa.array(rows["fp"][top[out]])], names=["a", "b"]
            )

        def first_of_group(rows):
            new = np.ones(len(rows["fp"]), bool)
            new[1:] = np.any([rows[c][1:] != rows[c][:-1] for c in place], axis=0)
            return new

        held: dict[str, np.ndarray] | None = None
        for batch in batches:
            rows = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in names}
            if held is not None:
                rows = {c: np.concatenate([held[c], rows[c]]) for c in names}
            new = first_of_group(rows)
            cut = int(np.flatnonzero(new)[-1])  # the last group may go on in the next batch
            if cut:
                yield forest({c: v[:cut] for c, v in rows.items()}, new[:cut])
            held = {c: v[cut:].copy() for c, v in rows.items()}
        if held is not None:
            yield forest(held, first_of_group(held))

    dealt = tiles.repartition(*place).sortWithinPartitions(*place)
    return dealt.mapInArrow(run, "a bigint, b bigint").distinct()


def component_roots(edges: DataFrame) -> DataFrame:
    """(node, root) for the nodes of ``edges`` (a, b), by contraction.

    Each round maps every node to the smallest of itself and its neighbours (then once more, to
    that node's own choice) and keeps the edges between different images. Rounds are staged, so
    lineage stays short; the driver only asks whether edges are left.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a")))
    level = stage(both, "links")
    roots = None
    while not level.isEmpty():
        nearest = stage(
            level.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("up")), "nearest"
        )
        again = nearest.select(F.col("a").alias("up"), F.col("up").alias("upper"))
        image = stage(nearest.join(again, "up").select("a", F.col("upper").alias("up")), "image")
        if roots is None:
            roots = image.select(F.col("a").alias("node"), F.col("up").alias("root"))
        else:
            step = image.select(F.col("a").alias("root"), "up")
            roots = roots.join(step, "root", "left").select(
                "node", F.coalesce("up", "root").alias("root")
            )
        left = image.select("a", F.col("up").alias("x"))
        right = image.select(F.col("a").alias("b"), F.col("up").alias("y"))
        level = stage(
            level.join(left, "a")
            .join(right, "b")
            .filter("x <> y")
            .select(F.col("x").alias("a"), F.col("y").alias("b"))
            .distinct(),
            "links",
        )
    if roots is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots


def _rooted(own: DataFrame, max_distance: int) -> DataFrame:
    """(fp, first, root) of the distinct fingerprints of ``own`` (doc_id, fp; staged)."""
    fps = stage(own.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct-fingerprints")
    if max_distance == 0:
        return fps.withColumn("root", F.col("fp"))
    roots = component_roots(links(fps.select("fp"), max_distance))
    rooted = fps.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    return stage(rooted, "rooted")


def simhash_components(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE_WORDS,
    max_distance: int = MAX_DISTANCE,
) -> DataFrame:
    """One row per input row: ``doc_id``, ``fp`` (bigint) and ``component_id``.

    ``component_id`` is the smallest doc_id reachable over links of at most ``max_distance``
    differing bits. Copies meet in one row per fingerprint before anything is compared. Null and
    blank texts have fingerprint zero and are linked like any other; a null doc_id gets the
    component of its text but does not name one; repeated rows give repeated results; an empty
    table gives an empty one; other columns are not read.
    """
    own = stage(fingerprints(docs, doc_id, text, shingle), "fingerprints")
    rooted = _rooted(own, max_distance)
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = stage(rooted.join(smallest, "root").select("fp", "component_id"), "named")
    return own.join(named, "fp").select("doc_id", "fp", "component_id")


def simhash_digest(components: DataFrame) -> DataFrame:
    hexed = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return components.select("doc_id", hexed.alias("fingerprint"), "component_id")


def keep_one_each(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE_WORDS,
    max_distance: int = MAX_DISTANCE,
) -> DataFrame:
    """``docs`` with one row of each component, that with the smallest doc_id.

    Rows are told apart by doc_id and fingerprint: unrelated texts that share a doc_id stay, and so
    does one row of a component without any doc_id. Of several rows with the same doc_id and
    fingerprint the smallest stays.
    """
    own = stage(fingerprints(docs, doc_id, text, shingle), "fingerprints")
    rows = own.join(_rooted(own, max_distance).select("fp", "root"), "fp")
    # the smallest id, the one fingerprint of it; missing ids come last
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "fp"))
    chosen = stage(rows.groupBy("root").agg(first.alias("c")).select("c.doc_id", "c.fp"), "chosen")
    times = own.groupBy("doc_id").agg(F.count(F.lit(1)).alias("times"))
    counted = stage(chosen.filter("doc_id IS NOT NULL").join(times, "doc_id"), "counted")
    once = counted.filter("times = 1").select(F.col("doc_id").alias(doc_id))
    out = docs.join(once, doc_id, "left_semi")
    # ids of several rows, or none: by fingerprint, too
    several = counted.filter("times > 1").select("doc_id", "fp")
    several = stage(several.unionByName(chosen.filter("doc_id IS NULL")), "several")
    if not several.isEmpty():
        ids = several.select(F.col("doc_id").alias("own_id")).distinct()
        unclear = docs.join(ids, F.col(doc_id).eqNullSafe(F.col("own_id")), "left_semi")
        row, fp = unused(docs, "row", "fp")
        packed = unclear.select(F.struct(*docs.columns).alias(row), F.col(doc_id).alias(doc_id), F.col(text).alias(text))
        printed = map_rows(
            packed, [row, doc_id], [text], f"{fp} bigint", lambda: lambda t: (fingerprint(t, shingle),)
        )
        same = printed[doc_id].eqNullSafe(several["doc_id"]) & (printed[fp] == several["fp"])
        found = printed.join(several, same, "left_semi").groupBy(doc_id, fp)
        out = out.unionByName(found.agg(F.min(row).alias(row)).select(f"{row}.*"))
    return out.select(*docs.columns)

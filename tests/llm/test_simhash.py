"""SimHash: fingerprints by the definition, components against all pairs."""

import random

import xxhash

from tagweave.llm.simhash import (
    component_roots,
    fingerprint,
    keep_one_each,
    links,
    simhash_components,
    simhash_digest,
)


def slow_fingerprint(text, k=3):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for blank in "\t\n\x0b\x0c\r":
        lowered = lowered.replace(blank, " ")
    words = [w for w in lowered.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(nodes, distance=3):
    """{fingerprint: smallest of its component} by comparing all pairs."""
    top = {n: n for n in nodes}

    def root(n):
        while top[n] != n:
            n = top[n]
        return n

    for a in nodes:
        for b in nodes:
            if (a ^ b).bit_count() <= distance:
                x, y = sorted((root(a), root(b)))
                top[y] = x
    return {n: root(n) for n in nodes}


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_fingerprint_by_definition():
    texts = [None, "", " \n", "one", "One TWO", "a b c", "é è\x0bx  y Z q", "a b c d a b c d " * 9]
    for text in texts:
        assert fingerprint(text) == signed(slow_fingerprint(text)), text


def clouds(seed):
    """Random fingerprints, and dense clouds and chains around some."""
    rng = random.Random(seed)
    nodes = [rng.getrandbits(64) for _ in range(60)]
    for center in nodes[:6]:
        for _ in range(25):
            x = center
            for _ in range(rng.randint(1, 5)):
                x ^= 1 << rng.randrange(64)
            nodes.append(x)
    x = nodes[-1]
    for _ in range(40):
        for _ in range(3):
            x ^= 1 << rng.randrange(64)
        nodes.append(x)
    return sorted({*nodes, 0})


def test_links_connect_what_all_pairs_connect(spark):
    for seed, distance, block in [(1, 3, 4096), (2, 3, 16), (3, 1, 4096), (4, 5, 4096)]:
        nodes = clouds(seed)
        fps = spark.createDataFrame([(signed(n),) for n in nodes], "fp bigint")
        found = links(fps, distance, block).collect()
        assert len(found) < 12 * len(nodes)
        top = {n: n for n in nodes}

        def root(n, top=top):
            while top[n] != n:
                n = top[n]
            return n

        for row in found:
            a, b = row.a % (1 << 64), row.b % (1 << 64)
            x, y = sorted((root(a), root(b)))
            top[y] = x
        assert {n: root(n) for n in nodes} == slow_components(nodes, distance)


def test_component_roots_of_paths_and_stars(spark):
    path = [(i, i + 1) for i in range(40)]
    star = [(100, 101 + i) for i in range(50)]
    edges = spark.createDataFrame([*path, *star], "a bigint, b bigint")
    roots = {r.node: r.root for r in component_roots(edges).collect()}
    assert len(roots) == 41 + 51
    assert {roots[i] for i in range(41)} == {roots[0]}
    assert {roots[i] for i in range(100, 151)} == {roots[100]} != {roots[0]}
    none = spark.createDataFrame([], "a bigint, b bigint")
    assert component_roots(none).collect() == []


DOCS = [
    (5, "the quick brown fox jumps over the lazy dog"),
    (3, "The quick brown fox jumps over the lazy dog"),
    (9, None),
    (8, ""),
    (7, "entirely different words in this one"),
    (7, "entirely different words in this one"),
    (None, "The quick brown fox jumps over the lazy dog"),
    (2, "x " * 30000),
]


def test_components_of_copies_nulls_and_repeats(spark):
    docs = spark.createDataFrame([(i, t, "z") for i, t in DOCS], "doc_id bigint, text string, fp string")
    rows = simhash_digest(simhash_components(docs)).collect()
    assert len(rows) == len(DOCS)
    got = sorted((r.doc_id or -1, r.component_id) for r in rows)
    assert got == [(-1, 3), (2, 2), (3, 3), (5, 3), (7, 7), (7, 7), (8, 8), (9, 8)]
    zero = {r.fingerprint for r in rows if r.doc_id in (8, 9)}
    assert zero == {"0" * 16}
    kept = keep_one_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or -1 for r in kept.collect()) == [2, 3, 7, 8]


def test_one_row_of_each_component_whatever_its_id(spark):
    """Two unrelated texts of one id stay both, of rows without an id one per component."""
    other = "nothing in common with that at all here"
    rows = [(1, DOCS[0][1]), (1, other), (None, "a third text of its own"), (None, "a third text of its own"),
            (4, DOCS[0][1]), (5, other), (None, other)]
    docs = spark.createDataFrame([(i, t, 0, "z") for i, t in rows], "doc_id bigint, text string, fp int, row string")
    kept = keep_one_each(docs)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id or -1), r.text) for r in kept.collect()) == sorted(
        [(1, DOCS[0][1]), (1, other), (-1, "a third text of its own")]
    )


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert simhash_components(docs).count() == 0
    assert keep_one_each(docs).count() == 0


def test_whole_table_against_all_pairs(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    prints = {r.doc_id: slow_fingerprint(r.text) for r in docs.collect()}
    classes = slow_components(sorted(set(prints.values())))
    smallest = {}
    for doc, fp in prints.items():
        smallest[classes[fp]] = min(doc, smallest.get(classes[fp], doc))
    rows = simhash_digest(simhash_components(docs)).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in rows} == {
        doc: (f"{fp:016x}", smallest[classes[fp]]) for doc, fp in prints.items()
    }


def test_exploded_entries_are_never_broadcast(spark, tmp_path):
    """Spark takes the entries, some 36 for each fingerprint, for as few rows as fingerprints."""
    path = str(tmp_path / "fps")
    spark.createDataFrame([(signed(n),) for n in clouds(5)], "fp bigint").write.parquet(path)
    found = links(spark.read.parquet(path), 3)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert found.count() > 0


def test_dropping_near_copies_broadcasts_no_entries(spark):
    from helpers import plan_of_writes

    docs = spark.createDataFrame([(i, f"text number {i} of its own") for i in range(50)], "doc_id bigint, text string")
    with plan_of_writes(spark) as plans:
        assert keep_one_each(docs).count() > 0
    linked = [p for p in plans if "/staged/links-" in p and "MapInArrow" in p]
    assert linked and all("SortMergeJoin" in p and "Broadcast" not in p for p in linked)

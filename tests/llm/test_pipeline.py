"""The pipeline: each stage against brute force on what the stage before it kept."""

from collections import Counter

import corpus_pipeline
from tagweave.llm.common import table
from tagweave.llm.cotrain import quality_scores
from tagweave.llm.decontaminate import WORD, words_of
from tagweave.llm.simhash import fingerprint
from tagweave.session import stage

FOLDER = "/root/testdata/sf0.01"


def without_stretches(text, windows, sizes):
    """``text`` without its stretches of 13 hit words and more."""
    words, places = words_of(text), [m.span() for m in WORD.finditer(text)]
    hit = sorted(
        {
            i + k
            for size in sizes
            for i in range(len(words) - size + 1)
            if tuple(words[i : i + size]) in windows
            for k in range(size)
        }
    )
    stretches = []
    for i in hit:
        if stretches and stretches[-1][1] == i:
            stretches[-1][1] = i + 1
        else:
            stretches.append([i, i + 1])
    for a, b in reversed(stretches):
        if b - a >= 13:
            text = text[: places[a][0]] + text[places[b - 1][1] :]
    return text


def test_stages(spark):
    kept, docs = {}, table(spark, FOLDER, "documents")
    kept["start"], columns = docs.collect(), docs.columns
    for name, step in corpus_pipeline.STAGES:
        docs = stage(step(spark, docs, FOLDER), f"test-{name}")
        if name != "mixing":
            assert docs.columns == columns
        kept[name] = docs.collect()
        assert 0 < len(kept[name])

    scores = quality_scores(table(spark, FOLDER, "documents"), table(spark, FOLDER, "labels"))
    accepted = {r.doc_id for r in scores.filter("accepted").collect()}
    assert {r.doc_id for r in kept["quality"]} == accepted

    lines = sorted(
        (r.doc_id, i, frozenset(line.strip(" \t\x0b\x0c\r").lower().split(" ")) - {""}, line)
        for r in kept["quality"]
        for i, line in enumerate(r.text.split("\n"))
    )
    holders, texts = {}, {}
    for doc, i, words, line in lines:
        near = Counter(e for w in words for e in holders.get(w, ()))
        if not any(5 * n >= 4 * (len(words) + len(e[2]) - n) for e, n in near.items()):
            texts.setdefault(doc, []).append(line)
        for w in words:
            holders.setdefault(w, []).append((doc, i, words))
    want = {doc: "\n".join(rest) for doc, rest in texts.items() if "".join(rest).strip()}
    assert {r.doc_id: r.text for r in kept["line_dedup"]} == want
    assert all(r.n_chars == len(r.text) for r in kept["line_dedup"])

    prints = {r.doc_id: fingerprint(r.text) for r in kept["line_dedup"]}
    unique = {r.doc_id for r in kept["near_dedup"]}
    smallest = {}
    for doc in sorted(prints):
        near = [d for d in smallest if ((prints[d] ^ prints[doc]) % (1 << 64)).bit_count() <= 3]
        smallest[doc] = min([smallest[d] for d in near], default=doc)
    assert unique == {d for d, s in smallest.items() if d == s}

    items = [words_of(r.text) for r in table(spark, FOLDER, "benchmark").collect()]
    windows = {tuple(w[i : i + 13]) for w in items if len(w) >= 13 for i in range(len(w) - 12)}
    windows |= {tuple(w) for w in items if 0 < len(w) < 13}
    sizes = {len(w) for w in windows}
    clean = set()
    for r in kept["near_dedup"]:
        words = words_of(r.text)
        hit = {
            i + k
            for size in sizes
            for i in range(len(words) - size + 1)
            if tuple(words[i : i + size]) in windows
            for k in range(size)
        }
        if not hit or 20 * len(hit) < len(words):
            clean.add(r.doc_id)
    assert {r.doc_id for r in kept["decontamination"]} == clean
    cut = {r.doc_id: (r.text, r.n_chars) for r in kept["decontamination"]}
    for r in kept["near_dedup"]:
        if r.doc_id in clean:
            want = without_stretches(r.text, windows, sizes)
            assert cut[r.doc_id] == (want, len(want) if want != r.text else r.n_chars)

    assert {r.doc_id for r in kept["mixing"]} <= clean
    run = corpus_pipeline.run(spark, FOLDER)
    assert sorted(map(tuple, run.collect())) == sorted(map(tuple, kept["mixing"]))

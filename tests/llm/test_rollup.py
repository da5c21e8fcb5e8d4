"""Token rollups: counts against the tokenizer itself, batches against sums over documents."""

import base64
from collections import Counter

import pytest
import tiktoken

from tagweave.llm.queries import RANK_FILE, op2_token_rollup
from tagweave.llm.rollup import SPLIT, Rollup, bpe_counter, token_counts, word_counter
from tagweave.session import shared_folder


@pytest.fixture(scope="module")
def coder():
    with open(RANK_FILE, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})


TEXTS = [None, "", " ", "it's  two\n\n  spaces \t x", "Réré 123,45 😀\r\n'll '", "a" * 3000, "!?" * 50 + " end "]


def test_pieces_add_up_to_the_text(coder):
    count = bpe_counter(RANK_FILE)()
    for text in TEXTS:
        assert count(text) == len(coder.encode_ordinary(text or ""))


def test_counts_of_a_table(spark, coder, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    counted = token_counts(docs, {"w": word_counter, "b": bpe_counter(RANK_FILE)}, ["doc_id"])
    texts = {r.doc_id: r.text for r in docs.collect()}
    for row in counted.collect():
        assert [(x.tokenizer, x.n) for x in row.n_tokens] == [
            ("w", len(texts[row.doc_id].split())), ("b", len(coder.encode_ordinary(texts[row.doc_id]))),
        ]


SCHEMA = "source string, lang string, tokenizer string, sign int, n_tokens bigint"


def test_batches_apply_once_in_any_order(spark, tmp_path):
    batches = {
        "b": [("s", "en", "v1", 1, 10), ("s", None, "v1", 1, 5), ("s", "en", "v1", 1, 10)],
        "a": [("s", "en", "v1", -1, 10), ("s", "en", "v2", 1, 7), (None, "en", "v1", 1, None)],
        "c": [("s", None, "v1", -1, 5), ("s", "en", "v2", None, 9)],
    }
    rollup = Rollup(spark, f"{shared_folder(spark)}/{tmp_path.name}")
    assert rollup.totals().count() == 0
    for name, rows in batches.items():
        assert rollup.commit(name, spark.createDataFrame(rows, SCHEMA))
    first = sorted(map(tuple, rollup.totals().collect()), key=str)
    assert first == sorted([("s", "en", "v1", 1, 10), ("s", "en", "v2", 1, 7), (None, "en", "v1", 1, 0)], key=str)
    for name, rows in batches.items():
        assert not rollup.commit(name, spark.createDataFrame(rows, SCHEMA))
    assert sorted(map(tuple, rollup.totals().collect()), key=str) == first
    assert rollup.batches() == ["a", "b", "c"]


def test_cut_off_batch_is_written_again(spark, tmp_path):
    rollup = Rollup(spark, str(tmp_path / "r"))
    rows = spark.createDataFrame([("s", "en", "v1", 1, 3)], SCHEMA)
    rollup.commit("x", rows)
    (tmp_path / "r" / "batch-x" / "_SUCCESS").unlink()
    assert rollup.batches() == [] and rollup.totals().count() == 0
    assert rollup.commit("x", rows)
    assert rollup.totals().first().n_tokens == 3


def test_life_of_the_corpus(spark, coder, sf_dir):
    import re

    want = Counter()
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        text = r.text or ""
        if len(text.split()) < 50:
            continue
        text = re.sub(r"[^\s@]+@[^\s@]+", "<email>", text)
        want[r.source, r.lang, "words-1", "docs"] += 1
        want[r.source, r.lang, "words-1", "tokens"] += len(text.split())
        want[r.source, r.lang, "bpe50k-1", "docs"] += 1
        want[r.source, r.lang, "bpe50k-1", "tokens"] += len(coder.encode_ordinary(text))
    got = Counter()
    for r in op2_token_rollup(spark, sf_dir).collect():
        got[r.source, r.lang, r.tokenizer, "docs"] = r.n_docs
        got[r.source, r.lang, r.tokenizer, "tokens"] = r.n_tokens
    assert got == want


def test_document_that_a_redaction_makes_short(spark, tmp_path):
    """50 words of which two are one address to the redaction: it is counted anew, not lost."""
    text = " ".join(["word"] * 48) + " me@example.com\u3000again"
    docs = [(1, text, "en", "s"), (2, "too@short.com", "en", "s")]
    schema = "doc_id bigint, text string, lang string, source string"
    spark.createDataFrame(docs, schema).write.parquet(str(tmp_path / "documents.parquet"))
    rows = {r.tokenizer: r for r in op2_token_rollup(spark, str(tmp_path)).collect()}
    assert len(text.split()) == 50
    assert rows["words-1"].n_docs == rows["bpe50k-1"].n_docs == 1
    assert rows["words-1"].n_tokens == 49

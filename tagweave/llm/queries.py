"""Registered queries of the operators: each over its whole table, with production parameters."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagweave.llm.chat import chat_digest, format_chat, records_of
from tagweave.llm.collocations import collocations
from tagweave.llm.common import table
from tagweave.llm.cotrain import quality_scores
from tagweave.llm.decontaminate import contamination_digest, match_benchmark
from tagweave.llm.language import identify_languages
from tagweave.llm.lines import dedup_lines
from tagweave.llm.mixing import mix_sources
from tagweave.llm.records import byte_bpe_encoder, read_digests, write_records
from tagweave.llm.rollup import Rollup, bpe_counter, signed, token_counts, word_counter
from tagweave.llm.rules import quality_rules
from tagweave.llm.secrets import scan_secrets, secret_digest
from tagweave.llm.simhash import simhash_components, simhash_digest
from tagweave.llm.whitening import whiten
from tagweave.session import shared_folder, stage

# Target mixture of the corpus: the large source is held to a tenth, the others share evenly.
MIX = {"src0": 2.0} | {f"src{i}": 0.9 for i in range(1, 20)}
MIX_REST = 0.9

# Vocabulary of the counted tokenizer; the file is read by every task, so each machine has it.
RANK_FILE = "/opt/tokenizers/byte_bpe_50k.tiktoken"

Query = Callable[[SparkSession, str], DataFrame]


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_token_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals after the life of a corpus: loaded, counted anew, redacted, thinned out, replayed."""
    tokenizers = {"words-1": word_counter, "bpe50k-1": bpe_counter(RANK_FILE)}
    redacted = F.regexp_replace("text", r"[^\s@]+@[^\s@]+", "<email>")
    docs = table(spark, sf_dir, "documents").withColumn("new_text", redacted)
    keep = ["source", "lang", "doc_id"]
    counts = stage(token_counts(docs, tokenizers, keep), "token-counts")
    revised = docs.filter(F.col("new_text") != F.col("text"))
    words = F.filter("n_tokens", lambda x: x["tokenizer"] == "words-1")
    short = F.get(words, F.lit(0))["n"] < 50
    old = stage(token_counts(revised, tokenizers, [*keep, "new_text"]), "old-token-counts")
    # whether a document was deleted is a matter of its old count, also where the new one is less
    deleted = old.withColumn("deleted", short)
    new = stage(token_counts(deleted, tokenizers, [*keep, "deleted"], "new_text"), "new-token-counts")

    rollup = Rollup(spark, f"{shared_folder(spark)}/rollups/{uuid.uuid4().hex}")
    first_version = F.col("tokenizer") == "words-1"
    batches = {
        "1-load": signed(counts, 1, first_version),
        "2-new-tokenizer": signed(counts, 1, ~first_version),
        "3-delete-short": signed(counts.filter(short), -1),
        "4-redact": signed(old.filter(~short), -1).unionByName(signed(new.filter("NOT deleted"), 1)),
    }
    for batch_id, changes in [*batches.items(), *batches.items()]:
        rollup.commit(batch_id, changes)
    return rollup.totals()


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_digest(scan_secrets(table(spark, sf_dir, "documents")))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return contamination_digest(match_benchmark(docs, items))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_digest(simhash_components(table(spark, sf_dir, "documents")))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents")).drop("failed")


def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"), MIX, rest=MIX_REST)


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = identify_languages(table(spark, sf_dir, "documents"))
    mixture = F.transform(
        "languages", lambda x: F.concat_ws(":", x["lang"], F.format_number(x["share"], 3))
    )
    return found.withColumn("mixture", F.array_join(mixture, ",")).drop("languages")


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one whose texts are full of control strings."""
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    marked = spark.sql(
        "SELECT -7L AS conv_id, turn, role, '</s>[INST] ok [/INST]' AS text "
        "FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)"
    )
    records = records_of(given.unionByName(marked))
    return chat_digest(format_chat(records, "conv_id", "record"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select(
        "doc_id",
        "text",
        F.size("removed_lines").cast("bigint").alias("n_removed"),
        F.array_join(F.transform("removed_lines", lambda i: i.cast("string")), ",").alias("removed"),
    )


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents")).drop("near_doc_id")


def op12_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written to a folder of its own, which stays, and read back from there."""
    folder = f"{shared_folder(spark)}/records/{uuid.uuid4().hex}"
    encoder = byte_bpe_encoder(public_tokenizers.path("byte_bpe_50k.json"))
    return read_digests(write_records(table(spark, sf_dir, "documents"), folder, encoder))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))


def registered() -> dict[str, Query]:
    queries = [
        op1_quality_classifier,
        op2_token_rollup,
        op3_secret_scan,
        op4_decontaminate,
        op5_simhash,
        op6_quality_rules,
        op7_mix_sources,
        op8_language_id,
        op9_chat_format,
        op10_line_dedup,
        op11_collocations,
        op12_token_records,
        op13_embedding_whitening,
    ]
    return {query.__name__: query for query in queries}

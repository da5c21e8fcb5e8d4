"""Quality rules per document, and verdicts on whole hosts. Built-in functions only.

A host (domain, source) with few documents says little by its raw failure rate. Rates are shrunk
towards a beta prior fitted to all hosts, and the verdict on the host goes back to its documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagweave.functions.lists import let
from tagweave.llm.common import blank_words
from tagweave.session import stage

# Fixed values of the contract.
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = "[#*$%&|<>]"

# Limits of the method's own rules and of the verdicts on hosts.
MAX_SYMBOL_PERCENT = 20  # symbols per 100 words
MAX_DUP_LINE_PERCENT = 30
REJECT_RATE = 0.5  # a host fails as a whole
SUSPECT_RATE = 0.25  # a host's documents that break this rule go
MIN_STRENGTH, MAX_STRENGTH = 2.0, 10000.0
RULES = ("short", "repeats", "symbols", "dup_lines")
# A host's few verdict rows are copied so often, and its documents dealt over the copies.
SALTS = 32


def _span(last: Column) -> Column:
    """0..last; empty if ``last`` is negative."""
    return F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))


def repeated_window_words(words: Column, width: int = 3) -> Column:
    """Words that lie in a ``width``-word window found twice or more in the text.

    Windows are compared by 64-bit hashes, sorted inside the row: n log n for n words.
    """

    def hashed(w: Column) -> Column:
        return F.sort_array(
            F.transform(
                _span(F.size(w) - width),
                lambda i: F.struct(
                    F.xxhash64(*[F.get(w, i + k) for k in range(width)]).alias("h"), i.alias("i")
                ),
            )
        )

    def starts(s: Column) -> Column:
        same = lambda k, other: F.coalesce(
            F.get(s, k)["h"] == F.get(s, other)["h"], F.lit(False)
        )
        twice = F.filter(s, lambda x, k: same(k, k - 1) | same(k, k + 1))
        return F.sort_array(F.transform(twice, lambda x: x["i"]))

    def covered(p: Column) -> Column:
        steps = F.transform(
            p, lambda at, j: F.least(F.coalesce(F.get(p, j + 1) - at, F.lit(width)), F.lit(width))
        )
        return F.aggregate(steps, F.lit(0).cast("bigint"), lambda total, x: total + x)

    return let(words, lambda w: let(let(hashed(w), starts), covered))


def document_measures(docs: DataFrame, doc_id: str, text: str, host: Column) -> DataFrame:
    """Counts per document, in one pass without a shuffle. Null texts have no words or lines."""
    value = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(value, "\n"), lambda x: F.btrim(x, F.lit(" \t\x0b\x0c\r")) != "")
    size = lambda x: F.size(x).cast("bigint")
    measured = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.coalesce(host, F.lit("")).alias("host"),
        let(
            blank_words(F.col(text)),
            lambda w: F.struct(
                size(w).alias("n_words"),
                F.char_length(F.array_join(w, "")).cast("bigint").alias("word_chars"),
                repeated_window_words(w).alias("n_repeat_words"),
            ),
        ).alias("w"),
        (F.char_length(value) - F.char_length(F.regexp_replace(value, SYMBOLS + "+", "")))
        .cast("bigint")
        .alias("n_symbols"),
        let(
            lines,
            lambda x: F.struct(
                size(x).alias("n_lines"), (size(x) - size(F.array_distinct(x))).alias("n_dup_lines")
            ),
        ).alias("x"),
    )
    return measured.select("doc_id", "host", "w.*", "n_symbols", "x.*")


def _failures() -> dict[str, Column]:
    words, lines = F.col("n_words"), F.col("n_lines")
    return {
        "short": words < MIN_WORDS,
        "repeats": 100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * words,
        "symbols": 100 * F.col("n_symbols") > MAX_SYMBOL_PERCENT * words,
        "dup_lines": 100 * F.col("n_dup_lines") > MAX_DUP_LINE_PERCENT * lines,
    }


def host_rates(measures: DataFrame) -> DataFrame:
    """Per host and rule: documents ``n``, ``fails`` and the shrunk ``rate``.

    The prior of a rule is the beta distribution with the mean and variance of its hosts' raw
    rates; its strength is kept between 2 and 10,000 documents. Counts are partially aggregated,
    so a host with a third of all rows costs each task one row.
    """
    failures = _failures()
    per_host = measures.groupBy("host").agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(failed.cast("bigint")).alias(rule) for rule, failed in failures.items()],
    )
    rates = per_host.select(
        "host",
        "n",
        F.explode(
            F.array(*[F.struct(F.lit(r).alias("rule"), F.col(r).alias("fails")) for r in RULES])
        ).alias("x"),
    ).select("host", "n", "x.*")
    raw = F.col("fails") / F.col("n")
    prior = rates.groupBy("rule").agg(F.avg(raw).alias("mean"), F.var_pop(raw).alias("spread"))
    bound = F.col("mean") * (1 - F.col("mean"))
    strength = F.when(F.col("spread") > 0, bound / F.col("spread") - 1).otherwise(MAX_STRENGTH)
    strength = F.least(F.greatest(strength, F.lit(MIN_STRENGTH)), F.lit(MAX_STRENGTH))
    prior = prior.select("rule", "mean", strength.alias("strength"))
    shrunk = (F.col("fails") + F.col("mean") * F.col("strength")) / (F.col("n") + F.col("strength"))
    return rates.join(prior, "rule").select("host", "rule", "n", "fails", shrunk.alias("rate"))


def quality_rules(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: Column | None = None
) -> DataFrame:
    """One row per input row: ``doc_id``, the measures, ``base_failed``, ``failed`` rules, ``kept``.

    ``host`` is a column expression, ``source`` by default. A document is dropped if it fails a
    base rule (fewer than 50 words, over half of them in repeated 3-word windows), if its host is
    rejected (shrunk failure rate of a rule above one half), or if it breaks a rule by which its
    host is suspect (rate above one quarter).

    Texts are read once; the narrow measures are staged, aggregated per host, and joined with
    those hosts that have a verdict against them, salted so that a large host is spread. Null
    texts have no words, null hosts form one host, repeated rows give repeated results, an empty
    table gives an empty one, other columns are not read.
    """
    host = F.col("source") if host is None else host
    measures = stage(document_measures(docs, doc_id, text, host), "rule-measures")
    suspects = host_rates(measures).filter(F.col("rate") > SUSPECT_RATE)
    verdicts = suspects.groupBy("host").agg(
        F.sort_array(F.collect_list("rule")).alias("suspect_rules"),
        F.max(F.col("rate") > REJECT_RATE).alias("host_rejected"),
    )
    salted = verdicts.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    failed = F.array_compact(
        F.array(*[F.when(broken, F.lit(rule)) for rule, broken in _failures().items()])
    )
    dealt = measures.withColumns(
        {"failed": failed, "_salt": F.pmod(F.xxhash64("doc_id", "n_words"), F.lit(SALTS)).cast("int")}
    )
    base_failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )
    by_host = F.coalesce(
        F.col("host_rejected") | F.arrays_overlap("failed", "suspect_rules"), F.lit(False)
    )
    return dealt.join(salted, ["host", "_salt"], "left").select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base_failed.alias("base_failed"),
        "failed",
        (~base_failed & ~by_host).alias("kept"),
    )

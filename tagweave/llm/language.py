"""Language identification by mixture inference.

Languages are distributions over hashed byte trigrams. A document is a mixture of them: its
proportions are estimated by expectation-maximisation over its trigrams, and the set of languages
is the one with the best penalised likelihood, so a second language has to earn its place.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagweave.llm.common import map_rows

BUCKETS = 1 << 16
SMOOTHING = 0.1
# Documents per language that the distributions are learned from, at most (by hash of the id).
TRAIN_DOCS = 4000
# Largest model that is sent to the tasks: this many languages of 256 KB each.
MAX_LANGUAGES = 400
# Penalty per language in units of log(trigrams) / 2; overlapping trigrams are not independent.
PENALTY = 3.0
ROUNDS, TOLERANCE = 40, 1e-3
UNDETERMINED = "und"

_LETTERS = bytes(c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def has_letter(text: str | None) -> bool:
    return any(map(str.isalpha, text or ""))


def trigrams(text: str) -> np.ndarray:
    """Buckets of the byte trigrams of lower-cased words, blanks at both ends included."""
    flat = b" " + text.lower().encode().translate(_LETTERS) + b" "
    b = np.frombuffer(flat, np.uint8).astype(np.uint32)
    code = b[:-2] | b[1:-1] << 8 | b[2:] << 16
    code = code[b[1:-1] != 32]
    return (code * np.uint32(0x9E3779B1)) >> np.uint32(16)


def fit(trigram_counts: np.ndarray, log_probability: np.ndarray) -> tuple[np.ndarray, float]:
    """Proportions and log likelihood of a mixture, by expectation-maximisation.

    ``log_probability`` has a row per distinct trigram and a column per language.
    """
    top = log_probability.max(axis=1)
    likely = np.exp(log_probability - top[:, None])
    shares = np.full(likely.shape[1], 1.0 / likely.shape[1])
    n = trigram_counts.sum()
    for _ in range(ROUNDS):
        weighted = likely @ shares
        new = shares * ((trigram_counts / weighted) @ likely) / n
        moved = np.abs(new - shares).max()
        shares = new
        if moved < TOLERANCE:
            break
    return shares, float(trigram_counts @ (np.log(likely @ shares) + top))


def mixture(trigram_counts: np.ndarray, log_probability: np.ndarray) -> dict[int, float]:
    """Languages (columns) of the best penalised likelihood, with their proportions.

    Sets grow by falling proportion in the mixture of all. No set beats the likelihood of all
    languages, so growing ends as soon as that could not pay for one more.
    """
    n_languages = log_probability.shape[1]
    cost = PENALTY * 0.5 * np.log(trigram_counts.sum() + 1.0)
    single = trigram_counts @ log_probability
    first = int(np.argmax(single))
    best, best_value = {first: 1.0}, float(single[first])
    if n_languages == 1:
        return best
    shares, most = fit(trigram_counts, log_probability)
    order = np.argsort(-shares, kind="stable")
    for size in range(2, n_languages + 1):
        if most - (size - 1) * cost <= best_value:
            break
        chosen = order[:size]
        part, value = fit(trigram_counts, log_probability[:, chosen])
        value -= (size - 1) * cost
        if value > best_value:
            best, best_value = dict(zip(chosen.tolist(), part.tolist(), strict=True)), value
    return best


def held_out(doc_id: str) -> Column:
    """Documents the contract keeps for testing."""
    key = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.crc32(key.cast("binary")) % 3 == 1


def language_model(
    docs: DataFrame, doc_id: str, text: str, lang: str, train_docs: int = TRAIN_DOCS
) -> tuple[list[str], np.ndarray]:
    """Learned languages and their log probabilities (trigram buckets x languages).

    Only documents outside the held-out third with a language are read: of each language those
    whose id hashes below a threshold that leaves about ``train_docs`` of them.
    """
    usable = docs.filter(~held_out(doc_id) & F.col(lang).isNotNull() & F.col(text).isNotNull())
    sizes = {r[lang]: r["count"] for r in usable.groupBy(lang).count().collect()}
    names = sorted(sizes)
    if len(names) > MAX_LANGUAGES:
        raise ValueError(f"{len(names)} languages; the model is sent to all tasks, so at most {MAX_LANGUAGES}")
    if not names:
        return [], np.zeros((BUCKETS, 0), np.float32)
    place = F.pmod(F.xxhash64(doc_id, F.lit("language")), F.lit(1 << 32)) / F.lit(float(1 << 32))
    wanted = F.when(F.lit(False), 0.0)
    for name, size in sizes.items():
        wanted = wanted.when(F.col(lang) == name, train_docs / size)
    sample = usable.filter(place < wanted).select(F.col(lang).alias("lang"), F.col(text).alias("text"))

    def start():
        def one(value):
            buckets, counts = np.unique(trigrams(value), return_counts=True)
            return buckets.astype(np.int32), counts.astype(np.int32)

        return one

    grams = map_rows(sample, ["lang"], ["text"], "bucket array<int>, n array<int>", start)
    counts = grams.select("lang", F.explode(F.arrays_zip("bucket", "n")).alias("g")).groupBy(
        "lang", F.col("g.bucket").alias("bucket")
    ).agg(F.sum("g.n").alias("n"))
    found = counts.toPandas()  # at most languages x buckets rows
    matrix = np.full((BUCKETS, len(names)), SMOOTHING)
    at = {name: i for i, name in enumerate(names)}
    matrix[found["bucket"].to_numpy(int), found["lang"].map(at).to_numpy(int)] += found["n"].to_numpy(float)
    return names, np.log(matrix / matrix.sum(axis=0)).astype(np.float32)


def identify_languages(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    train_docs: int = TRAIN_DOCS,
) -> DataFrame:
    """One row per input row: ``doc_id``, ``held_out``, ``lang_pred``, ``score``, ``languages``.

    ``languages`` are the languages of the selected set with their proportions, the largest first;
    ``lang_pred`` is that one and ``score`` its proportion. Predictions read the whole text and
    nothing else. The model has a fixed size per language and is learned from a bounded number of
    documents; applying it shuffles nothing.

    Texts that are null or have no letter get ``und`` with score 0, and so does every text if
    there is nothing to learn from. Equal proportions go to the first language by name. A null
    doc_id counts as not held out, repeated rows give repeated results, an empty table gives an
    empty one, other columns are not read.
    """
    names, log_probability = language_model(docs, doc_id, text, lang, train_docs)
    sent = docs.sparkSession.sparkContext.broadcast(log_probability)

    def start():
        model = sent.value

        def one(value):
            if not names or not has_letter(value):
                return UNDETERMINED, 0.0, []
            buckets, counts = np.unique(trigrams(value), return_counts=True)
            if not len(buckets):
                return UNDETERMINED, 0.0, []
            found = mixture(counts.astype(float), model[buckets].astype(float))
            shares = sorted(((share, names[i]) for i, share in found.items()), key=lambda s: (-s[0], s[1]))
            listed = [{"lang": name, "share": share} for share, name in shares]
            return shares[0][1], min(1.0, shares[0][0]), listed

        return one

    narrow = docs.select(
        F.col(doc_id).alias("doc_id"), held_out(doc_id).alias("held_out"), F.col(text).alias("text")
    )
    return map_rows(
        narrow,
        ["doc_id", "held_out"],
        ["text"],
        "lang_pred string, score double, languages array<struct<lang:string,share:double>>",
        start,
    )

"""Quality classifier by co-training of two views.

One classifier sees the words and shape of the text, the other the metadata of the page. Each
labels all those documents outside the labelled sample it is sure of for the other, for a few rounds: the other
learns from the numbers of good and bad ones of them that each feature occurs in, which Spark
sums. Both are calibrated on labelled documents that neither was trained on, and combined.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagweave.llm.common import SLICE_ROWS, map_rows, settle, unused
from tagweave.session import discard, stage

# Bound of the labelled documents that training reads, the first by hash of their id.
LABELLED = 8000
HELD_SHARE = 0.3  # of the labelled sample, for calibration
ROUNDS, SURE = 3, 0.95
SURE_LOGIT = float(np.log(SURE / (1 - SURE)))
TEXT_BITS, META_BITS = 22, 12
STEMS = (6, 7, 8)  # bytes that words begin with; once, and more than once
MIN_DOCS = 4  # training documents that a feature must occur in
SIGNIFICANT = 2.5  # standard deviations that its share of good documents must be off
L2, STEPS, RATE = 2e-4, 200, 0.2
ACCEPT = 0.5

_WORD_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
_SYMBOLS = "#*$%&|<>{}!?"
_LETTERS = bytes(range(65, 91))


def _level(x: float) -> int:
    """Rough logarithmic size of a share."""
    return 0 if x <= 0 else max(1, min(12, 12 + int(np.floor(np.log2(x)))))


def text_features(text: str | None) -> np.ndarray:
    """Hashed features of a whole text: which words and stems occur, its shape in rough levels."""
    text = text or ""
    raw = text.encode()
    words = raw.translate(_WORD_BYTES).split()
    times = Counter(words)
    seen = Counter(word[:k] for k in STEMS for word in words if len(word) > k)
    n, size = max(1, len(words)), max(1, len(text))
    upper = size - len(raw.translate(None, _LETTERS)) if text.isascii() else sum(map(str.isupper, text))
    shape = [
        f"distinct:{int(20 * len(times) / n)}",
        f"words:{int(np.log2(n))}",
        f"upper:{_level(upper / size)}",
        f"length:{min(20, len(raw) // n)}",
        *[f"symbol{s}:{_level(text.count(s) / n)}" for s in _SYMBOLS if s in text],
    ]
    stems = [b"-" + stem for stem in seen] + [b"+" + stem for stem, m in seen.items() if m > 1]
    again = [b"+" + word for word, m in times.items() if m > 1]
    names = [*times, *again, *stems, *[s.encode() for s in shape]]
    return np.unique(np.fromiter(map(zlib.crc32, names), np.uint32, len(names)) >> (32 - TEXT_BITS))


def meta_features(values: list) -> np.ndarray:
    """Hashed features of metadata: each value, and each pair of values; numbers by magnitude."""
    flat = [
        f"{i}:{int(np.log2(v + 1)) if isinstance(v, (int, float)) and v >= 0 else v}"
        for i, v in enumerate(values)
    ]
    pairs = [f"{a}&{b}" for i, a in enumerate(flat) for b in flat[i + 1 :]]
    hashes = [zlib.crc32(x.encode()) >> (32 - META_BITS) for x in [*flat, *pairs]]
    return np.unique(np.array(hashes, np.uint32))


@dataclass
class Linear:
    """Logistic model over hashed features, with a calibration (slope, intercept)."""

    weights: np.ndarray
    bias: float
    slope: float = 1.0
    shift: float = 0.0

    def raw(self, features: np.ndarray) -> float:
        return float(self.weights[features].sum()) + self.bias

    def logit(self, features: np.ndarray) -> float:
        return self.slope * self.raw(features) + self.shift


def _sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def telling(flat: np.ndarray, owner: np.ndarray, target: np.ndarray, bits: int) -> np.ndarray:
    """Features whose share of good documents is significantly off the share of all documents."""
    occurs = np.bincount(flat, minlength=1 << bits)
    good = np.bincount(flat, weights=target[owner], minlength=1 << bits)
    base = target.mean()
    off = np.abs(good - occurs * base) / np.sqrt(np.maximum(occurs, 1) * base * (1 - base))
    return (occurs >= MIN_DOCS) & (off >= SIGNIFICANT)


def train(rows: list[np.ndarray], target: np.ndarray, bits: int) -> Linear:
    """Class-balanced logistic regression with ridge penalty by Adam over all rows."""
    flat = np.concatenate(rows)
    owner = np.repeat(np.arange(len(rows), dtype=np.int32), [len(r) for r in rows])
    chosen = telling(flat, owner, target, bits)
    column, n_columns = np.cumsum(chosen) - 1, int(chosen.sum())
    used = chosen[flat]
    flat, owner = column[flat[used]], owner[used]
    good = target.sum()
    weight = np.where(target == 1, 0.5 / max(good, 1), 0.5 / max(len(target) - good, 1))
    w = np.zeros(n_columns + 1)
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, STEPS + 1):
        z = np.bincount(owner, weights=w[flat], minlength=len(rows)) + w[-1]
        error = (_sigmoid(z) - target) * weight
        g = np.append(np.bincount(flat, weights=error[owner], minlength=n_columns), error.sum())
        g[:-1] += L2 * w[:-1]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    weights = np.zeros(1 << bits, np.float32)
    weights[chosen] = w[:-1]
    return Linear(weights, float(w[-1]))


def logistic(x: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Coefficients and intercept of a small logistic regression, by Newton steps with a ridge."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = _sigmoid(x @ w)
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(len(w))
        step = np.linalg.solve(hessian, x.T @ (p - target) + 1e-2 * w)
        w -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return w


def calibrate(model: Linear, rows: list[np.ndarray], target: np.ndarray) -> Linear:
    raw = np.array([model.raw(r) for r in rows])
    slope, shift = logistic(raw[:, None], target)
    # a view that tells nothing apart must not vote backwards
    model.slope, model.shift = (slope, shift) if slope > 0 else (0.0, _base_rate(target))
    return model


def _base_rate(target: np.ndarray) -> float:
    share = (target.sum() + 1) / (len(target) + 2)
    return float(np.log(share / (1 - share)))


def lessons(history: list[list[Linear]], features: list[np.ndarray]) -> list[float | None]:
    """What each view says of a document in the first round in which one of them is sure."""
    for models in history:
        logits = [m.logit(f) for m, f in zip(models, features, strict=True)]
        if max(map(abs, logits)) >= SURE_LOGIT:
            return [float(x > 0) if abs(x) >= SURE_LOGIT else None for x in logits]
    return [None] * len(features)


def lesson_counts(
    history: list[list[Linear]], chunks: Iterable[list[list[np.ndarray]]], bits: list[int]
) -> list[np.ndarray]:
    """Per view, numbers of bad and good documents by feature, as labelled by the other view.

    The last column counts the documents. ``chunks`` hold documents, these their views' features.
    """
    counts = [np.zeros((2, (1 << b) + 1), np.int32) for b in bits]
    for chunk in chunks:
        taught = [([], []) for _ in bits]
        for features in chunk:
            for view, label in enumerate(lessons(history, features)):
                if label is not None:
                    taught[1 - view][int(label)].append(features[1 - view])
        for count, classes in zip(counts, taught, strict=True):
            for of_class, rows in zip(count, classes, strict=True):
                if rows:
                    found, n = np.unique(np.concatenate(rows), return_counts=True)
                    of_class[found] += n.astype(np.int32)
                    of_class[-1] += len(rows)
    return counts


Counts = tuple[np.ndarray, np.ndarray, np.ndarray, int, int]  # features, bad, good, all bad, all good


def off_base(bad, good, all_bad: float, all_good: float, root=np.sqrt):
    """Standard deviations by which features' shares of good documents are off that of all."""
    base = all_good / (all_bad + all_good)
    return (good - (bad + good) * base) / root((bad + good) * base * (1 - base))


def taught(counts: Counts, bits: int) -> Linear | None:
    """Naive Bayes over the counted documents; None unless there are good and bad ones."""
    features, bad, good, all_bad, all_good = counts
    if not all_bad or not all_good:
        return None
    weights = np.zeros(1 << bits, np.float32)
    weights[features] = np.log((good + 0.5) / (all_good + 1)) - np.log((bad + 0.5) / (all_bad + 1))
    return Linear(weights, 0.0)


def joined(own: Linear, more: Linear | None, rows: list[np.ndarray], target: np.ndarray) -> Linear:
    """Sum of two models with the weights that suit the held documents best."""
    if more is None:
        return own
    raw = np.array([[own.raw(r), more.raw(r)] for r in rows])
    scale = np.maximum(np.abs(raw).mean(axis=0), 1e-6)
    a, b, _ = combine(raw / scale, target) / np.append(scale, 1.0)
    if a <= 0 and b <= 0:
        return own
    return Linear((a * own.weights + b * more.weights).astype(np.float32), a * own.bias)


def counted_here(pool: list[list[np.ndarray]], bits: list[int]) -> Callable[..., list[Counts]]:
    """Counting of lessons over features in memory."""

    def count(history):
        found = lesson_counts(history, [[list(doc) for doc in zip(*pool, strict=True)]], bits)
        out = []
        for bad, good in found:
            n = bad[:-1] + good[:-1]
            f = np.flatnonzero(n >= MIN_DOCS)
            if bad[-1] and good[-1]:
                f = f[np.abs(off_base(bad[f], good[f], bad[-1], good[-1])) >= SIGNIFICANT]
            out.append((f, bad[f], good[f], int(bad[-1]), int(good[-1])))
        return out

    return count


def counted_in_spark(pool: DataFrame, bits: list[int]) -> Callable[..., list[Counts]]:
    """Counting of lessons over all rows of ``pool`` (text_f, meta_f), which is staged.

    Tasks emit a row per feature they met, Spark sums them; of the sums only features that tell
    something leave it, at most one row per hash value, whatever the size of the corpus.
    """
    spark = pool.sparkSession

    def count(history):
        sent = spark.sparkContext.broadcast(history)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def chunks():
                for batch in batches:
                    for first in range(0, batch.num_rows, SLICE_ROWS):
                        columns = [c.to_pylist() for c in batch.slice(first, SLICE_ROWS).columns]
                        yield [[np.frombuffer(v, np.uint32) for v in doc] for doc in zip(*columns, strict=True)]

            for view, (bad, good) in enumerate(lesson_counts(sent.value, chunks(), bits)):
                f = np.flatnonzero(bad + good)
                arrays = [np.full(len(f), view, np.int32), f.astype(np.int32), bad[f].astype(np.int64), good[f].astype(np.int64)]
                for at in range(0, len(f), 1 << 16):
                    part = [pa.array(x[at : at + (1 << 16)]) for x in arrays]
                    yield pa.RecordBatch.from_arrays(part, names=["view", "feature", "bad", "good"])

        def sums():
            rows = pool.select("text_f", "meta_f").mapInArrow(run, "view int, feature int, bad bigint, good bigint")
            return rows.groupBy("view", "feature").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))

        summed = settle(sums, "lesson-counts")
        out = []
        for view, b in enumerate(bits):
            mine = summed.filter(F.col("view") == view)
            total = mine.filter(F.col("feature") == 1 << b).first()
            all_bad, all_good = (total.bad, total.good) if total else (0, 0)
            chosen = mine.filter((F.col("feature") < 1 << b) & (F.col("bad") + F.col("good") >= MIN_DOCS))
            if all_bad and all_good:
                off = off_base(F.col("bad"), F.col("good"), all_bad, all_good, F.sqrt)
                table = chosen.filter(F.abs(off) >= SIGNIFICANT).select("feature", "bad", "good").toArrow()
            else:
                table = chosen.limit(0).select("feature", "bad", "good").toArrow()
            out.append((*[table.column(i).to_numpy() for i in range(3)], all_bad, all_good))
        discard(summed)
        sent.unpersist()
        return out

    return count


def co_train(
    views: list[list[np.ndarray]], target: np.ndarray, pool: list[list[np.ndarray]] | Callable[..., list[Counts]],
    bits: list[int], rounds: int = ROUNDS,
) -> tuple[list[Linear], np.ndarray]:
    """Calibrated models of both views and the coefficients that combine their logits.

    ``views`` hold the features per view of labelled documents, ``pool`` those of unlabelled ones,
    or counts the lessons over them. Every third labelled document or so is kept for calibration
    and never trained on.
    """
    count = pool if callable(pool) else counted_here(pool, bits)
    held = np.arange(len(target)) % 10 < HELD_SHARE * 10
    kept = [[r for r, h in zip(view, held, strict=True) if h] for view in views]
    own = [
        train([r for r, h in zip(view, held, strict=True) if not h], target[~held].astype(float), b)
        for view, b in zip(views, bits, strict=True)
    ]
    models = [calibrate(Linear(m.weights, m.bias), k, target[held]) for m, k in zip(own, kept, strict=True)]
    history = []
    for _ in range(rounds):
        history.append(models)
        models = [
            calibrate(joined(m, taught(c, b), k, target[held]), k, target[held])
            for m, c, b, k in zip(own, count(history), bits, kept, strict=True)
        ]
    logits = np.array(
        [[m.logit(r) for m, r in zip(models, rows, strict=True)] for rows in zip(*kept, strict=True)]
    )
    return models, combine(logits, target[held])


def combine(logits: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Weights of the views' logits and an intercept; a view that would vote backwards gets none."""
    used = np.ones(logits.shape[1], bool)
    while True:
        weights = np.zeros(len(used) + 1)
        weights[np.append(used, True)] = logistic(logits[:, used], target)
        if (weights[:-1] >= 0).all():
            return weights
        used &= weights[:-1] >= 0


def sampled_ids(docs: DataFrame, labels: DataFrame, doc_id: str, labelled: int) -> DataFrame:
    """(id, label) of a bounded number of labelled documents, label 1 good, 0 bad.

    A document is good if its quality is 1 and it is not toxic; of repeated labels the worst
    counts. The documents with the smallest hash of their id are taken, from narrow tables.
    """
    order = F.xxhash64(F.col("id"), F.lit("sample"))
    good = (F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) != 1)
    known = (
        labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").alias("id"))
        .agg(F.min(good.cast("int")).alias("label"))
    )
    ids = docs.select(F.col(doc_id).alias("id"))
    return known.join(ids, "id", "left_semi").orderBy(order, "id").limit(labelled)


_FEATURES = "text_f binary, meta_f binary"


def _features(df: DataFrame, keep: list[str], text: str, meta: list[str]) -> DataFrame:
    def start():
        return lambda value, *page: (
            text_features(value).tobytes(),
            meta_features(list(page)).tobytes(),
        )

    return map_rows(df, keep, [text, *meta], _FEATURES, start)


def fit_quality(
    docs: DataFrame, labels: DataFrame, doc_id: str, text: str, meta: list[str],
    labelled: int, rounds: int,
) -> tuple[list[Linear], np.ndarray] | None:
    """The models, or None if the labels leave nothing to tell apart."""
    narrow = docs.select(
        F.col(doc_id).alias("id"),
        F.col(text).alias("text"),
        *[F.col(c).alias(f"meta{i}") for i, c in enumerate(meta)],
    )
    inputs = "text", [f"meta{i}" for i in range(len(meta))]
    wanted = stage(sampled_ids(docs, labels, doc_id, labelled), "sampled-ids")
    chosen = _features(narrow.join(F.broadcast(wanted), "id"), ["id", "label"], *inputs)
    # one row per id, the smallest of repeated ones; bounded by the sample
    one = chosen.groupBy("id").agg(F.min(F.struct("text_f", "meta_f", "label")).alias("r"))
    rows = [(r.id, *r.r) for r in one.collect()]
    rows.sort(key=lambda r: (zlib.crc32(str(r[0]).encode()), str(r[0])))
    target = np.array([r[3] for r in rows], float)
    held = np.arange(len(target)) % 10 < HELD_SHARE * 10
    if any(len(set(part.tolist())) < 2 for part in (target[held], target[~held])):
        return None
    views = [[np.frombuffer(r[i], np.uint32) for r in rows] for i in (1, 2)]
    bits = [TEXT_BITS, META_BITS]
    others = narrow.join(F.broadcast(wanted.select("id")), "id", "left_anti")
    free = stage(_features(others, [], *inputs), "pool-features")
    fitted = co_train(views, target, counted_in_spark(free, bits), bits, rounds)
    discard(free)
    return fitted


def score_quality(
    docs: DataFrame,
    labels: DataFrame,
    keep: list[str],
    doc_id: str = "doc_id",
    text: str = "text",
    meta: tuple[str, ...] = ("source", "lang", "n_chars"),
    labelled: int = LABELLED,
    rounds: int = ROUNDS,
    result: str = "quality",
) -> DataFrame:
    """The columns ``keep`` of each row and a struct ``result`` (p_text, p_meta, score, accepted).

    ``docs`` may be the table the labels speak of, or what is left of it. Training reads a bounded
    sample of ``labelled`` documents and, in each round, the staged features of every row outside
    it, labelled or not, repeated rows as often as they occur. Null texts have the features of empty
    ones, null metadata is a value like others. Without labels of
    both kinds nothing can be learned: scores are null and all documents are accepted. Ties and
    repeated rows are judged alike, an empty table gives an empty one.
    """
    fitted = fit_quality(docs, labels, doc_id, text, list(meta), labelled, rounds)
    sent = docs.sparkSession.sparkContext.broadcast(fitted)

    def start():
        fitted = sent.value

        def one(value, *page):
            if fitted is None:
                return ({"p_text": None, "p_meta": None, "score": None, "accepted": True},)
            models, weights = fitted
            seen = (text_features(value), meta_features(list(page)))
            logits = [m.logit(f) for m, f in zip(models, seen, strict=True)]
            score = float(_sigmoid(np.dot(weights[:-1], logits) + weights[-1]))
            p = [float(_sigmoid(x)) for x in logits]
            return ({"p_text": p[0], "p_meta": p[1], "score": score, "accepted": score >= ACCEPT},)

        return one

    schema = f"`{result}` struct<p_text:double,p_meta:double,score:double,accepted:boolean>"
    return map_rows(docs, keep, [text, *meta], schema, start)


def quality_scores(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", **options) -> DataFrame:
    """One row per input row: ``doc_id``, ``p_text``, ``p_meta``, ``score``, ``accepted``."""
    (result,) = unused(docs, "quality")
    scored = score_quality(docs, labels, [doc_id], doc_id, result=result, **options)
    return scored.select(F.col(doc_id).alias("doc_id"), f"{result}.*")


def keep_accepted(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """``docs`` without the documents that the classifier rejects."""
    (result,) = unused(docs, "quality")
    scored = score_quality(docs, labels, docs.columns, result=result, **options)
    return scored.filter(F.col(f"{result}.accepted")).select(*docs.columns)

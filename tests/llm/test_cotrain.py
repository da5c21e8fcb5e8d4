"""Quality classifier: held-out accuracy, exchange between views, edge cases."""

import numpy as np
import pytest

from tagweave.llm import cotrain
from tagweave.llm.cotrain import (
    Linear,
    calibrate,
    co_train,
    counted_here,
    counted_in_spark,
    keep_accepted,
    logistic,
    quality_scores,
    train,
)


def test_accuracy_on_labels_not_trained_on(spark):
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    some = labels.filter("crc32(cast(doc_id as string)) % 4 > 0")
    rest = labels.filter("crc32(cast(doc_id as string)) % 4 = 0")
    rows = quality_scores(docs, some).join(rest, "doc_id").collect()
    good = [r.accepted for r in rows if r.quality == 1 and r.toxic == 0]
    bad = [r.accepted for r in rows if r.quality == 0 or r.toxic == 1]
    assert np.mean(good) >= 0.98
    assert np.mean(bad) <= 0.1


def test_views_teach_each_other():
    """Few labels, two views of one truth: the pool helps the view that its labels cannot teach."""
    rng = np.random.default_rng(1)

    def draw(n, noise):
        y = rng.integers(0, 2, n).astype(float)
        view = [np.unique(np.where(rng.random(12) < noise, rng.integers(0, 40, 12), 20 * int(v) + rng.integers(0, 20, 12))) for v in y]
        return y, view

    y, a = draw(60, 0.2)
    b = [np.unique(20 * int(v) + rng.integers(0, 20, 2)) for v in y]
    truth, pool_a = draw(600, 0.2)
    pool_b = [np.unique(20 * int(v) + rng.integers(0, 20, 2)) for v in truth]
    models, weights = co_train([a, b], y, [pool_a, pool_b], [6, 6])
    alone = train(b[20:], y[20:], 6)
    right = lambda m: np.mean([(m.raw(f) > 0) == (t == 1) for f, t in zip(pool_b, truth, strict=True)])
    assert right(models[1]) >= right(alone)
    assert right(models[1]) > 0.95 and (weights[:-1] >= 0).all()


def test_calibration_gives_shares():
    rng = np.random.default_rng(2)
    x = rng.normal(size=4000)
    y = (rng.random(4000) < 1 / (1 + np.exp(-(2 * x - 1)))).astype(float)
    slope, shift = logistic(x[:, None], y)
    assert abs(slope - 2) < 0.3 and abs(shift + 1) < 0.2
    backwards = Linear(np.array([-1.0, 1.0]), 0.0)
    rows = [np.array([int(v > 0)]) for v in -x]
    assert calibrate(backwards, rows, (x < 0).astype(float)).slope >= 0


def test_every_sure_document_teaches(spark):
    """6,000 documents that both views are sure of: all are counted, in Spark as in memory."""
    pool = [[np.array([i % 2, 2 + i % 7], np.uint32) for i in range(6000)] for _ in range(2)]
    sure = Linear(np.array([9.0, -9.0] + [0.0] * 14, np.float32), 0.0)
    rows = [(a.tobytes(), b.tobytes()) for a, b in zip(*pool, strict=True)]
    df = spark.createDataFrame(rows, "text_f binary, meta_f binary").repartition(5)
    for count in (counted_here(pool, [4, 4]), counted_in_spark(df, [4, 4])):
        for features, bad, good, all_bad, all_good in count([[sure, sure]]):
            assert (all_bad, all_good) == (3000, 3000)
            assert sorted(zip(features, bad, good, strict=True)) == [(0, 0, 3000), (1, 3000, 0)]


SCHEMA = "doc_id bigint, text string, source string, lang string, n_chars bigint, score string"


def table(spark):
    good = "plain words about something quite ordinary here "
    rows = [(i, good * 3 + f"w{i}" if i % 3 else "buy $$$ now *** " * 5, f"s{i % 5}", "en", 10, "") for i in range(300)]
    rows += [(900, None, None, None, None, ""), (901, "", "s1", "en", -3, ""), (902, good * 20000, "s1", "en", 9, "")]
    rows += [(902, good * 20000, "s1", "en", 9, ""), (None, "buy $$$ now *** " * 5, "s1", "en", 9, "")]
    return spark.createDataFrame(rows, SCHEMA)


def test_nulls_repeats_and_clashing_columns(spark):
    docs = table(spark)
    labels = spark.createDataFrame(
        [(i, int(bool(i % 3)), 0 if i % 2 else None) for i in range(200)] + [(None, 1, 0), (5, None, 1), (7, 1, 0)],
        "doc_id bigint, quality int, toxic int",
    )
    rows = quality_scores(docs, labels)
    assert rows.columns == ["doc_id", "p_text", "p_meta", "score", "accepted"]
    by_id = {r.doc_id: r for r in rows.collect()}
    assert rows.count() == docs.count()
    assert all(by_id[i].accepted == bool(i % 3) for i in range(300))
    assert not by_id[None].accepted and by_id[902].accepted
    assert 0 <= by_id[900].score <= 1
    kept = keep_accepted(docs, labels)
    assert kept.columns == docs.columns and kept.filter("doc_id = 902").count() == 2


def test_every_row_is_in_the_sample_or_in_the_pool(spark, monkeypatch):
    """Also documents whose label has no quality, labelled ones beyond the sample, and rows
    without an id; a sampled id on many rows is one training document."""
    seen = {}

    def spy(pool, bits):
        seen["pool"] = pool.count()
        return lambda history: [(np.array([], int), np.array([]), np.array([]), 0, 0)] * 2

    def train_on(views, target, pool, bits, rounds):
        seen["sample"] = len(target)
        return None

    monkeypatch.setattr(cotrain, "counted_in_spark", spy)
    monkeypatch.setattr(cotrain, "co_train", train_on)
    rows = [(i, f"text {i}", "s") for i in range(100)] + [(3, f"more {i}", "s") for i in range(50)] + [(None, "x", "s")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    labels = spark.createDataFrame([(i, None if i % 5 == 0 else i % 2, 0) for i in range(80)], "doc_id bigint, quality int, toxic int")
    cotrain.fit_quality(docs, labels, "doc_id", "text", ["source"], 1000, 1)
    assert seen == {"sample": 64, "pool": 100 - 64 + 1}  # the 50 further rows of id 3 belong to the sample
    cotrain.fit_quality(docs, labels, "doc_id", "text", ["source"], 20, 1)
    assert seen["sample"] == 20 and seen["pool"] >= 100 - 20 + 1


@pytest.mark.parametrize("rows", [[], [(i, 1, 0) for i in range(50)]])
def test_without_both_kinds_of_labels_all_stay(spark, rows):
    labels = spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")
    assert keep_accepted(table(spark), labels).count() == table(spark).count()
    assert quality_scores(table(spark).limit(0), labels).count() == 0

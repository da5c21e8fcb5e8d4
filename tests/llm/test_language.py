"""Language mixtures: held-out accuracy, mixed documents, selection by penalised likelihood."""

import zlib

import numpy as np

from tagweave.llm.language import fit, identify_languages, mixture
from tagweave.llm.queries import op8_language_id


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = op8_language_id(spark, folder).collect()
    assert len(rows) == len(langs)
    for row in rows:
        assert row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 3 == 1)
        assert row.lang_pred == "und" or 0 < row.score <= 1
    tested = [r for r in rows if r.held_out]
    right = sum(r.lang_pred == langs[r.doc_id] for r in tested)
    assert right / len(tested) >= 0.98


def test_em_finds_proportions_and_number_of_languages():
    rng = np.random.default_rng(0)
    model = rng.dirichlet(np.full(300, 0.2), 4).T + 1e-6
    model /= model.sum(axis=0)
    for shares in ([1, 0, 0, 0], [0.7, 0.3, 0, 0], [0.5, 0.3, 0.2, 0]):
        counts = rng.multinomial(6000, model @ np.array(shares))
        seen = counts > 0
        found = mixture(counts[seen].astype(float), np.log(model[seen]))
        assert set(found) == {i for i, s in enumerate(shares) if s}
        assert all(abs(found[i] - shares[i]) < 0.04 for i in found)
    part, value = fit(np.array([3.0, 1.0]), np.log(np.array([[0.75], [0.25]])))
    assert part.tolist() == [1.0] and np.isclose(value, 3 * np.log(0.75) + np.log(0.25))


def corpus(spark, extra=()):
    words = {"en": "the and of this with from was", "de": "der die und nicht mit auf ist"}
    rows = [(i, " ".join([words[lang]] * 8), lang, "s") for i in range(60) for lang in ["en" if i % 2 else "de"]]
    return spark.createDataFrame([*rows, *extra], "doc_id bigint, text string, lang string, score string")


def test_undetermined_mixed_and_long_texts(spark):
    mixed = "the and of this with from was " * 30 + "der die und nicht mit auf ist " * 20
    extra = [
        (100, None, "en", ""), (101, "123 --- ", "en", ""), (102, "", None, ""), (None, "the and of", None, ""),
        (103, mixed, None, ""), (104, "der die und " * 50000, None, ""), (105, "the and of this", "zz", ""),
        (105, "the and of this", "zz", ""),
    ]
    out = identify_languages(corpus(spark, extra))
    assert out.columns == ["doc_id", "held_out", "lang_pred", "score", "languages"]
    rows = {r.doc_id: r for r in out.collect()}
    assert out.count() == 68
    assert all((rows[i].lang_pred, rows[i].score) == ("und", 0.0) for i in (100, 101, 102))
    assert rows[103].lang_pred == "en" and {x.lang for x in rows[103].languages} == {"en", "de"}
    assert 0.5 < rows[103].score < 0.7
    assert rows[104].lang_pred == "de"
    assert rows[None].held_out is False


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "text", None)], "doc_id bigint, text string, lang string")
    assert identify_languages(docs).first().lang_pred == "und"
    assert identify_languages(docs.limit(0)).count() == 0

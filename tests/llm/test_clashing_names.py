"""Input columns with the names that operators use inside come out as they went in."""

import pytest
from pyspark.sql import functions as F

from tagweave.llm.cotrain import keep_accepted
from tagweave.llm.decontaminate import remove_contaminated
from tagweave.llm.lines import dedup_lines
from tagweave.llm.mixing import mix_sources
from tagweave.llm.simhash import keep_one_each

NAMES = ["_doc", "_hash", "_gone", "_id", "_label", "_quality", "_match", "_copies", "_block",
         "doc", "hash", "gone", "id", "label", "quality", "match", "copies", "block", "row", "fp", "meta0"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, f"some words of text number {i}", "en", "src0", 20) for i in range(40)]
    found = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    return found.withColumns({name: F.concat(F.lit(name), F.col("doc_id").cast("string")) for name in NAMES})


def unchanged(out):
    for row in out.select("doc_id", *NAMES).collect():
        assert all(row[name] == f"{name}{row.doc_id}" for name in NAMES)


def test_lines(docs):
    unchanged(dedup_lines(docs))


def test_mixing(docs):
    unchanged(mix_sources(docs, {"src0": 1.0}))


def test_simhash(docs):
    unchanged(keep_one_each(docs))


def test_decontamination(spark, docs):
    items = spark.createDataFrame([(1, "number 3")], "item_id bigint, text string")
    out = remove_contaminated(docs, items)
    assert out.columns == docs.columns
    unchanged(out)


def test_quality(spark, docs):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(30)], "doc_id bigint, quality int, toxic int")
    out = keep_accepted(docs, labels)
    assert out.columns == docs.columns
    unchanged(out)

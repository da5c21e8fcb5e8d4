"""Plans: what must and must not be in them."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from checks.oracle import statements
from checks.queries import registered
from tagweave.operators.indexing import dense_index
from tagweave.operators.recommend import _top
from tagweave.plans import star

PYTHON = re.compile(r"BatchEvalPython|ArrowEvalPython|MapInPandas|InPandas|InArrow")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_contract(spark):
    assert set(statements()) == set(registered())
    assert set(registered()) <= set(contract.queries())
    assert set(statements()) <= set(contract.oracle_sql()) <= set(contract.queries())
    df = contract.entry(spark)
    assert df.count() > 0 and "score" in df.columns


@pytest.mark.parametrize("name", sorted(registered()))
def test_plan_shape(spark, sf_dir, name):
    """No Python operator but the batch scorer, no cross join, no nested-loop join."""
    text = plan(registered()[name](spark, sf_dir))
    batch = name in ("recommend_batch", "recommend_documents_batch")
    assert bool(PYTHON.search(text)) == batch
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text


def test_top_is_limited_before_the_shuffle(spark):
    scores = spark.range(20_000).select(
        (F.col("id") % 2).alias("request_id"),
        F.col("id").cast("int").alias("position"),
        F.lit(1).alias("tag_count"),
        F.lit(1.0).alias("raw_points"),
        F.lit(1).alias("score"),
        F.lit(1.0).alias("avg_rating"),
        F.lit(1).alias("rating_count"),
    )
    for cap in (50, 5000):
        text = plan(_top(scores, cap))
        assert re.search(rf"WindowGroupLimit .*row_number\(\), {cap}, Partial", text)


def test_unpartitioned_window_only_over_bucket_counts(spark):
    text = plan(dense_index(spark.range(0, 10**9, 1000), "id", "n"))
    single = [line for line in text.splitlines() if "Exchange SinglePartition" in line]
    assert len(single) == 1
    below = text.split("Exchange SinglePartition")[1].splitlines()[1]
    assert "HashAggregate" in below


def test_scan_reads_only_what_the_query_needs(spark, sf_dir):
    text = plan(registered()["item_detail"](spark, sf_dir))
    assert "EqualTo(position,10)" in text
    schemas = re.findall(r"ReadSchema: struct<(.*?)>$", plan(registered()["normalize_titles"](spark, sf_dir)), re.M)
    assert schemas == ["position:bigint,release_name:string"]


def test_sql_agrees(spark, sf_dir):
    """All registered queries against their SQL on the smallest tables."""
    from checks.compare import compare, connect

    con, sql = connect(sf_dir), statements()
    wrong = {}
    for name, query in registered().items():
        ok, note = compare(spark, con, query, sql[name], sf_dir)
        if not ok:
            wrong[name] = note
    assert not wrong


def test_parts_are_dealt_before_crawl_rows_are_made(spark, sf_dir):
    """A file of few bytes may be read by one task: what is made of its rows comes later."""
    for rows in (star.raw_crawl(spark, sf_dir), star.raw_fetch(spark, sf_dir)):
        above, *below = plan(rows).split("REPARTITION_BY_COL")
        assert below and "playcount" in above
        assert not any("playcount" in text or "Seen Live" in text for text in below)

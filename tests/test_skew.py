import pytest
from pyspark.sql import functions as F

from tagweave.operators import skew
from tagweave.operators.lookup import find_exact
from tagweave.operators.variants import consolidate_variants
from tagweave.plans import star


@pytest.mark.parametrize("hot_rows", [1, 7, 10_000])
def test_spread_join_equals_join(spark, hot_rows):
    many = spark.range(600).select(
        "id", F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 20)).alias("k")
    )
    one = spark.createDataFrame([("hot", 1), ("k1", 2), ("k2", 3), ("nobody", 4)], "k string, v int")
    expected = sorted(many.join(one, "k").select("id", "k", "v").collect())
    got = skew.spread_join(many, one, ["k"], "id", hot_rows=hot_rows)
    assert sorted(got.select("id", "k", "v").collect()) == expected


@pytest.mark.parametrize("all_keys", ["true", "false"])
def test_hot_rows_reach_several_tasks(spark, all_keys):
    """Two thirds of the rows under one value of a column, already dealt by that column."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.requireAllClusterKeysForCoPartition": all_keys,
        "spark.sql.shuffle.partitions": "16",
    }
    hot = F.when(F.col("id") % 3 > 0, F.lit(7)).otherwise(F.col("id"))
    many = spark.range(6000).select("id", hot.alias("k"))
    one = many.groupBy("k").agg(F.max("id").alias("v"))
    kept = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        joined = skew.spread_join(many.repartition("k"), one, ["k"], "id", hot_rows=100)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        sizes = joined.groupBy(F.spark_partition_id()).count().collect()
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    assert sum("hashpartitioning" in x and "_salt" in x for x in plan.splitlines()) >= 2
    assert sum(r["count"] for r in sizes) == 6000
    assert max(r["count"] for r in sizes) < 2000


def test_results_do_not_depend_on_what_is_hot(spark, sf_dir, monkeypatch):
    items, pairs = star.items(spark, sf_dir), star.name_pairs(spark, sf_dir)
    runs = []
    for limit in (1, 10**6):
        monkeypatch.setattr(skew, "HOT_ROWS", limit)
        runs.append(
            (
                sorted(map(str, consolidate_variants(items).drop("features").collect())),
                sorted(map(str, find_exact(items, pairs).collect())),
                sorted(map(str, star.enrichment(spark, sf_dir).collect())),
            )
        )
    assert runs[0] == runs[1]


def test_hot_position_is_split_by_the_adaptive_join(spark):
    """The joins left to adaptive skew handling are of the form it can split."""
    from tagweave.operators import recommend
    from tagweave.session import stage

    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.files.maxPartitionBytes": "16KB",
        "spark.sql.files.openCostInBytes": "1KB",
    }
    index = stage(
        spark.range(1, 2000, 1, 8).selectExpr(
            "cast(id as int) as position",
            "array(concat('a', id % 7)) as primary_tags",
            "array(concat('b', id % 5)) as other_tags",
        ),
        "hot_index",
    )
    counted = stage(
        spark.range(0, 40_000, 1, 8).selectExpr(
            "id as request_id",
            "cast(if(id % 3 = 0, 2, 1 + id % 1999) as int) as position",
            "cast(1 as bigint) as times",
        ),
        "hot_counted",
    )
    kept = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        profile = recommend.build_profile(index, counted)
        total = profile.selectExpr("sum(sum_w)", "sum(n)")
        got = total.collect()[0][:]
        text = total._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in kept.items():
            spark.conf.set(key, value) if value is not None else spark.conf.unset(key)
    assert got == (80_000.0, 80_000)
    assert "skew=true" in text

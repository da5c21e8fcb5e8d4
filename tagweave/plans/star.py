"""Catalogue, feeds, crawls and requests derived from star-schema tables.

Every input is computed from whole tables; the shapes (suffixed titles, missing lists, quoted
lists, repeated keys, unknown positions) are there to reach every rule of the operators.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagweave.functions.lists import no_strings
from tagweave.functions.text import WHITE_SPACE_RUN, cache_key
from tagweave.operators.crawl import apply_crawl_cache, clean_crawl
from tagweave.operators.features import build_items, conform
from tagweave.operators.search import (
    by_gram,
    gram_counts,
    gram_heads,
    gram_postings,
    search_index,
)
from tagweave.operators.tags import tag_index
from tagweave.schemas import SIMILAR
from tagweave.session import stage_once, tune


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _suffixed_name() -> Column:
    kind = F.col("p_partkey") % 8
    suffix = (
        F.when(kind == 0, F.lit(" (Deluxe Edition)"))
        .when(kind == 1, F.lit(" [2011 Remastered]"))
        .when(kind == 2, F.lit(" Expanded"))
        .otherwise(F.lit(""))
    )
    return F.concat("p_name", suffix)


def _raw_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "supplier").join(
        table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
    )
    # one pass over lineitem, one shuffle on the part key, all aggregates partial
    sales = (
        table(spark, sf_dir, "lineitem")
        .join(nations, F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy(F.col("l_partkey").alias("p_partkey"))
        .agg(
            F.sum("l_quantity").alias("quantity"),
            F.count(F.lit(1)).alias("lines"),
            F.array_sort(F.collect_set("n_name")).alias("nations"),
        )
    )
    unlisted = F.col("p_partkey") % 97 == 0
    quoted = F.concat(F.lit('"'), "p_type", F.lit(', Explicit"'))
    described = F.concat(
        F.array(F.concat(F.lit("size "), F.col("p_size").cast("string"))),
        F.coalesce("nations", no_strings()),
    )
    return (
        table(spark, sf_dir, "part")
        .join(sales, "p_partkey", "left")
        .select(
            (F.col("p_partkey") + 1).cast("bigint").alias("position"),
            F.col("p_brand").alias("artist_name"),
            _suffixed_name().alias("release_name"),
            F.lit(None).cast("string").alias("release_date"),
            F.lit("album").alias("release_type"),
            F.when(unlisted, F.lit("NA"))
            .otherwise(F.replace("p_name", F.lit(" "), F.lit(", ")))
            .alias("primary_genres"),
            F.when(unlisted, F.lit("NA"))
            .when(F.col("p_partkey") % 11 == 0, quoted)
            .otherwise(F.col("p_type"))
            .alias("secondary_genres"),
            F.when(unlisted, F.lit("NA"))
            .otherwise(F.array_join(described, ", "))
            .alias("descriptors"),
            F.coalesce(F.col("quantity") / F.col("lines"), F.lit(0.0)).alias("avg_rating"),
            F.coalesce(F.col("lines"), F.lit(0)).cast("int").alias("rating_count"),
        )
    )


def raw_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as catalogue rows: ratings and descriptors come from their order lines."""
    tune(spark)
    return stage_once(spark, "raw", sf_dir, lambda: _raw_catalogue(spark, sf_dir))


def _crawl_rows(parts: DataFrame, title: Column, found: Column) -> DataFrame:
    """Crawl results for the distinct (brand, title) pairs of ``parts``, first part wins."""
    first_word = F.substring_index("p_name", " ", 1)
    tag = lambda name, weight: F.struct(name.alias("name"), weight.alias("weight"))
    similar = F.transform(
        F.sequence(F.lit(1), F.lit(14)),
        lambda i: F.struct(
            F.when(i % 4 != 0, F.concat("p_brand", F.lit("."), i)).alias("artist"),
            F.concat("p_name", F.lit(" "), i).alias("title"),
        ),
    ).cast(SIMILAR)
    entry = F.struct(
        found.alias("found"),
        F.array(
            tag(F.col("p_type"), F.col("p_size").cast("string")),
            tag(F.lit("ok"), F.lit("1")),
            tag(F.lit("Seen Live"), F.lit("3")),
            tag(F.upper(first_word), F.lit("x")),
            tag(first_word, F.lit("7")),
        ).alias("tags"),
        similar.alias("similar"),
        F.col("p_size").cast("string").alias("playcount"),
    )
    # parts are few bytes a row, so their file may be read by one task: they are dealt as they
    # are, and what is made of them comes after the join
    needed = ["p_partkey", "p_brand", "p_name", "p_type", "p_size"]
    rows = parts.select(*needed).repartition("p_partkey")
    rows = rows.withColumn("cache_key", cache_key(F.col("p_brand"), title))
    firsts = rows.groupBy("cache_key").agg(F.min("p_partkey").alias("p_partkey"))
    dealt = rows.join(firsts, ["cache_key", "p_partkey"])
    return dealt.select("cache_key", entry.alias("entry")).select("cache_key", "entry.*")


def raw_crawl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Earlier crawl, under unsuffixed names: suffixed items have no entry. Large sizes were
    not found."""
    return _crawl_rows(
        table(spark, sf_dir, "part"), F.col("p_name"), F.col("p_size") <= 35
    )


def raw_fetch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Later crawl, under the items' own names. Small sizes were not found."""
    return _crawl_rows(
        table(spark, sf_dir, "part"), _suffixed_name(), F.col("p_size") > 10
    )


def enrichment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tags and similar items per position from the earlier crawl, then the later one."""
    return apply_crawl_cache(
        raw_catalogue(spark, sf_dir),
        clean_crawl(raw_crawl(spark, sf_dir)),
        clean_crawl(raw_fetch(spark, sf_dir)),
    )


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Processed items, enrichment tags attached."""
    return stage_once(
        spark,
        "items",
        sf_dir,
        lambda: build_items(raw_catalogue(spark, sf_dir), enrichment(spark, sf_dir)),
    )


def index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tag index of the items."""
    return stage_once(spark, "index", sf_dir, lambda: tag_index(items(spark, sf_dir)))


def entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search entries of the items."""
    return stage_once(spark, "entries", sf_dir, lambda: search_index(items(spark, sf_dir)))


def postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gram postings of the search entries."""
    return stage_once(
        spark, "postings", sf_dir, lambda: by_gram(gram_postings(entries(spark, sf_dir)))
    )


def posting_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of postings per gram."""
    return stage_once(
        spark, "posting_counts", sf_dir, lambda: by_gram(gram_counts(postings(spark, sf_dir)))
    )


def heads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First entries per gram."""
    return stage_once(
        spark,
        "heads",
        sf_dir,
        lambda: by_gram(gram_heads(entries(spark, sf_dir), postings(spark, sf_dir))),
    )


def external_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source 0: parts under upper-cased brands. Source 1: documents, in pairs of one title,
    with all space-separated pieces of their text as tags."""
    named = lambda names: F.transform(names, lambda n: F.struct(n.alias("name")))
    none = F.lit(None).cast("string")
    parts = table(spark, sf_dir, "part").select(
        F.lit(0).alias("source_rank"),
        F.col("p_partkey").alias("record_seq"),
        F.upper("p_brand").alias("artist_name"),
        F.col("p_name").alias("release_name"),
        named(F.array("p_type")).alias("tags"),
        F.col("p_size").cast("string").alias("playcount"),
        none.alias("listeners"),
        F.lit(None).cast(SIMILAR).alias("similar_albums"),
    )
    documents = table(spark, sf_dir, "documents").select(
        F.lit(1).alias("source_rank"),
        F.col("doc_id").alias("record_seq"),
        F.col("lang").alias("artist_name"),
        F.concat(F.lit("doc "), F.floor(F.col("doc_id") / 2).cast("string")).alias("release_name"),
        named(F.split("text", " ", -1)).alias("tags"),
        none.alias("playcount"),
        F.col("n_chars").cast("string").alias("listeners"),
        F.lit(None).cast(SIMILAR).alias("similar_albums"),
    )
    return parts.unionByName(documents)


def document_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as items whose descriptors are the distinct words of their whole text."""

    def build() -> DataFrame:
        words = F.split(F.lower("text"), WHITE_SPACE_RUN, -1)
        return conform(
            table(spark, sf_dir, "documents").select(
                (F.col("doc_id") + 1).cast("bigint").alias("position"),
                F.col("source").alias("artist_name"),
                F.concat(F.lit("doc "), F.col("doc_id").cast("string")).alias("release_name"),
                F.array_distinct(words).alias("descriptors"),
                F.lit(0.0).alias("avg_rating"),
                F.col("n_chars").cast("int").alias("rating_count"),
            )
        )

    tune(spark)
    return stage_once(spark, "document_items", sf_dir, build)


def document_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_once(
        spark, "document_index", sf_dir, lambda: tag_index(document_items(spark, sf_dir))
    )


def selections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer selects what it ordered, as often as it ordered it; the nation key, or for
    one segment something that is no number, is the requested length."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customers = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.when(F.col("c_mktsegment") == "BUILDING", F.lit("many"))
        .otherwise(F.col("c_nationkey").cast("string"))
        .alias("top_n"),
    )
    return (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .select(
            F.col("o_custkey").alias("request_id"),
            (F.col("l_partkey") + 1).cast("bigint").alias("position"),
            "top_n",
        )
    )


def search_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One query per part in seven forms, with a limit that is a number for most."""
    form = F.col("p_partkey") % 7
    query = (
        F.when(form == 0, F.col("p_name"))
        .when(form == 1, F.concat(F.upper("p_brand"), F.lit(" ")))
        .when(form == 2, F.concat("p_name", F.lit("  Deluxe Edition")))
        .when(form == 3, F.lit("  "))
        .when(form == 4, F.substring("p_name", 2, 2))
        .when(form == 5, F.substring("p_name", 1, 1))
        .otherwise(F.concat("p_brand", F.lit("  "), "p_name", F.lit(" [2011")))
    )
    limit = F.when(F.col("p_size") > 40, F.concat("p_type", F.lit("!"))).otherwise(
        (F.col("p_size") * 2 - 5).cast("string")
    )
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("request_id"), query.alias("query"), limit.alias("limit")
    )


def lookup_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order keys used as positions: most of them name no item."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("request_id"), F.col("o_orderkey").alias("position")
    )


def name_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every part's upper-cased brand and plain name."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("request_id"),
        F.upper("p_brand").alias("artist"),
        F.upper("p_name").alias("title"),
    )

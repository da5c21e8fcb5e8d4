"""Registered queries: each reads whole tables and returns flat, named columns.

Arrays leave as ``;``-joined text so that both engines hash the same values.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagweave.functions import params, text
from tagweave.operators import crawl, display, external, features, lookup, recommend, search
from tagweave.operators import tags, variants
from tagweave.plans import build, star
from tagweave.schemas import EXTERNAL_RECORD
from tagweave.session import shared_folder, stage_once, tune
from tagweave.sources import catalogue, crawl_cache, feed

SELECTED = [10, 20]
REPEATED = [10, 10, 20]
TOP = 50


def joined(values: Column | str) -> Column:
    return F.array_join(values, ";")


def _summed(column: str = "features") -> Column:
    weights = F.map_values(column)
    return F.aggregate(weights, F.lit(0.0), lambda acc, w: acc + w.cast("double"))


def _flat_items(items: DataFrame) -> DataFrame:
    return items.select(
        "position",
        "artist_name",
        "release_name",
        "release_type",
        joined("primary_genres").alias("primary_genres"),
        joined("secondary_genres").alias("secondary_genres"),
        joined("descriptors").alias("descriptors"),
        F.size("features").alias("n_features"),
        _summed().alias("feature_weight"),
        "avg_rating",
        "rating_count",
        joined("lastfm_tags").alias("lastfm_tags"),
        "source",
        "variant_count",
        "lastfm_playcount",
        "lastfm_listeners",
    )


def _flat_recommendations(rows: DataFrame) -> DataFrame:
    return rows.withColumns(
        {c: joined(c) for c in ("descriptors", "primary_genres", "secondary_genres")}
    )


def _flat_detail(rows: DataFrame) -> DataFrame:
    return _flat_recommendations(rows)


def parse_lists(spark, sf):
    parsed = features.parse_lists(star.raw_catalogue(spark, sf))
    return parsed.select(
        "position",
        *[joined(c).alias(c) for c in features.LIST_COLUMNS],
        *[F.size(c).alias(f"n_{c}") for c in features.LIST_COLUMNS],
    )


def feature_map_long(spark, sf):
    return features.features_long(star.items(spark, sf))


def feature_vocabulary(spark, sf):
    return features.feature_vocabulary(star.items(spark, sf))


def list_vocabulary(spark, sf):
    return features.list_vocabulary(star.items(spark, sf))


def vocabulary_counts(spark, sf):
    return features.vocabulary_counts(star.items(spark, sf))


def enriched_item_count(spark, sf):
    return features.enriched_item_count(star.items(spark, sf))


def normalize_titles(spark, sf):
    title = F.col("release_name")
    return star.raw_catalogue(spark, sf).select(
        "position",
        text.norm(title).alias("norm"),
        text.norm_title(title).alias("norm_title"),
        text.is_variant_title(title).alias("is_variant"),
    )


def normalize_queries(spark, sf):
    query = F.col("query")
    return star.search_queries(spark, sf).select(
        "request_id",
        text.norm(query).alias("norm"),
        text.norm_query(query).alias("norm_query"),
        params.query_long_enough(query).alias("long_enough"),
    )


def _consolidated(spark: SparkSession, sf: str) -> DataFrame:
    return variants.consolidate_variants(star.items(spark, sf))


def consolidate_variants(spark, sf):
    return _flat_items(_consolidated(spark, sf))


def consolidate_features(spark, sf):
    return features.features_long(_consolidated(spark, sf))


def _external(spark: SparkSession, sf: str) -> DataFrame:
    return external.external_items(star.items(spark, sf), star.external_feed(spark, sf))


def external_append(spark, sf):
    appended = external.append_external(star.items(spark, sf), star.external_feed(spark, sf))
    return _flat_items(appended)


def external_features(spark, sf):
    return features.features_long(_external(spark, sf))


def build_catalogue(spark, sf):
    built = build.build_catalogue(
        star.raw_catalogue(spark, sf), star.enrichment(spark, sf), star.external_feed(spark, sf)
    )
    return _flat_items(built)


def build_metrics(spark, sf):
    items = star.items(spark, sf)
    appended = stage_once(
        spark,
        "appended",
        sf,
        lambda: external.append_external(items, star.external_feed(spark, sf)),
    )
    return build.build_metrics(items, appended, variants.consolidate_variants(appended))


def crawl_clean(spark, sf):
    cleaned = crawl.clean_crawl(star.raw_crawl(spark, sf))
    pairs = F.array_sort(
        F.transform(
            F.map_entries("tags"), lambda e: F.concat(e["key"], F.lit("="), e["value"])
        )
    )
    return cleaned.select(
        "cache_key",
        "found",
        joined(pairs).alias("tags"),
        joined("tag_list").alias("tag_list"),
        F.size("similar_albums").alias("n_similar"),
        "playcount",
    )


def crawl_join_states(spark, sf):
    tune(spark)
    cache = crawl.clean_crawl(star.raw_crawl(spark, sf))
    return crawl.crawl_states(star.raw_catalogue(spark, sf), cache).select(
        "position", "cache_key", "state", joined("tag_list").alias("tag_list")
    )


def crawl_upsert(spark, sf):
    tune(spark)
    cache = crawl.clean_crawl(star.raw_crawl(spark, sf))
    fetched = crawl.clean_crawl(star.raw_fetch(spark, sf))
    return crawl.upsert_cache(cache, fetched).select(
        "cache_key", "found", joined("tag_list").alias("tag_list"), "playcount"
    )


def enrichment(spark, sf):
    return star.enrichment(spark, sf).select(
        "position",
        joined("tag_list").alias("tag_list"),
        F.size("similar_albums").alias("n_similar"),
    )


def similar_edges(spark, sf):
    return crawl.similar_edges(star.enrichment(spark, sf))


def tag_weights(spark, sf):
    return tags.tag_weights(star.index(spark, sf))


def tag_counts(spark, sf):
    return tags.tag_counts(star.index(spark, sf))


def recommend_one(spark, sf):
    return _flat_recommendations(
        recommend.recommend(star.index(spark, sf), star.items(spark, sf), SELECTED, TOP)
    )


def recommend_repeat_selection(spark, sf):
    return _flat_recommendations(
        recommend.recommend(star.index(spark, sf), star.items(spark, sf), REPEATED, TOP)
    )


def recommend_batch(spark, sf):
    return _flat_recommendations(
        recommend.recommend_batch(
            star.index(spark, sf), star.items(spark, sf), star.selections(spark, sf)
        )
    )


def recommend_documents(spark, sf):
    rows = recommend.recommend(
        star.document_index(spark, sf), star.document_items(spark, sf), SELECTED, TOP
    )
    return rows.withColumn("n_descriptors", F.size("descriptors")).drop(
        "descriptors", "primary_genres", "secondary_genres"
    )


def recommend_documents_batch(spark, sf):
    index = star.document_index(spark, sf)
    each = index.select(F.col("position").cast("bigint").alias("request_id"), "position")
    rows = recommend.recommend_batch(index, star.document_items(spark, sf), each, 10)
    return rows.select(
        "request_id", "rank", "position", "release_name", "score", "raw_points", "tag_count"
    )


def search_index(spark, sf):
    return star.entries(spark, sf)


def autocomplete_one(spark, sf):
    stored = star.postings(spark, sf), star.posting_counts(spark, sf), star.heads(spark, sf)
    return search.suggest(star.entries(spark, sf), "Wi", 10, *stored)


def autocomplete_batch(spark, sf):
    return search.autocomplete(
        star.entries(spark, sf),
        star.search_queries(spark, sf),
        star.postings(spark, sf),
        star.posting_counts(spark, sf),
        star.heads(spark, sf),
    )


def lookup_positions(spark, sf):
    return _flat_detail(lookup.lookup(star.items(spark, sf), star.lookup_requests(spark, sf)))


def item_detail(spark, sf):
    return _flat_detail(lookup.item_detail(star.items(spark, sf), SELECTED[0]))


def find_exact(spark, sf):
    return _flat_detail(lookup.find_exact(star.items(spark, sf), star.name_pairs(spark, sf)))


def display_rows(spark, sf):
    return display.display_rows(
        recommend.recommend(star.index(spark, sf), star.items(spark, sf), SELECTED, TOP)
    )


def clamp_parameters(spark, sf):
    limit = F.col("limit")
    return star.search_queries(spark, sf).select(
        "request_id",
        params.recommend_limit(limit).alias("top_n"),
        params.suggest_limit(limit).alias("limit"),
        params.parse_int(limit, 7).alias("parsed"),
    )


def _folder(spark: SparkSession) -> str:
    """A new folder for tables that a query writes and reads back."""
    return f"{shared_folder(spark)}/sources/{uuid.uuid4().hex}"


def source_csv(spark, sf):
    path = _folder(spark)
    raw = star.raw_catalogue(spark, sf)
    raw.write.option("header", True).option("escape", '"').csv(path)
    return catalogue.read_csv_catalogue(spark, path)


def source_feed(spark, sf):
    """The feed as files that hold one JSON array each, with counters as JSON numbers."""
    path = _folder(spark)
    records = star.external_feed(spark, sf).withColumns(
        {"playcount": F.col("playcount").cast("double"), "listeners": F.col("listeners").cast("bigint")}
    )
    part = F.pmod("record_seq", F.lit(16)) + 100  # three digits, so that names sort as numbers
    written = records.select(
        "source_rank",
        part.alias("part"),
        "record_seq",
        F.to_json(F.struct(*EXTERNAL_RECORD.names)).alias("json"),
    )
    catalogue.write_json_arrays(written, ["source_rank", "part"], ["record_seq", "json"], path)
    paths = [f"{path}/source_rank={rank}" for rank in (0, 1, 2)]  # the last one does not exist
    return feed.read_external_feed(spark, paths).select(
        "source_rank",
        "record_seq",
        "artist_name",
        "release_name",
        F.size("tags").alias("n_tags"),
        "playcount",
        "listeners",
    )


def source_cache(spark, sf):
    """The cache after an upsert, written as JSON lines and as Parquet and read back from both."""
    tune(spark)
    path = _folder(spark)
    cache = crawl.clean_crawl(star.raw_crawl(spark, sf))
    fetched = crawl.clean_crawl(star.raw_fetch(spark, sf))
    crawl_cache.write_cache(cache, fetched, f"{path}/lines", "json")
    lines = crawl_cache.read_cache(spark, f"{path}/lines", "json", damaged="empty")
    crawl_cache.write_cache(lines, fetched, f"{path}/table")
    return crawl_cache.read_cache(spark, f"{path}/table").select(
        "cache_key", "found", joined("tag_list").alias("tag_list"), "playcount"
    )


def source_processed(spark, sf):
    path = _folder(spark)
    catalogue.write_processed(star.items(spark, sf), path)
    return _flat_items(catalogue.read_processed(spark, path)[0])


def source_counts(spark, sf):
    """The counts that writing the processed tables observes in passing."""
    found = catalogue.write_processed(star.items(spark, sf), _folder(spark))
    return spark.createDataFrame(list(found.items()), "name string, n_rows bigint")


def source_similar(spark, sf):
    """Similar-item lists, written and read back."""
    path = _folder(spark)
    crawl_cache.write_similar(crawl.similar_edges(star.enrichment(spark, sf)), path)
    return spark.read.parquet(path)


def source_json_lines(spark, sf):
    path = _folder(spark)
    catalogue.write_json_lines(star.items(spark, sf), path)
    return _flat_items(catalogue.read_json_lines(spark, path))


_ALL = [
    parse_lists,
    feature_map_long,
    feature_vocabulary,
    list_vocabulary,
    vocabulary_counts,
    enriched_item_count,
    normalize_titles,
    normalize_queries,
    consolidate_variants,
    consolidate_features,
    external_append,
    external_features,
    build_catalogue,
    build_metrics,
    crawl_clean,
    crawl_join_states,
    crawl_upsert,
    enrichment,
    similar_edges,
    tag_weights,
    tag_counts,
    recommend_one,
    recommend_repeat_selection,
    recommend_batch,
    recommend_documents,
    recommend_documents_batch,
    search_index,
    autocomplete_one,
    autocomplete_batch,
    lookup_positions,
    item_detail,
    find_exact,
    display_rows,
    clamp_parameters,
    source_csv,
    source_feed,
    source_cache,
    source_processed,
    source_json_lines,
    source_counts,
    source_similar,
]


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {query.__name__: query for query in _ALL}

"""Title search: one entry per variant group, substring queries, suggestions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagweave.fixed import SUGGEST_MAX
from tagweave.functions.params import query_long_enough, suggest_limit
from tagweave.functions.text import is_variant_title, norm, norm_query, norm_title
from tagweave.operators.skew import spread_join

GRAM = 3
_STATIC_ORDER = ["variant_count", "artist_name", "release_name", "min_position"]


def search_index(items: DataFrame) -> DataFrame:
    """One entry per (normalized artist, normalized title).

    Represented by the smallest of (is variant title, most ratings, position). Position is
    unique, so the struct minimum decides on those three and carries the names along. Counts,
    minimum and alias set all have partial aggregates: a group that holds a third of the items
    reaches the shuffle as one row per task. Aliases are sorted to make the blob reproducible.
    """
    ratings = F.coalesce(F.col("rating_count").cast("int"), F.lit(0))
    best = F.struct(
        is_variant_title(F.col("release_name")).alias("is_variant"),
        (-ratings).alias("fewer"),
        F.coalesce("position", F.lit(0)).alias("position"),
        "artist_name",
        "release_name",
    )
    groups = (
        items.select(
            norm(F.col("artist_name")).alias("artist_norm"),
            norm_title(F.col("release_name")).alias("title_norm"),
            norm(F.col("release_name")).alias("alias"),
            "position",
            best.alias("best"),
        )
        .groupBy("artist_norm", "title_norm")
        .agg(
            F.min("best").alias("best"),
            F.count(F.lit(1)).cast("int").alias("variant_count"),
            F.min("position").alias("min_position"),
            F.sort_array(F.collect_set("alias")).alias("aliases"),
        )
    )
    return groups.select(
        F.col("best.position").alias("position"),
        F.col("best.artist_name").alias("artist_name"),
        F.col("best.release_name").alias("release_name"),
        F.concat("best.artist_name", F.lit(" - "), "best.release_name").alias("display"),
        "variant_count",
        F.concat("artist_norm", F.lit(" "), F.array_join("aliases", " ")).alias("raw_search_blob"),
        F.concat("artist_norm", F.lit(" "), "title_norm").alias("normalized_search_blob"),
        (-F.col("best.fewer")).alias("rating_count"),
        "min_position",
    )


def _grams(text: Column) -> Column:
    """Distinct substrings of length 1 to ``GRAM``, over the whole text."""
    size = F.length(text)
    of_length = lambda n: F.when(
        size >= n,
        F.transform(F.sequence(F.lit(1), size - (n - 1)), lambda i: F.substr(text, i, F.lit(n))),
    ).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(*[of_length(n) for n in range(1, GRAM + 1)]))


def _needle_grams(needle: Column) -> Column:
    """The substrings of a needle that an entry must have: its trigrams, or a short needle itself."""
    size = F.length(needle)
    windows = F.transform(
        F.sequence(F.lit(1), size - (GRAM - 1)), lambda i: F.substr(needle, i, F.lit(GRAM))
    )
    return F.when(size >= GRAM, F.array_distinct(windows)).otherwise(F.array(needle))


def gram_postings(index: DataFrame) -> DataFrame:
    """(form, gram, entry) for both search blobs, entry being the group's first position."""
    return index.select(
        F.col("min_position").alias("entry"),
        F.explode(
            F.concat(
                F.transform(
                    _grams(F.col("raw_search_blob")),
                    lambda g: F.struct(F.lit("raw").alias("form"), g.alias("gram")),
                ),
                F.transform(
                    _grams(F.col("normalized_search_blob")),
                    lambda g: F.struct(F.lit("norm").alias("form"), g.alias("gram")),
                ),
            )
        ).alias("p"),
    ).select("p.form", "p.gram", "entry")


def gram_counts(postings: DataFrame) -> DataFrame:
    """(form, gram, df): how many entries hold a gram."""
    return postings.groupBy("form", "gram").agg(F.count(F.lit(1)).alias("df"))


def gram_heads(index: DataFrame, postings: DataFrame) -> DataFrame:
    """(form, gram, head): the first entries of each gram in the order of suggestions, as many as
    a request can ask for.

    A needle of up to three characters is itself a gram, so its head is its answer. Each task
    keeps only its own first entries of a gram before anything is shuffled.
    """
    shown = index.select(F.col("min_position").alias("entry"), *_STATIC_ORDER, "position", "display")
    order = Window.partitionBy("form", "gram").orderBy(*_static_order())
    first = (
        postings.join(shown, "entry")
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= SUGGEST_MAX)
    )
    row = F.struct("rank", "entry", *_STATIC_ORDER, "position", "display")
    return first.groupBy("form", "gram").agg(F.sort_array(F.collect_list(row)).alias("head"))


def by_gram(table: DataFrame) -> DataFrame:
    """Postings, counts or heads in the order of their grams, to be written like that: a lookup
    then reads the few row groups whose range holds its gram."""
    return table.repartitionByRange("gram", "form").sortWithinPartitions("gram", "form")


def _short(needle: Column) -> Column:
    return F.length(needle) <= GRAM


def _matches(
    index: DataFrame,
    postings: DataFrame,
    frequency: DataFrame,
    heads: DataFrame | None,
    texts: DataFrame,
) -> DataFrame:
    """Entries per distinct non-empty (q, nq): raw blob contains q, or normalized blob nq. Of the
    entries of a short needle only the head.

    A containment test is no equi-join, and testing all pairs grows with both sides. A short
    needle is answered by the head of its gram; a longer one is looked up under its rarest gram,
    and the few candidates are verified.
    """
    every = texts.select(
        "q",
        F.inline(
            F.filter(
                F.array(
                    F.struct(F.lit("raw").alias("form"), F.col("q").alias("needle")),
                    F.struct(F.lit("norm").alias("form"), F.col("nq").alias("needle")),
                ),
                lambda n: n["needle"] != "",
            )
        ),
    )
    short = every.filter(_short(F.col("needle")))
    if heads is None:
        asked = short.select("form", F.col("needle").alias("gram")).distinct()
        heads = gram_heads(index, postings.join(asked, ["form", "gram"], "left_semi"))
    # many queries may differ in keywords only and share a needle
    by_head = (
        spread_join(short, heads.withColumnRenamed("gram", "needle"), ["form", "needle"], spread_by="q")
        .select("q", F.inline("head"))
        .select("q", "entry", *_STATIC_ORDER)
    )
    needles = every.filter(~_short(F.col("needle")))
    rarest = (
        needles.select("form", "needle")
        .distinct()
        .select("form", "needle", F.explode(_needle_grams(F.col("needle"))).alias("gram"))
        .join(frequency, ["form", "gram"], "left")
        .groupBy("form", "needle")
        .agg(F.min(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "gram")).alias("rarest"))
        .select("form", "needle", F.col("rarest.gram").alias("gram"))
    )
    candidates = (
        spread_join(needles, rarest, ["form", "needle"], spread_by="q")
        .join(postings, ["form", "gram"])
        .select("q", "form", "needle", "entry")
    )
    blobs = index.select(
        F.col("min_position").alias("entry"),
        "raw_search_blob",
        "normalized_search_blob",
        *_STATIC_ORDER,
    )
    blob = F.when(F.col("form") == "raw", F.col("raw_search_blob")).otherwise(
        F.col("normalized_search_blob")
    )
    verified = candidates.join(blobs, "entry").filter(F.contains(blob, F.col("needle")))
    found = by_head.unionByName(verified.select("q", "entry", *_STATIC_ORDER))
    return found.dropDuplicates(["q", "entry"])


def _static_order() -> list[Column]:
    return [F.desc("variant_count"), *[F.asc(c) for c in _STATIC_ORDER[1:]]]


def _display() -> Column:
    versions = F.concat("display", F.lit(" ("), "variant_count", F.lit(" versions)"))
    return F.when(F.col("variant_count") > 1, versions).otherwise(F.col("display"))


def autocomplete(
    index: DataFrame,
    queries: DataFrame,
    postings: DataFrame | None = None,
    counts: DataFrame | None = None,
    heads: DataFrame | None = None,
) -> DataFrame:
    """Suggestions for a table of (request_id, query, limit).

    ``postings`` is ``gram_postings(index)``, ``counts`` is ``gram_counts(postings)`` and ``heads``
    is ``gram_heads(index, postings)``, all best stored next to the index; otherwise they are
    worked out on every call.

    Equal normalized queries are answered once, up to the largest legal limit, and joined back
    to their requests, so a query that a third of all requests send costs as much as a rare one.
    The empty text matches every entry: its answer is the head of the whole index.
    """
    requests = queries.filter(query_long_enough(F.col("query"))).select(
        "request_id",
        norm(F.col("query")).alias("q"),
        norm_query(F.col("query")).alias("nq"),
        suggest_limit(F.col("limit")).alias("_limit"),
    )
    texts = requests.select("q", "nq").distinct().filter(F.col("q") != "")
    order = Window.partitionBy("q").orderBy(*_static_order())
    postings = gram_postings(index) if postings is None else postings
    answers = (
        _matches(index, postings, gram_counts(postings) if counts is None else counts, heads, texts)
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= SUGGEST_MAX)
        .select("q", "rank", "entry")
    )
    head = (
        index.orderBy(*_static_order())
        .limit(SUGGEST_MAX)
        .select(F.lit("").alias("q"), F.col("min_position").alias("entry"), *_STATIC_ORDER)
        .withColumn("rank", F.row_number().over(order))
        .select("q", "rank", "entry")
    )
    shown = index.select(
        F.col("min_position").alias("entry"),
        "position",
        "artist_name",
        "release_name",
        "variant_count",
        _display().alias("display"),
    )
    return (
        requests.select("request_id", "q", "_limit")
        .join(answers.unionByName(head), "q")
        .filter(F.col("rank") <= F.col("_limit"))
        .join(shown, "entry")
        .select(
            "request_id",
            "rank",
            "position",
            "artist_name",
            "release_name",
            "display",
            "variant_count",
        )
    )


def _candidates(
    form: str, needle: str, postings: DataFrame, counts: DataFrame, index: DataFrame
) -> DataFrame:
    """Entries whose blob contains a longer needle: postings of its rarest gram, verified."""
    grams = {needle[i : i + GRAM] for i in range(len(needle) - GRAM + 1)}
    known = counts.filter((F.col("form") == form) & F.col("gram").isin(*grams)).collect()  # one per gram
    rarest = min(known, key=lambda r: (r.df, r.gram)).gram if len(known) == len(grams) else None
    holds = postings.filter((F.col("form") == form) & (F.col("gram") == F.lit(rarest)))
    blob = "raw_search_blob" if form == "raw" else "normalized_search_blob"
    verified = index.filter(F.contains(blob, F.lit(needle)))
    return verified.join(holds, F.col("min_position") == F.col("entry"), "left_semi")


def suggest(
    index: DataFrame,
    query: str,
    limit: int | str | None = None,
    postings: DataFrame | None = None,
    counts: DataFrame | None = None,
    heads: DataFrame | None = None,
) -> DataFrame:
    """Suggestions for one query.

    With the stored ``postings``, ``counts`` and ``heads`` of the index a query of up to three
    characters is a lookup of one gram, and a longer one joins the postings of its rarest gram.
    Without them, and for the empty text, which every entry contains, the index is filtered in
    place. Only the head is sorted out.
    """
    text = F.lit(query)
    parsed = index.sparkSession.range(1).select(
        norm(text).alias("q"),
        norm_query(text).alias("nq"),
        suggest_limit(F.lit(None if limit is None else str(limit))).alias("n"),
        query_long_enough(text).alias("ok"),
    )
    one = parsed.first()
    columns = [*_STATIC_ORDER, "position", "display"]
    stored = postings is not None and counts is not None and heads is not None
    if stored and one.q:
        parts = []
        for form, needle in dict(raw=one.q, norm=one.nq).items():
            if not needle:
                continue
            if len(needle) <= GRAM:
                head = heads.filter((F.col("form") == form) & (F.col("gram") == F.lit(needle)))
                part = head.select(F.inline("head"))
            else:
                part = _candidates(form, needle, postings, counts, index)
            parts.append(part.select(*columns))
        found = reduce(DataFrame.unionByName, parts)
        found = found.dropDuplicates(["min_position"]) if len(parts) > 1 else found
    else:
        hit = F.contains("raw_search_blob", F.lit(one.q))
        if one.nq:
            hit = hit | F.contains("normalized_search_blob", F.lit(one.nq))
        found = index.filter(hit).select(*columns)
    return (
        found.filter(F.lit(one.ok))
        .orderBy(*_static_order())
        .limit(one.n)
        .select(
            F.row_number().over(Window.orderBy(*_static_order())).alias("rank"),
            "position",
            "artist_name",
            "release_name",
            _display().alias("display"),
            "variant_count",
        )
    )

"""SQL for DuckDB that answers each registered query from the same tables.

Statements are assembled from named sub-queries. Where the library takes a different route to
the same answer (profiles, gram lookups, bucketed numbering), the SQL takes the plain one.
"""

from __future__ import annotations

from tagweave import fixed

_WS = (
    r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
_KW = f"(?:{fixed.VARIANT_KEYWORDS})"
_WORD = r"[\p{L}\p{N}_]"


def _strings(values: list[str]) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def _strip(x: str) -> str:
    return rf"regexp_replace({x}, '^{_WS}+|{_WS}+$', '', 'g')"


def _collapse(x: str) -> str:
    return rf"trim(regexp_replace({x}, '{_WS}+', ' ', 'g'))"


def _norm(x: str) -> str:
    return _collapse(f"lower(coalesce({x}, ''))")


def _norm_title(x: str) -> str:
    bracketed = rf"regexp_replace({_norm(x)}, '\s*[\[(].*?{_KW}.*?[\])]$', '', 'i')"
    return _collapse(rf"regexp_replace({bracketed}, '\s+{_KW}\.?$', '', 'i')")


def _norm_query(x: str) -> str:
    return _collapse(rf"regexp_replace({_norm(x)}, '\b{_KW}\b', ' ', 'gi')")


def _parse(x: str) -> str:
    v = _strip(x)
    body = (
        f"CASE WHEN starts_with({v}, '\"') AND ends_with({v}, '\"') "
        f"THEN substr({v}, 2, greatest(length({v}) - 2, 0)) ELSE {v} END"
    )
    return (
        f"CASE WHEN {x} IS NULL OR {x} = '' OR {x} = 'NA' THEN CAST([] AS VARCHAR[]) "
        f"ELSE list_transform(string_split({body}, ','), lambda y: {_strip('y')}) END"
    )


def _int(x: str, default: int) -> str:
    ok = rf"regexp_matches({_strip(x)}, '^[+-]?[0-9]+$')"
    return f"coalesce(CASE WHEN {ok} THEN TRY_CAST({_strip(x)} AS BIGINT) END, {default})"


def _clamp(x: str, default: int, upper: int) -> str:
    return f"CAST(greatest(1, least({upper}, {_int(x, default)})) AS INTEGER)"


def _text(x: str) -> str:
    return f"array_to_string({x}, ';')"


_SUFFIXED = (
    "p_name || CASE p_partkey % 8 WHEN 0 THEN ' (Deluxe Edition)' "
    "WHEN 1 THEN ' [2011 Remastered]' WHEN 2 THEN ' Expanded' ELSE '' END"
)


def _crawl(name: str, title: str, found: str) -> dict[str, str]:
    """Cleaned crawl table ``name`` and its parts."""
    return {
        f"{name}_src": f"""
            SELECT p_brand || ' - ' || {title} AS cache_key, p_partkey, {found} AS found,
                   p_brand, p_name, p_type, p_size
            FROM part
            QUALIFY row_number() OVER (PARTITION BY p_brand || ' - ' || {title}
                                       ORDER BY p_partkey) = 1""",
        f"{name}_named": f"""
            SELECT cache_key, i, lower({_strip("name")}) AS name,
                   {_int("weight", 1)} AS weight
            FROM (
              SELECT cache_key, 1 AS i, p_type AS name, CAST(p_size AS VARCHAR) AS weight
              FROM {name}_src
              UNION ALL SELECT cache_key, 2, 'ok', '1' FROM {name}_src
              UNION ALL SELECT cache_key, 3, 'Seen Live', '3' FROM {name}_src
              UNION ALL SELECT cache_key, 4, upper(split_part(p_name, ' ', 1)), 'x'
                        FROM {name}_src
              UNION ALL SELECT cache_key, 5, split_part(p_name, ' ', 1), '7' FROM {name}_src
            )
            WHERE length(lower({_strip("name")})) > 2
              AND lower({_strip("name")}) NOT IN ({_strings(fixed.NOISE_TAGS)})""",
        f"{name}_lists": f"""
            SELECT cache_key, list(name ORDER BY i) AS tag_list FROM {name}_named
            GROUP BY cache_key""",
        f"{name}_weights": f"""
            SELECT cache_key, name, arg_max(weight, i) AS weight FROM {name}_named
            GROUP BY cache_key, name""",
        f"{name}_similar": f"""
            SELECT s.cache_key, g.i AS i, s.p_brand || '.' || g.i AS artist,
                   s.p_name || ' ' || g.i AS title
            FROM {name}_src s, (SELECT unnest(generate_series(1, 14)) AS i) g
            WHERE g.i <= {fixed.MAX_SIMILAR} AND g.i % 4 <> 0""",
        f"{name}": f"""
            SELECT s.cache_key, s.found,
                   CASE WHEN s.found THEN coalesce(l.tag_list, CAST([] AS VARCHAR[])) END
                     AS tag_list,
                   CASE WHEN s.found THEN CAST(s.p_size AS BIGINT) END AS playcount
            FROM {name}_src s LEFT JOIN {name}_lists l USING (cache_key)""",
    }


_CTES: dict[str, str] = {
    "sales": f"""
        SELECT l_partkey AS p_partkey, sum(l_quantity) AS quantity, count(*) AS lines,
               list_sort(list(DISTINCT n_name)) AS nations
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
        JOIN nation ON s_nationkey = n_nationkey
        GROUP BY l_partkey""",
    "raw": f"""
        SELECT CAST(p_partkey + 1 AS BIGINT) AS position, p_brand AS artist_name,
               {_SUFFIXED} AS release_name, CAST(NULL AS VARCHAR) AS release_date,
               'album' AS release_type,
               CASE WHEN p_partkey % 97 = 0 THEN 'NA' ELSE replace(p_name, ' ', ', ') END
                 AS primary_genres,
               CASE WHEN p_partkey % 97 = 0 THEN 'NA'
                    WHEN p_partkey % 11 = 0 THEN '"' || p_type || ', Explicit"'
                    ELSE p_type END AS secondary_genres,
               CASE WHEN p_partkey % 97 = 0 THEN 'NA'
                    ELSE array_to_string(list_concat(['size ' || CAST(p_size AS VARCHAR)],
                         coalesce(nations, CAST([] AS VARCHAR[]))), ', ') END AS descriptors,
               coalesce(quantity / lines, 0.0) AS avg_rating,
               CAST(coalesce(lines, 0) AS INTEGER) AS rating_count
        FROM part LEFT JOIN sales USING (p_partkey)""",
    **_crawl("cache", "p_name", "p_size <= 35"),
    **_crawl("fetched", f"({_SUFFIXED})", "p_size > 10"),
    "states": """
        SELECT r.position, r.artist_name || ' - ' || r.release_name AS cache_key,
               CASE WHEN c.found THEN 'hit' WHEN c.cache_key IS NOT NULL THEN 'missing'
                    ELSE 'absent' END AS state,
               CASE WHEN c.found THEN c.tag_list END AS tag_list
        FROM raw r LEFT JOIN cache c
          ON c.cache_key = r.artist_name || ' - ' || r.release_name""",
    "enriched": """
        SELECT position, cache_key, tag_list, 'cache' AS origin FROM states WHERE state = 'hit'
        UNION ALL
        SELECT s.position, s.cache_key, f.tag_list, 'fetch'
        FROM states s JOIN fetched f USING (cache_key)
        WHERE s.state = 'absent' AND f.found""",
    "edges": """
        SELECT e.position, s.i, s.artist, s.title FROM enriched e
        JOIN cache_similar s USING (cache_key) WHERE e.origin = 'cache'
        UNION ALL
        SELECT e.position, s.i, s.artist, s.title FROM enriched e
        JOIN fetched_similar s USING (cache_key) WHERE e.origin = 'fetch'""",
    "items": f"""
        SELECT r.position, artist_name, release_name, release_date, release_type,
               {_parse("primary_genres")} AS primary_genres,
               {_parse("secondary_genres")} AS secondary_genres,
               {_parse("descriptors")} AS descriptors,
               avg_rating, rating_count, e.tag_list AS lastfm_tags,
               CAST(NULL AS VARCHAR) AS source, CAST(NULL AS INTEGER) AS variant_count,
               CAST(NULL AS BIGINT) AS lastfm_playcount,
               CAST(NULL AS BIGINT) AS lastfm_listeners
        FROM raw r LEFT JOIN enriched e USING (position)""",
    "item_features": """
        SELECT DISTINCT position, 'primary_' || v AS feature, 4.0 AS weight
        FROM (SELECT position, unnest(primary_genres) AS v FROM items) WHERE v <> ''
        UNION ALL
        SELECT DISTINCT position, 'secondary_' || v, 2.0
        FROM (SELECT position, unnest(secondary_genres) AS v FROM items) WHERE v <> ''
        UNION ALL
        SELECT DISTINCT position, 'descriptor_' || v, 2.0
        FROM (SELECT position, unnest(descriptors) AS v FROM items) WHERE v <> ''
        UNION ALL
        SELECT position, 'tag_' || v, CAST(count(*) AS DOUBLE)
        FROM (SELECT position, unnest(lastfm_tags) AS v FROM items) WHERE v <> ''
        GROUP BY position, v""",
    "feed": """
        SELECT 0 AS source_rank, p_partkey AS record_seq, upper(p_brand) AS artist_name,
               p_name AS release_name, [p_type] AS tags, CAST(p_size AS BIGINT) AS playcount,
               CAST(0 AS BIGINT) AS listeners
        FROM part
        UNION ALL
        SELECT 1, doc_id, lang, 'doc ' || CAST(doc_id // 2 AS VARCHAR),
               string_split(text, ' '), 0, n_chars
        FROM documents""",
    "fresh": f"""
        SELECT f.*, {_norm("artist_name")} AS ka, {_norm("release_name")} AS kt
        FROM feed f
        WHERE artist_name <> '' AND release_name <> ''
          AND ({_norm("artist_name")}, {_norm("release_name")}) NOT IN
              (SELECT ({_norm("artist_name")}, {_norm("release_name")}) FROM items)
        QUALIFY row_number() OVER (PARTITION BY {_norm("artist_name")}, {_norm("release_name")}
                                   ORDER BY source_rank, record_seq) = 1""",
    "external": f"""
        SELECT CAST((SELECT max(position) FROM items)
                    + row_number() OVER (ORDER BY source_rank, record_seq) AS BIGINT)
                 AS position,
               artist_name, release_name, playcount, listeners,
               list_filter(list_transform(tags, lambda t: lower({_strip("t")})),
                           lambda t: t <> '') AS names
        FROM fresh""",
    "external_items": """
        SELECT position, artist_name, release_name, CAST(NULL AS VARCHAR) AS release_date,
               'album' AS release_type, CAST([] AS VARCHAR[]) AS primary_genres,
               CAST([] AS VARCHAR[]) AS secondary_genres, names[1:30] AS descriptors,
               CAST(0.0 AS DOUBLE) AS avg_rating, 0 AS rating_count,
               CAST(NULL AS VARCHAR[]) AS lastfm_tags, 'lastfm' AS source,
               CAST(NULL AS INTEGER) AS variant_count, playcount AS lastfm_playcount,
               listeners AS lastfm_listeners
        FROM external""",
    "external_features": """
        SELECT DISTINCT position, 'descriptor_' || v AS feature, 2.0 AS weight
        FROM (SELECT position, unnest(names[1:30]) AS v FROM external)
        UNION ALL
        SELECT position, 'tag_' || v, CAST(count(*) AS DOUBLE)
        FROM (SELECT position, unnest(names) AS v FROM external) GROUP BY position, v""",
    "appended": "SELECT * FROM items UNION ALL SELECT * FROM external_items",
    "appended_features": (
        "SELECT * FROM item_features UNION ALL SELECT * FROM external_features"
    ),
    "weights": f"""
        SELECT position, tag, max(w) AS w FROM (
          SELECT position, {_norm("v")} AS tag, w FROM (
            SELECT position, unnest(primary_genres) AS v, CAST(1.5 AS DOUBLE) AS w FROM items
            UNION ALL SELECT position, unnest(secondary_genres), 0.5 FROM items
            UNION ALL SELECT position, unnest(descriptors), 0.5 FROM items))
        WHERE tag <> '' AND tag NOT IN ({_strings(fixed.CONTENT_VERSION_TAGS)})
        GROUP BY position, tag""",
    "counts": """
        SELECT i.position, CAST(count(w.tag) AS INTEGER) AS tag_count
        FROM items i LEFT JOIN weights w USING (position) GROUP BY i.position""",
    "entries": f"""
        SELECT best.position AS position, best.artist_name AS artist_name,
               best.release_name AS release_name,
               best.artist_name || ' - ' || best.release_name AS display,
               CAST(n AS INTEGER) AS variant_count,
               artist_norm || ' ' || array_to_string(aliases, ' ') AS raw_search_blob,
               artist_norm || ' ' || title_norm AS normalized_search_blob,
               best.rating_count AS rating_count, min_position
        FROM (
          SELECT artist_norm, title_norm, count(*) AS n, min(position) AS min_position,
                 list_sort(list(DISTINCT alias)) AS aliases,
                 arg_min({{'position': position, 'artist_name': artist_name,
                          'release_name': release_name, 'rating_count': rating_count}},
                         {{'v': variant, 'r': -rating_count, 'p': position}}) AS best
          FROM (
            SELECT *, {_norm("artist_name")} AS artist_norm,
                   {_norm_title("release_name")} AS title_norm,
                   {_norm("release_name")} AS alias,
                   CASE WHEN {_norm_title("release_name")} <> {_norm("release_name")}
                        THEN 1 ELSE 0 END AS variant
            FROM items)
          GROUP BY artist_norm, title_norm)""",
    "queries": """
        SELECT p_partkey AS request_id,
               CASE p_partkey % 7
                 WHEN 0 THEN p_name WHEN 1 THEN upper(p_brand) || ' '
                 WHEN 2 THEN p_name || '  Deluxe Edition' WHEN 3 THEN '  '
                 WHEN 4 THEN substr(p_name, 2, 2) WHEN 5 THEN substr(p_name, 1, 1)
                 ELSE p_brand || '  ' || p_name || ' [2011' END AS query,
               CASE WHEN p_size > 40 THEN p_type || '!'
                    ELSE CAST(p_size * 2 - 5 AS VARCHAR) END AS "limit"
        FROM part""",
}

_CONSOLIDATED = {
    "keyed": lambda items, feats: f"""
        SELECT *, lower(artist_name) AS ga, lower({_norm_title("release_name")}) AS gt,
               min(position) OVER (PARTITION BY lower(artist_name),
                                   lower({_norm_title("release_name")})) AS base,
               count(*) OVER (PARTITION BY lower(artist_name),
                              lower({_norm_title("release_name")})) AS members
        FROM {items}""",
    "merged_features": lambda items, feats: f"""
        SELECT k.base, f.feature, sum(f.weight) AS weight
        FROM {feats} f JOIN keyed k USING (position) GROUP BY k.base, f.feature""",
    "feature_totals": lambda items, feats: """
        SELECT base, count(*) AS n, sum(weight) AS total FROM merged_features GROUP BY base""",
    "later": lambda items, feats: """
        SELECT base, list(d ORDER BY position, i) AS ds FROM (
          SELECT base, d, position, i FROM (
            SELECT base, position, unnest(descriptors) AS d,
                   generate_subscripts(descriptors, 1) AS i
            FROM keyed)
          QUALIFY row_number() OVER (PARTITION BY base, d ORDER BY position, i) = 1)
        WHERE position <> base GROUP BY base""",
    "numbered": lambda items, feats: """
        SELECT base, row_number() OVER (ORDER BY base) AS n
        FROM (SELECT DISTINCT base FROM keyed)""",
    "consolidated": lambda items, feats: """
        SELECT CAST(n.n AS BIGINT) AS position, k.base, k.artist_name, k.release_name,
               k.release_type, k.primary_genres, k.secondary_genres,
               list_concat(k.descriptors, coalesce(l.ds, CAST([] AS VARCHAR[]))) AS descriptors,
               CAST(coalesce(t.n, 0) AS INTEGER) AS n_features,
               coalesce(t.total, 0.0) AS feature_weight, k.avg_rating, k.rating_count,
               CASE WHEN k.members = 1 THEN k.lastfm_tags END AS lastfm_tags,
               CASE WHEN k.members > 1 THEN coalesce(k.source, 'rym') ELSE k.source END
                 AS source,
               CASE WHEN k.members > 1 THEN CAST(k.members AS INTEGER) END AS variant_count,
               k.lastfm_playcount, k.lastfm_listeners
        FROM keyed k JOIN numbered n ON n.base = k.base
        LEFT JOIN feature_totals t ON t.base = k.base LEFT JOIN later l ON l.base = k.base
        WHERE k.position = k.base""",
}

_DEPENDS_ON = {
    "raw": ["sales"],
    "states": ["raw", "cache"],
    "enriched": ["states", "fetched"],
    "edges": ["enriched", "cache_similar", "fetched_similar"],
    "items": ["raw", "enriched"],
    "item_features": ["items"],
    "fresh": ["feed", "items"],
    "external": ["fresh", "items"],
    "external_items": ["external"],
    "external_features": ["external"],
    "appended": ["items", "external_items"],
    "appended_features": ["item_features", "external_features"],
    "weights": ["items"],
    "counts": ["items", "weights"],
    "entries": ["items"],
    **{
        f"{c}{part}": needs
        for c in ("cache", "fetched")
        for part, needs in {
            "": [f"{c}_src", f"{c}_lists"],
            "_named": [f"{c}_src"],
            "_lists": [f"{c}_named"],
            "_weights": [f"{c}_named"],
            "_similar": [f"{c}_src"],
        }.items()
    },
}


def _with(needed: list[str], body: str, extra: dict[str, str] | None = None) -> str:
    """``body`` preceded by the sub-queries it needs, in dependency order, then ``extra``."""
    order: list[str] = []

    def visit(name: str) -> None:
        for other in _DEPENDS_ON.get(name, []):
            visit(other)
        if name not in order:
            order.append(name)

    for name in needed:
        visit(name)
    parts = {name: _CTES[name] for name in order} | (extra or {})
    if not parts:
        return body.strip()
    ctes = ",\n".join(f"{name} AS MATERIALIZED ({sql})" for name, sql in parts.items())
    return f"WITH {ctes}\n{body.strip()}"


def _consolidation(items: str, feats: str) -> dict[str, str]:
    return {name: make(items, feats) for name, make in _CONSOLIDATED.items()}


_FLAT_CONSOLIDATED = f"""
    SELECT position, artist_name, release_name, release_type,
           {_text("primary_genres")} AS primary_genres,
           {_text("secondary_genres")} AS secondary_genres,
           {_text("descriptors")} AS descriptors, n_features, feature_weight, avg_rating,
           rating_count, {_text("lastfm_tags")} AS lastfm_tags, source, variant_count,
           lastfm_playcount, lastfm_listeners
    FROM consolidated"""

_SCORE = (
    "CAST(round_even(((raw_points / tag_count) * CAST(100.0 AS DOUBLE)) "
    "* least(CAST(1.0 AS DOUBLE), tag_count / CAST(7.0 AS DOUBLE)), 0) AS INTEGER)"
)

_DETAIL = f"""release_date, release_type, {_text("descriptors")} AS descriptors, avg_rating,
    rating_count, {_text("primary_genres")} AS primary_genres,
    {_text("secondary_genres")} AS secondary_genres"""


def _ranked(scored: str) -> dict[str, str]:
    """Scores (request_id, position, raw_points) to ranks, ties in catalogue order."""
    return {
        "scored": scored,
        "ranked": f"""
            SELECT request_id, position, raw_points, tag_count, {_SCORE} AS score,
                   row_number() OVER (PARTITION BY request_id ORDER BY {_SCORE} DESC,
                     avg_rating DESC, rating_count DESC, position) AS rank
            FROM scored JOIN counts USING (position) JOIN items USING (position)
            WHERE raw_points > 0""",
    }


def _naive(selected: list[int], weights: str = "weights") -> str:
    """Pairwise scoring of one selection, duplicates counted as often as they occur."""
    values = ", ".join(f"({p})" for p in selected)
    return f"""
        SELECT CAST(0 AS BIGINT) AS request_id, c.position, sum(s.w + c.w) AS raw_points
        FROM (VALUES {values}) AS chosen(position)
        JOIN {weights} s ON s.position = chosen.position JOIN {weights} c ON c.tag = s.tag
        WHERE c.position NOT IN ({", ".join(map(str, selected))})
        GROUP BY c.position"""


def _recommendation(where: str) -> str:
    return f"""
        SELECT request_id, CAST(rank AS INTEGER) AS rank, position, artist_name, release_name,
               score, raw_points, tag_count, {_text("descriptors")} AS descriptors, avg_rating,
               rating_count, {_text("primary_genres")} AS primary_genres,
               {_text("secondary_genres")} AS secondary_genres
        FROM ranked JOIN items USING (position) WHERE {where}"""


_BATCH = """
    SELECT p.request_id, c.position, sum(p.sum_w + p.n * c.w) AS raw_points
    FROM (SELECT request_id, tag, sum(times * w) AS sum_w, sum(times) AS n
          FROM chosen JOIN weights USING (position) GROUP BY request_id, tag) p
    JOIN weights c USING (tag)
    WHERE NOT EXISTS (SELECT 1 FROM chosen x
                      WHERE x.request_id = p.request_id AND x.position = c.position)
    GROUP BY p.request_id, c.position"""

_CHOSEN = {
    "chosen": """
        SELECT o_custkey AS request_id, CAST(l_partkey + 1 AS BIGINT) AS position,
               count(*) AS times
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        GROUP BY o_custkey, l_partkey""",
    "limits": f"""
        SELECT c_custkey AS request_id,
               {_clamp("CASE WHEN c_mktsegment = 'BUILDING' THEN 'many' ELSE CAST(c_nationkey AS VARCHAR) END", 50, 5000)} AS top_n
        FROM customer""",
}

_WORDS = rf"string_split_regex(lower(text), '{_WS}+')"
_DOCUMENTS = {
    "items": f"""
        SELECT CAST(doc_id + 1 AS BIGINT) AS position, source AS artist_name,
               'doc ' || CAST(doc_id AS VARCHAR) AS release_name, CAST(0.0 AS DOUBLE) AS avg_rating,
               CAST(n_chars AS INTEGER) AS rating_count,
               CAST(len(list_distinct({_WORDS})) AS INTEGER) AS n_descriptors
        FROM documents""",
    "weights": f"""
        SELECT DISTINCT position, tag, CAST(0.5 AS DOUBLE) AS w FROM (
          SELECT CAST(doc_id + 1 AS BIGINT) AS position, unnest({_WORDS}) AS tag
          FROM documents)
        WHERE tag <> '' AND tag NOT IN ({_strings(fixed.CONTENT_VERSION_TAGS)})""",
    "counts": """
        SELECT position, CAST(count(*) AS INTEGER) AS tag_count FROM weights GROUP BY position""",
}

_DISPLAY = "display || CASE WHEN variant_count > 1 THEN ' (' || variant_count || ' versions)' ELSE '' END"
_ENTRY_ORDER = "variant_count DESC, artist_name, release_name, min_position"
_TWO_DECIMALS = (
    "CASE WHEN avg_rating * 8 = floor(avg_rating * 8) AND CAST(floor(avg_rating * 8) AS BIGINT) "
    "% 2 = 1 THEN printf('%.2f', (avg_rating * 100 + 0.5) / 100) "
    "ELSE printf('%.2f', avg_rating) END"
)


def statements() -> dict[str, str]:
    lists = ["primary_genres", "secondary_genres", "descriptors"]
    parsed = {"parsed": "SELECT position, " + ", ".join(f"{_parse(c)} AS {c}" for c in lists) + " FROM raw"}
    vocabulary = """
        SELECT DISTINCT kind, feature FROM (
          SELECT 'primary' AS kind, 'primary_' || unnest(primary_genres) AS feature FROM items
          UNION ALL SELECT 'secondary', 'secondary_' || unnest(secondary_genres) FROM items
          UNION ALL SELECT 'descriptor', 'descriptor_' || unnest(descriptors) FROM items
          UNION ALL SELECT 'tag', 'tag_' || unnest(lastfm_tags) FROM items)"""
    appended_totals = {
        "totals": """SELECT position, count(*) AS n, sum(weight) AS total
                     FROM appended_features GROUP BY position"""
    }
    long = "SELECT position, feature, CAST(weight AS REAL) AS weight FROM"
    similar = _with(
        ["edges"],
        """SELECT position, CAST(row_number() OVER (PARTITION BY position ORDER BY i)
                                 AS INTEGER) AS rank, artist, title
           FROM edges""",
    )
    flat_items = _with(
        ["items", "item_features"],
        f"""SELECT i.position, artist_name, release_name, release_type,
                   {_text("primary_genres")} AS primary_genres,
                   {_text("secondary_genres")} AS secondary_genres,
                   {_text("descriptors")} AS descriptors,
                   CAST(coalesce(t.n, 0) AS INTEGER) AS n_features,
                   CAST(coalesce(t.total, 0.0) AS DOUBLE) AS feature_weight, avg_rating,
                   rating_count, {_text("lastfm_tags")} AS lastfm_tags, source,
                   variant_count, lastfm_playcount, lastfm_listeners
            FROM items i LEFT JOIN totals t ON t.position = i.position""",
        {
            "totals": """SELECT position, count(*) AS n, sum(weight) AS total
                         FROM item_features GROUP BY position"""
        },
    )
    upserted = _with(
        ["cache", "fetched"],
        f"""SELECT cache_key, found, {_text("tag_list")} AS tag_list, playcount FROM cache
            UNION ALL
            SELECT cache_key, found, {_text("tag_list")}, playcount FROM fetched
            WHERE cache_key NOT IN (SELECT cache_key FROM cache)""",
    )
    return {
        "source_csv": _with(["raw"], "SELECT * FROM raw"),
        "source_feed": """
            WITH records AS (
              SELECT 0 AS source_rank, p_partkey AS seq, upper(p_brand) AS artist_name,
                     p_name AS release_name, 1 AS n_tags, CAST(p_size AS VARCHAR) AS playcount,
                     CAST(NULL AS VARCHAR) AS listeners FROM part
              UNION ALL
              SELECT 1, doc_id, lang, 'doc ' || (doc_id // 2), len(string_split(text, ' ')), NULL,
                     CAST(n_chars AS VARCHAR) FROM documents)
            SELECT * EXCLUDE (seq),
                   row_number() OVER (PARTITION BY source_rank ORDER BY seq % 16, seq) - 1 AS record_seq
            FROM records""",
        "source_cache": upserted,
        "source_processed": flat_items,
        "source_json_lines": flat_items,
        "source_counts": _with(
            ["items", "item_features"],
            """SELECT 'items' AS name, count(*) AS n_rows FROM items
               UNION ALL SELECT 'vocabulary', count(DISTINCT feature) FROM item_features""",
        ),
        "source_similar": similar,
        "parse_lists": _with(
            ["raw"],
            "SELECT position, "
            + ", ".join(f"{_text(c)} AS {c}, CAST(len({c}) AS INTEGER) AS n_{c}" for c in lists)
            + " FROM parsed",
            parsed,
        ),
        "feature_map_long": _with(["item_features"], f"{long} item_features"),
        "feature_vocabulary": _with(
            ["item_features"], "SELECT DISTINCT feature FROM item_features ORDER BY feature"
        ),
        "list_vocabulary": _with(["items"], vocabulary),
        "vocabulary_counts": _with(
            ["items"],
            """SELECT kind, count(*) AS n FROM v GROUP BY kind
               UNION ALL SELECT 'all', count(*) FROM v""",
            {"v": vocabulary},
        ),
        "enriched_item_count": _with(
            ["item_features"],
            """SELECT (SELECT count(DISTINCT position) FROM item_features
                       WHERE contains(feature, 'tag_')) AS enriched,
                      (SELECT count(*) FROM items) AS items""",
        ),
        "normalize_titles": _with(
            ["raw"],
            f"""SELECT position, {_norm("release_name")} AS norm,
                       {_norm_title("release_name")} AS norm_title,
                       CASE WHEN {_norm_title("release_name")} <> {_norm("release_name")}
                            THEN 1 ELSE 0 END AS is_variant
                FROM raw""",
        ),
        "normalize_queries": _with(
            ["queries"],
            f"""SELECT request_id, {_norm("query")} AS norm,
                       {_norm_query("query")} AS norm_query, length(query) >= 2 AS long_enough
                FROM queries""",
        ),
        "consolidate_variants": _with(
            ["items", "item_features"],
            _FLAT_CONSOLIDATED,
            _consolidation("items", "item_features"),
        ),
        "consolidate_features": _with(
            ["items", "item_features"],
            """SELECT c.position, m.feature, CAST(m.weight AS REAL) AS weight
               FROM merged_features m JOIN consolidated c USING (base)""",
            _consolidation("items", "item_features"),
        ),
        "external_append": _with(
            ["appended", "appended_features"],
            f"""SELECT a.position, artist_name, release_name, release_type,
                       {_text("primary_genres")} AS primary_genres,
                       {_text("secondary_genres")} AS secondary_genres,
                       {_text("descriptors")} AS descriptors,
                       CAST(coalesce(t.n, 0) AS INTEGER) AS n_features,
                       CAST(coalesce(t.total, 0.0) AS DOUBLE) AS feature_weight, avg_rating,
                       rating_count, {_text("lastfm_tags")} AS lastfm_tags, source,
                       variant_count, lastfm_playcount, lastfm_listeners
                FROM appended a LEFT JOIN totals t ON t.position = a.position""",
            appended_totals,
        ),
        "external_features": _with(["external_features"], f"{long} external_features"),
        "build_catalogue": _with(
            ["appended", "appended_features"],
            _FLAT_CONSOLIDATED,
            _consolidation("appended", "appended_features"),
        ),
        "build_metrics": _with(
            ["appended", "appended_features"],
            """SELECT (SELECT count(*) FROM items) AS read,
                      (SELECT count(*) FROM external_items) AS added,
                      (SELECT count(*) FROM appended) - (SELECT count(*) FROM consolidated)
                        AS removed,
                      (SELECT count(*) FROM consolidated) AS kept""",
            _consolidation("appended", "appended_features"),
        ),
        "crawl_clean": _with(
            ["cache", "cache_weights", "cache_similar"],
            f"""SELECT c.cache_key, c.found,
                       CASE WHEN c.found THEN coalesce(w.tags, '') END AS tags,
                       {_text("c.tag_list")} AS tag_list,
                       CASE WHEN c.found THEN CAST(s.n AS INTEGER) END AS n_similar, c.playcount
                FROM cache c
                LEFT JOIN (SELECT cache_key,
                                  array_to_string(list_sort(list(name || '=' || weight)), ';')
                                    AS tags
                           FROM cache_weights GROUP BY cache_key) w USING (cache_key)
                LEFT JOIN (SELECT cache_key, count(*) AS n FROM cache_similar
                           GROUP BY cache_key) s USING (cache_key)""",
        ),
        "crawl_join_states": _with(
            ["states"],
            f"SELECT position, cache_key, state, {_text('tag_list')} AS tag_list FROM states",
        ),
        "crawl_upsert": upserted,
        "enrichment": _with(
            ["enriched", "edges"],
            f"""SELECT e.position, {_text("e.tag_list")} AS tag_list,
                       CAST(s.n AS INTEGER) AS n_similar
                FROM enriched e LEFT JOIN (SELECT position, count(*) AS n FROM edges
                                           GROUP BY position) s USING (position)""",
        ),
        "similar_edges": similar,
        "tag_weights": _with(["weights"], "SELECT position, tag, w FROM weights"),
        "tag_counts": _with(["counts"], "SELECT position, tag_count FROM counts"),
        "recommend_one": _with(
            ["items", "weights", "counts"],
            _recommendation("rank <= 50"),
            _ranked(_naive([10, 20])),
        ),
        "recommend_repeat_selection": _with(
            ["items", "weights", "counts"],
            _recommendation("rank <= 50"),
            _ranked(_naive([10, 10, 20])),
        ),
        "recommend_batch": _with(
            ["items", "weights", "counts"],
            _recommendation(
                "rank <= (SELECT top_n FROM limits WHERE limits.request_id = ranked.request_id)"
            ),
            _CHOSEN | _ranked(_BATCH),
        ),
        "recommend_documents": _with(
            [],
            """SELECT request_id, CAST(rank AS INTEGER) AS rank, position, artist_name,
                      release_name, score, raw_points, tag_count, avg_rating, rating_count,
                      n_descriptors
               FROM ranked JOIN items USING (position) WHERE rank <= 50""",
            _DOCUMENTS | _ranked(_naive([10, 20])),
        ),
        "recommend_documents_batch": _with(
            [],
            """SELECT request_id, CAST(rank AS INTEGER) AS rank, position, release_name, score,
                      raw_points, tag_count
               FROM ranked JOIN items USING (position) WHERE rank <= 10""",
            _DOCUMENTS
            | {
                "chosen": """SELECT CAST(position AS BIGINT) AS request_id, position, 1 AS times
                             FROM items"""
            }
            | _ranked(_BATCH),
        ),
        "search_index": _with(["entries"], "SELECT * FROM entries"),
        "autocomplete_one": _with(
            ["entries"],
            f"""SELECT CAST(row_number() OVER (ORDER BY {_ENTRY_ORDER}) AS INTEGER) AS rank,
                       position, artist_name, release_name, {_DISPLAY} AS display, variant_count
                FROM entries
                WHERE contains(raw_search_blob, 'wi') OR contains(normalized_search_blob, 'wi')
                ORDER BY {_ENTRY_ORDER} LIMIT 10""",
        ),
        "autocomplete_batch": _with(
            ["entries", "queries"],
            f"""SELECT request_id, CAST(rank AS INTEGER) AS rank, position, artist_name,
                       release_name, {_DISPLAY} AS display, variant_count
                FROM (
                  SELECT r.request_id, r.n, e.*,
                         row_number() OVER (PARTITION BY r.request_id
                                            ORDER BY {_ENTRY_ORDER}) AS rank
                  FROM requests r JOIN entries e
                    ON contains(e.raw_search_blob, r.q)
                    OR (r.nq <> '' AND contains(e.normalized_search_blob, r.nq)))
                WHERE rank <= n""",
            {
                "requests": f"""
                    SELECT request_id, {_norm("query")} AS q, {_norm_query("query")} AS nq,
                           {_clamp('"limit"', 10, 50)} AS n
                    FROM queries WHERE length(query) >= 2"""
            },
        ),
        "lookup_positions": _with(
            ["items"],
            f"""SELECT o_custkey AS request_id, position, artist_name, release_name, {_DETAIL}
                FROM orders JOIN items ON o_orderkey = position""",
        ),
        "item_detail": _with(
            ["items"],
            f"SELECT position, artist_name, release_name, {_DETAIL} FROM items WHERE position = 10",
        ),
        "find_exact": _with(
            ["items"],
            f"""SELECT p_partkey AS request_id, position, artist_name, release_name, {_DETAIL}
                FROM part JOIN items ON lower(artist_name) = lower(p_brand)
                                    AND lower(release_name) = lower(p_name)
                QUALIFY row_number() OVER (PARTITION BY p_partkey ORDER BY position) = 1""",
        ),
        "display_rows": _with(
            ["items", "weights", "counts"],
            f"""SELECT request_id, CAST(rank AS INTEGER) AS rank, position,
                       '#' || rank || ': ' || release_name AS heading, artist_name AS artist,
                       {_TWO_DECIMALS} || '/5.0' AS rating,
                       format('{{:,}}', rating_count) AS ratings, score || ' pts' AS points,
                       nullif(array_to_string(primary_genres, ', '), '') AS "primary",
                       nullif(array_to_string(secondary_genres, ', '), '') AS secondary,
                       array_to_string(descriptors[1:8], ', ')
                         || CASE WHEN len(descriptors) > 8 THEN '...' ELSE '' END AS descriptors
                FROM ranked JOIN items USING (position) WHERE rank <= 50""",
            _ranked(_naive([10, 20])),
        ),
        "clamp_parameters": _with(
            ["queries"],
            f"""SELECT request_id, {_clamp('"limit"', 50, 5000)} AS top_n,
                       {_clamp('"limit"', 10, 50)} AS "limit", {_int('"limit"', 7)} AS parsed
                FROM queries""",
        ),
    }

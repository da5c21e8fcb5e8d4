"""SQL (DuckDB) for those queries of the operators that SQL can express."""

from __future__ import annotations

# Hosts are sources; a rule's prior has the mean and variance of the hosts' raw rates.
_RULES = r"""
WITH words AS (
  SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)),
      lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), numbered AS (
  SELECT row_number() OVER () AS r, * FROM words
), windows AS (
  SELECT r, unnest(range(1, len(w) - 1)) AS i, w FROM numbered WHERE len(w) >= 3
), named AS (
  SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS win FROM windows
), twice AS (
  SELECT r, i, count(*) OVER (PARTITION BY r, win) AS k FROM named
), covered AS (
  SELECT r, count(DISTINCT p) AS n FROM (
    SELECT r, unnest([i, i + 1, i + 2]) AS p FROM twice WHERE k > 1) GROUP BY r
), m AS (
  SELECT doc_id, host, len(w)::BIGINT AS n_words,
    length(list_aggregate(w, 'string_agg', ''))::BIGINT AS joined,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    len(lines) AS n_lines, coalesce(n, 0)::BIGINT AS n_repeat_words
  FROM numbered LEFT JOIN covered USING (r)
), flags AS (
  SELECT *, n_words < 50 AS short, 100 * n_repeat_words > 50 * n_words AS repeats,
    100 * n_symbols > 20 * n_words AS symbols, 100 * n_dup_lines > 30 * n_lines AS dup_lines
  FROM m
), rates AS (
  SELECT host, count(*) AS n, unnest(['short', 'repeats', 'symbols', 'dup_lines']) AS rule,
    unnest([sum(short::INT), sum(repeats::INT), sum(symbols::INT), sum(dup_lines::INT)]) AS fails
  FROM flags GROUP BY host
), prior AS (
  SELECT rule, avg(fails / n) AS mean, var_pop(fails / n) AS spread FROM rates GROUP BY rule
), strengths AS (
  SELECT rule, mean, least(10000.0, greatest(2.0,
    CASE WHEN spread > 0 THEN mean * (1 - mean) / spread - 1 ELSE 10000.0 END)) AS k FROM prior
), verdicts AS (
  SELECT host, max((rate > 0.5)::INT) AS rejected, list(rule) AS rules FROM (
    SELECT host, rule, (fails + mean * k) / (n + k) AS rate FROM rates JOIN strengths USING (rule))
  WHERE rate > 0.25 GROUP BY host
)
SELECT doc_id, n_words, coalesce(joined, 0) AS word_chars, n_symbols, n_dup_lines, n_repeat_words,
  short OR repeats AS base_failed,
  NOT (short OR repeats) AND NOT coalesce(rejected = 1
    OR (short AND list_contains(rules, 'short')) OR (repeats AND list_contains(rules, 'repeats'))
    OR (symbols AND list_contains(rules, 'symbols'))
    OR (dup_lines AND list_contains(rules, 'dup_lines')), false) AS kept
FROM flags LEFT JOIN verdicts USING (host)
"""

# A pattern is a stretch of 13 item words, or a whole shorter item.
_BENCHMARK = r"""
WITH items AS (
  SELECT item_id, list_filter(
    regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark
), patterns AS (
  SELECT DISTINCT item_id, k, array_to_string(w[i : i + k - 1], ' ') AS p FROM (
    SELECT item_id, w, least(13, len(w)) AS k,
      unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i
    FROM items WHERE len(w) > 0)
), docs AS (
  SELECT row_number() OVER () AS r, doc_id, list_filter(
    regexp_split_to_array(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents
), places AS (
  SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i
  FROM docs, (SELECT DISTINCT k FROM patterns) WHERE len(w) >= k
), hits AS (
  SELECT r, i, k, item_id
  FROM (SELECT r, i, k, array_to_string(w[i : i + k - 1], ' ') AS p FROM places)
  JOIN patterns USING (k, p)
), found AS (
  SELECT r, count(DISTINCT item_id) AS n_items,
    sha256(string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR)) AS digest
  FROM hits GROUP BY r
), covered AS (
  SELECT r, count(DISTINCT spot) AS n_hit
  FROM (SELECT r, unnest(range(i, i + k)) AS spot FROM (SELECT DISTINCT r, i, k FROM hits)) GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(n_items, 0)::BIGINT AS n_items, coalesce(digest, sha256('')) AS items_sha256,
  coalesce(n_hit > 0 AND 20 * n_hit >= len(w), false) AS contaminated
FROM docs LEFT JOIN found USING (r) LEFT JOIN covered USING (r)
"""

# Cumulative Poisson probabilities per source, passed by the document's number from its MD5.
_MIX = """
WITH shares AS (
  SELECT 'src0' AS s, 2.0::DOUBLE AS share
  UNION ALL SELECT 'src' || i, 0.9 FROM range(1, 20) AS t(i)
  UNION ALL SELECT '(rest)', 0.9
), docs AS (
  SELECT d.*, coalesce(s, '(rest)') AS named, coalesce(length(text), 0) AS mass,
    coalesce(doc_id::VARCHAR, md5(coalesce(text, ''))) AS k
  FROM documents d LEFT JOIN shares ON source = s
), rates AS (
  SELECT named, share * (SELECT sum(mass) FROM docs) / (SELECT sum(share) FROM shares) / m AS rate
  FROM (SELECT named, sum(mass) AS m FROM docs GROUP BY named) JOIN shares ON named = s WHERE m > 0
), steps AS (
  SELECT named, sum(exp(-rate + j * ln(rate) - lgamma(j + 1))) OVER (
    PARTITION BY named ORDER BY j) AS p FROM rates, range(0, 100) AS t(j)
), drawn AS (
  SELECT *, ('0x' || substr(md5(k || ':42:0'), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS u
  FROM docs
), counted AS (
  SELECT doc_id, text, lang, source, n_chars, k,
    (SELECT count(*) FROM steps WHERE steps.named = drawn.named AND p <= u) AS n FROM drawn
)
SELECT doc_id, text, lang, source, n_chars, copy::INT AS copy,
  md5('order:42:' || k || ':' || copy) AS shuffle_key
FROM (SELECT *, unnest(range(0, n)) AS copy FROM counted)
"""

_CHAT = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), turns AS (
  SELECT *, 24 + length(role) + length(regexp_replace(text,
    '(<|\[)(\\*)(\|im_start\|>|\|im_end\|>|\|endoftext\|>|/?s>|/?INST\])', '\1.\2\3', 'g')) AS chars
  FROM rows
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text))
    AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text)
    FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars
FROM turns GROUP BY conv_id
"""

# Lines as word sets; pairs that share one of their rarest words, compared in full.
_LINES = r"""
WITH docs AS (
  SELECT doc_id, text, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents
), lines AS (
  SELECT doc_id, unnest(range(0, len(ls))) AS i, unnest(ls) AS line FROM docs
), sets AS (
  SELECT doc_id, i, list_sort(list_distinct(list_filter(
    string_split(trim(lower(line), ' ' || chr(9) || chr(11) || chr(12) || chr(13)), ' '),
    lambda x: x <> ''))) AS w FROM lines
), firsts AS (
  SELECT w, len(w) AS n, min((doc_id, i)) AS p FROM sets WHERE len(w) > 0 GROUP BY w
), words AS (
  SELECT p, n, unnest(w) AS word FROM firsts
), ranked AS (
  SELECT p, n, word, row_number() OVER (PARTITION BY p ORDER BY k, word) AS r
  FROM words JOIN (SELECT word, count(*) AS k FROM words GROUP BY word) USING (word)
), prefixes AS (
  SELECT p, n, word FROM ranked WHERE r <= n - ceil(n * 4 / 5) + 1
), pairs AS (
  SELECT DISTINCT a.p AS earlier, b.p AS later FROM prefixes a JOIN prefixes b USING (word)
  WHERE a.p < b.p AND 5 * a.n >= 4 * b.n AND 5 * b.n >= 4 * a.n
), alike AS (
  SELECT DISTINCT later AS p FROM (
    SELECT later, a.n + b.n AS total, len(list_intersect(a.w, b.w)) AS shared
    FROM pairs JOIN firsts a ON a.p = earlier JOIN firsts b ON b.p = later)
  WHERE 9 * shared >= 4 * total
), gone AS (
  SELECT doc_id, i FROM sets JOIN firsts USING (w) LEFT JOIN alike USING (p)
  WHERE alike.p IS NOT NULL OR firsts.p <> (doc_id, i)
)
SELECT doc_id,
  CASE WHEN removed IS NULL THEN text ELSE array_to_string(
    list_filter(ls, lambda x, j: NOT list_contains(removed, j - 1)), chr(10)) END AS text,
  coalesce(len(removed), 0)::BIGINT AS n_removed, coalesce(array_to_string(removed, ','), '') AS removed
FROM docs LEFT JOIN (SELECT doc_id, list_sort(list(i)) AS removed FROM gone GROUP BY doc_id)
  USING (doc_id)
"""


# All n-grams of all pieces are counted, then cut, compared with longer ones and ranked.
_PHRASES = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), listed AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces
), totals AS (
  SELECT lang, sum(len(w))::HUGEINT AS n FROM listed GROUP BY lang
), grams AS (
  SELECT lang, m, array_to_string(w[i : i + m - 1], ' ') AS phrase FROM (
    SELECT lang, m, w, unnest(range(1, len(w) - m + 2)) AS i
    FROM listed, (SELECT unnest(range(1, 6)) AS m) WHERE len(w) >= m)
), counts AS (
  SELECT lang, m, phrase, count(*) AS f FROM grams GROUP BY lang, m, phrase HAVING count(*) >= 100
), cuts AS (
  SELECT lang, m, phrase, f, k, array_to_string(w[1 : k], ' ') AS p, array_to_string(w[k + 1 :], ' ') AS q
  FROM (SELECT *, string_split(phrase, ' ') AS w, unnest(range(1, m)) AS k FROM counts WHERE m > 1)
), scores AS (
  SELECT c.lang, c.m, c.phrase, c.f AS a, k, x.f AS l, y.f AS r, n,
    (1000::HUGEINT * c.f * n) // (x.f::HUGEINT * y.f) AS score
  FROM cuts c JOIN counts x ON x.lang = c.lang AND x.phrase = c.p
    JOIN counts y ON y.lang = c.lang AND y.phrase = c.q JOIN totals t ON t.lang = c.lang
), least AS (
  SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), kept AS (
  SELECT * FROM least c WHERE NOT EXISTS (
    SELECT 1 FROM counts b WHERE b.lang = c.lang AND b.m > c.m AND b.f >= c.a
      AND contains(' ' || b.phrase || ' ', ' ' || c.phrase || ' '))
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept
)
SELECT lang, rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score FROM ranked WHERE rank <= 2000
"""


def statements() -> dict[str, str]:
    return {
        "op4_decontaminate": _BENCHMARK,
        "op6_quality_rules": _RULES,
        "op7_mix_sources": _MIX,
        "op9_chat_format": _CHAT,
        "op10_line_dedup": _LINES,
        "op11_collocations": _PHRASES,
    }

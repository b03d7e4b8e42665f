"""DuckDB SQL that gives the rows of the registered queries."""

from topicgrove.llm.quality_rules import STOP_WORDS

WORD = r"[^\x20\x09-\x0D]+"

_STOP_LIST = ", ".join(f"'{w}'" for w in dict.fromkeys(STOP_WORDS))

QUALITY_RULES = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents
), lines AS (
  SELECT r, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS l FROM d
), win AS (
  SELECT r, i, list_slice(w, i, i + 7) AS g FROM (SELECT r, w, unnest(range(1, len(w) - 6)) AS i FROM d)
), rep AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM win) WHERE n > 1
), cov AS (
  SELECT r, count(DISTINCT i + o) AS n FROM rep, range(0, 8) t(o) GROUP BY r
), c AS (
  SELECT d.doc_id, d.text, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         len(l) - len(list_distinct(l)) AS n_dup_lines, len(l) AS n_lines,
         coalesce(cov.n, 0) AS n_repeat_words, len(list_filter(regexp_extract_all(translate(d.text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}'), lambda x: x IN ({_STOP_LIST}))) AS n_stop,
         len(list_filter(l, lambda x: regexp_matches(x, '(\.\.\.|\x{{2026}})[\x20\x09-\x0D]*$'))) AS n_open,
         len(list_filter(l, lambda x: regexp_matches(x, '^[\x20\x09-\x0D]*[-*\x{{2022}}]'))) AS n_bullet,
         length(regexp_replace(text, '[^!]', '', 'g')) AS n_excl
  FROM d JOIN lines USING (r) LEFT JOIN cov USING (r)
), b AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
         concat_ws(',',
           CASE WHEN n_words = 0 OR word_chars / n_words NOT BETWEEN 2 AND 15 THEN 'word_length' END,
           CASE WHEN n_words > 0 AND n_symbols / n_words > 0.1 THEN 'symbols' END,
           CASE WHEN n_words = 0 OR n_stop / n_words < 0.05 THEN 'stop_words' END,
           CASE WHEN n_words > 0 AND n_excl / n_words > 0.2 THEN 'shouting' END,
           CASE WHEN n_lines > 0 AND n_dup_lines / n_lines > 0.5 THEN 'repeated_lines' END,
           CASE WHEN n_lines > 0 AND n_open / n_lines > 0.3 THEN 'open_lines' END,
           CASE WHEN n_lines > 0 AND n_bullet / n_lines > 0.9 THEN 'bullet_lines' END) AS broken
  FROM c
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
       n_repeat_words::BIGINT AS n_repeat_words, base_failed, broken, NOT base_failed AND broken = '' AS kept
FROM b
"""

MIXING = rf"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS size FROM documents
), s AS (
  SELECT *, [5, 2, 1][class + 1] AS weight FROM (
    SELECT source, sum(size)::BIGINT AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS class FROM d GROUP BY source)
), f AS (
  SELECT s.*, (SELECT coalesce(sum(least(2.0 * o.source_size, o.weight * (2 * s.source_size / s.weight))), 0) FROM s o)
              <= 1.5 * (SELECT sum(source_size) FROM s) AS is_full FROM s
), t AS (
  SELECT source, source_size, class, CASE WHEN is_full THEN 2.0::DOUBLE * source_size ELSE
    ((SELECT 1.5::DOUBLE * sum(source_size) FROM s) - 2 * (SELECT coalesce(sum(source_size), 0) FROM f WHERE is_full))
    / (SELECT sum(weight) FROM f WHERE NOT is_full) * weight END AS target FROM f
), p AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY ('0x' || substr(md5(doc_id::VARCHAR), 1, 7))::BIGINT % (SELECT pow(2, ceil(log2(count(*) // 512 + 1)))::BIGINT FROM d),
    md5(doc_id::VARCHAR), doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before FROM d
), m AS (
  SELECT doc_id, size, source_size, target, class, (before + size / 2.0::DOUBLE) AS m1, (before + source_size + size / 2.0::DOUBLE) AS m2
  FROM p JOIN t ON p.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target::DOUBLE AS target,
       size * (CASE WHEN size > 0 AND m1 < target THEN 1 ELSE 0 END + CASE WHEN size > 0 AND m2 < target THEN 1 ELSE 0 END) AS taken,
       CASE WHEN size > 0 AND m1 < target THEN round(CASE class
         WHEN 0 THEN (sqrt(2.25 - 2 * m1 / target) - 1.5) / -1.0
         WHEN 1 THEN m1 / target
         ELSE CASE WHEN 0.75 * m1 / target < 0.25 THEN 0.75 * m1 / target / 0.5
              ELSE 0.5 + (sqrt(0.25 + 4 * (0.75 * m1 / target - 0.25)) - 0.5) / 2 END END, 9) END AS position
FROM m
"""

URL_FILTERS = r"""
WITH u AS (
  SELECT row_number() OVER () AS r, page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), h AS (
  SELECT r, page_id, lower(regexp_extract(rest, '^[^/?#]*')) AS host, regexp_replace(regexp_extract(rest, '^[^/?#]*[^?#]*'), '^[^/?#]*', '') AS path FROM u
), rules(verdict, host, path) AS (
  VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM (
  SELECT h.page_id, h.host, h.path, rules.host || rules.path AS rule, rules.verdict,
         row_number() OVER (PARTITION BY h.r ORDER BY length(rules.host || rules.path) DESC) AS n
  FROM h LEFT JOIN rules ON (h.host = rules.host OR ends_with(h.host, '.' || rules.host)) AND starts_with(h.path, rules.path)) WHERE n = 1
"""

_PLAIN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

DECONTAMINATION = rf"""
WITH i AS (
  SELECT item_id, regexp_extract_all({_LOWER}, '{_PLAIN}') AS w FROM benchmark
), win AS (
  SELECT DISTINCT item_id, list_slice(w, s, s + 9) AS g FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 8, 2))) AS s FROM i WHERE len(w) > 0)
), d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER}, '{_PLAIN}') AS w FROM documents
), p AS (
  SELECT r, w, unnest(w) AS t, unnest(range(1, len(w) + 1)) AS s FROM d
), f AS (
  SELECT p.r, p.s, len(g) AS n, item_id FROM p JOIN win ON p.t = g[1] AND list_slice(p.w, p.s, p.s + len(g) - 1) = g
), h AS (
  SELECT r, count(DISTINCT s + o) AS n_hit FROM f, range(0, 10) t(o) WHERE o < n GROUP BY r
), x AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item_id::VARCHAR AS item FROM f) GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN h USING (r) LEFT JOIN x USING (r)
"""

def near_dedup_ctes(docs: str, n: int) -> str:
    """CTEs that end in ``comp (doc_id, n_shingles, component_id)`` for the rows of ``docs (doc_id, text)``."""
    return rf"""nd_w AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '{WORD}') AS w FROM {docs}
), nd_s AS (
  SELECT DISTINCT doc_id, list_slice(w, i, i + {n - 1}) AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {n - 2}, 2))) AS i FROM nd_w WHERE len(w) > 0)
), nd_n AS (
  SELECT doc_id, count(*) AS n FROM nd_s GROUP BY doc_id
), nd_p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM nd_s a JOIN nd_s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2
), nd_l AS (
  SELECT a, b FROM nd_p JOIN nd_n x ON x.doc_id = a JOIN nd_n y ON y.doc_id = b WHERE 100 * nd_p.n >= 80 * (x.n + y.n - nd_p.n)
), nd_e AS (
  SELECT a, b FROM nd_l UNION SELECT b, a FROM nd_l
), nd_r(doc_id, c) AS (
  SELECT DISTINCT doc_id, doc_id FROM nd_w UNION SELECT r.doc_id, e.b FROM nd_r r JOIN nd_e e ON e.a = r.c
), comp AS (
  SELECT doc_id, coalesce(any_value(nd_n.n), 0)::BIGINT AS n_shingles, min(c) AS component_id FROM nd_r LEFT JOIN nd_n USING (doc_id) GROUP BY doc_id
)"""


NEAR_DEDUP = f"""WITH RECURSIVE {near_dedup_ctes("documents", 4)}
SELECT doc_id, n_shingles, component_id, doc_id = component_id AS kept FROM comp
"""

PHRASES = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, 'und') AS lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
), pieces AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM d)
), spots AS (
  SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM pieces
), grams AS MATERIALIZED (
  SELECT lang, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS g, count(*)::HUGEINT AS f
  FROM spots, (VALUES (1), (2), (3)) t(k) WHERE i + k - 1 <= len(w) GROUP BY ALL
), totals AS (
  SELECT lang, sum(f)::BIGINT AS n FROM grams WHERE k = 1 GROUP BY lang
), cand AS (
  SELECT lang, k, g, f, string_split(g, ' ') AS w FROM grams WHERE k > 1 AND f >= 10
), parts AS MATERIALIZED (
  SELECT lang, k, g, f, cut, array_to_string(list_slice(w, 1, cut), ' ') AS lg, array_to_string(list_slice(w, cut + 1, k), ' ') AS rg
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM cand)
), cuts AS (
  SELECT c.*, l.f AS l, r.f AS r, (1000000 * c.f * c.f) // (l.f * r.f) AS score
  FROM parts c JOIN grams l ON l.lang = c.lang AND l.g = lg JOIN grams r ON r.lang = c.lang AND r.g = rg
), best AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, cut) = 1
), inside AS (
  SELECT lang, part, max(f) AS longer FROM (
    SELECT lang, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) AS part, f FROM cand WHERE k = 3) GROUP BY lang, part
), ranked AS (
  SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, b.f DESC, b.g) AS rank, b.g AS phrase, b.f, b.l, b.r, score
  FROM best b LEFT JOIN inside i ON b.k = 2 AND i.lang = b.lang AND i.part = b.g WHERE longer IS NULL OR 100 * longer < 50 * b.f
)
SELECT lang, rank, phrase, f::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""

"""The same results in DuckDB SQL, to check the registered queries.

Text patterns differ from the Spark side where the two regex engines do; the
white-space class here is the portable spelling of the same characters.
"""

from __future__ import annotations

from topicgrove.functions.tags import ENGLISH_STOP_WORDS, INSIGNIFICANT_WORDS, KEYWORD_STOP_WORDS
from topicgrove.functions.text import ENTITIES
from topicgrove.functions.urls import DEV_SITE_PATTERNS

WS_BODY = (
    r"\s\x0B\x1C-\x1F\x{0085}\x{00A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)
WS = f"[{WS_BODY}]+"
SITE = r"^(?:[a-zA-Z][a-zA-Z0-9+.\-]*:)?//([^/?#]*)"


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _list(words) -> str:
    return "[" + ", ".join(_text(w) for w in words) + "]"


# Expressions


def _squeeze(x: str) -> str:
    return f"trim(regexp_replace({x}, '{WS}', ' ', 'g'))"


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^{WS}|{WS}$', '', 'g')"


def _first_words(x: str, n: int) -> str:
    return f"array_to_string(string_split({_squeeze(x)}, ' ')[1:{n}], ' ')"


def _num_words(x: str) -> str:
    flat = _squeeze(x)
    return f"CAST(CASE WHEN {flat} = '' THEN 0 ELSE len(string_split({flat}, ' ')) END AS INT)"


def _decode(x: str) -> str:
    name, rest = "split_part(p, ';', 1)", "substr(p, length(split_part(p, ';', 1)) + 2)"
    named = " ".join(f"WHEN {_text(k)} THEN {_text(v)} || {rest}" for k, v in ENTITIES.items())
    number = f"TRY_CAST(substr({name}, 2) AS INT)"
    piece = (
        f"CASE WHEN i = 1 THEN p WHEN NOT contains(p, ';') THEN '&' || p "
        f"WHEN regexp_full_match({name}, '#[0-9]{{1,7}}') AND {number} BETWEEN 1 AND 1114111 THEN chr({number}) || {rest} "
        f"ELSE CASE {name} {named} ELSE '&' || p END END"
    )
    return f"array_to_string(list_transform(string_split({x}, '&'), lambda p, i: {piece}), '')"


HIDDEN = (
    r"(?is)<(?:!--.*?(?:-->|\z)|script\b[^>]*>.*?(?:</script\s*>|\z)"
    r"|style\b[^>]*>.*?(?:</style\s*>|\z)|template\b[^>]*>.*?(?:</template\s*>|\z))"
)
TAG = r"""<[!/?a-zA-Z][^>=]*(?:=\s*(?:"[^"]*"|''[^'']*''|)[^>=]*)*>"""


def _clean_html(x: str) -> str:
    shown = f"regexp_replace(coalesce({x}, 'None'), '{HIDDEN}', chr(1), 'g')"
    broken = f"regexp_replace({shown}, '{TAG}', chr(1), 'g')"
    padded = f"replace(replace({broken}, '>', '> '), '<', ' <')"
    nodes = f"list_transform(string_split({_decode(padded)}, chr(1)), lambda s: {_strip('s')})"
    joined = f"array_to_string(list_filter({nodes}, lambda s: s <> ''), ' ')"
    return rf"replace(replace(replace({joined}, chr(10), ''), chr(13), ''), '\', '')"


def _words(x: str) -> str:
    return rf"regexp_extract_all({x}, '[\p{{L}}\p{{N}}_]+')"


def _without(words: str, stop) -> str:
    return f"list_filter({words}, lambda w: NOT list_contains({_list(stop)}, w))"


def _keyword_words(x: str) -> str:
    plain = f"list_filter({_words(f'lower({x})')}, lambda w: regexp_full_match(w, '[a-z]{{3,}}'))"
    return _without(plain, KEYWORD_STOP_WORDS)


def _tokens(x: str) -> str:
    return f"list_filter({_without(_words(f'lower({x})'), ENGLISH_STOP_WORDS)}, lambda w: length(w) > 1)"


def _seed_tokens(x: str) -> str:
    return _tokens(f"replace({x}, '_', ' ')")


def _tag_words(x: str) -> str:
    return f"list_filter(regexp_split_to_array(lower({x}), '[_{WS_BODY}-]'), lambda w: length(w) > 2)"


def _tag_format(x: str) -> str:
    return f"trim(lower(replace({x}, ' ', '_')), '_')"


def _recent(year: str, title: str) -> str:
    return f"({year} >= 2020 AND NOT {_has_2010s(title)} AND NOT {_has_1900s(title)})"


def _has_2010s(title: str) -> str:
    return rf"regexp_matches({title}, '^[^\n]*201[1-9]')"


def _has_1900s(title: str) -> str:
    return rf"regexp_matches({title}, '^[^\n]*19[0-9][0-9]')"


# Tables

POSTS = r"""posts AS (
  SELECT doc_id AS seq, doc_id AS id, split_part(text, chr(10), 1) AS title, text,
    'https://' || source || '.example.org/' || doc_id AS url, source AS site,
    (2017 + doc_id % 8) || '-06-01T08:00:00' AS date,
    CAST(TRY_CAST(regexp_extract(source, '[0-9]+') AS INT) // 5 + 1 AS INT) AS topic_level_1_cluster_id,
    CAST(TRY_CAST(regexp_extract(source, '[0-9]+') AS INT) + 1 AS INT) AS topic_level_2_cluster_id
  FROM documents)"""

PAGES = r"""page_posts AS (
  SELECT page_id AS seq, page_id AS id, url, html AS text,
    regexp_extract(html, '<title>([^<]*)</title>', 1) AS title,
    (2017 + page_id % 8) || '-06-01T08:00:00' AS date
  FROM pages)"""

RECENT = f"""recent AS (
  SELECT seq, url, text, site, title, year_published FROM (
    SELECT seq, url, text, regexp_extract(url, '{SITE}', 1) AS site, {_clean_html('title')} AS title,
      TRY_CAST(date[1:4] AS INT) AS year_published FROM page_posts)
  WHERE NOT regexp_matches(site, '{"|".join(DEV_SITE_PATTERNS)}') AND {_recent('year_published', 'title')})"""

EMBEDDED = """embedded AS (
  SELECT p.seq, p.title, CAST(e.label // 4 + 1 AS INT) AS topic_level_1_cluster_id,
    CAST(e.label + 1 AS INT) AS topic_level_2_cluster_id, CAST(e.embedding AS DOUBLE[]) AS v
  FROM posts p JOIN embeddings e ON e.vec_id = p.seq % (SELECT count(*) FROM embeddings))"""

LEVEL2 = "titles AS (SELECT topic_level_2_cluster_id AS cluster_id, seq, title FROM posts WHERE topic_level_2_cluster_id IS NOT NULL)"
LEVEL1 = "titles AS (SELECT topic_level_1_cluster_id AS cluster_id, seq, title FROM posts WHERE topic_level_1_cluster_id IS NOT NULL)"

CONCEPTS = "concepts AS (SELECT unnest(string_split(text, chr(10))) AS title FROM benchmark)"
LEXICON = f"""items AS (SELECT item_id, {_words('lower(text)')} AS words FROM benchmark),
lexicon AS (SELECT word, dense_rank() OVER (PARTITION BY word ORDER BY item_id) AS sense_rank, lemma
  FROM (SELECT item_id, unnest(list_distinct(words)) AS word, words[1] AS lemma FROM items))"""


def _word_counts(rows: str, words: str, name: str) -> str:
    """``name(cluster_id, word, count, first_place)``; a cluster without words has a null word."""
    return f"""{name}_each AS (
  SELECT cluster_id, seq, unnest(CASE WHEN len(ws) = 0 THEN [NULL] ELSE ws END) AS word,
    unnest(range(greatest(len(ws), 1))) AS pos
  FROM (SELECT cluster_id, seq, {words} AS ws FROM {rows})),
{name} AS (SELECT cluster_id, word, count(word) AS count, min({{'seq': seq, 'pos': pos}}) AS first_place
  FROM {name}_each GROUP BY ALL)"""


def _candidates(counts: str, sizes: list[int], name: str) -> str:
    tries = ", ".join(f"array_to_string(ws[1:{n}], '_')" for n in sizes)
    return f"""{name}_top AS (
  SELECT cluster_id, list(word ORDER BY place) FILTER (WHERE word IS NOT NULL) AS ws FROM (
    SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY word IS NULL, count DESC, first_place) AS place
    FROM {counts}) WHERE place <= 6 GROUP BY cluster_id),
{name} AS (SELECT cluster_id, CASE WHEN len(ws) > 0 THEN [{tries}, array_to_string(ws[1:6], '_') || '_7'] END AS candidates
  FROM {name}_top)"""


def _greedy(candidates: str, name: str, taken: str, nothing: str) -> str:
    """Clusters one after the other in id order, each taking its first free candidate."""
    return f"""{name}_order AS (
  SELECT cluster_id, candidates, row_number() OVER (ORDER BY cluster_id) AS i FROM {candidates} WHERE candidates IS NOT NULL),
{name}_pick AS (
  SELECT CAST(0 AS BIGINT) AS i, CAST(NULL AS INT) AS cluster_id, CAST(NULL AS VARCHAR) AS tag, {taken} AS taken
  UNION ALL
  SELECT i, cluster_id, tag, list_append(taken, tag) FROM (
    SELECT o.i, o.cluster_id, g.taken,
      coalesce(list_filter(o.candidates[1:5], lambda c: NOT list_contains(g.taken, c))[1], o.candidates[6]) AS tag
    FROM {name}_pick g JOIN {name}_order o ON o.i = g.i + 1)),
{name} AS (SELECT cluster_id, tag FROM {name}_pick WHERE i > 0
  UNION ALL SELECT cluster_id, '{nothing}' FROM {candidates} WHERE candidates IS NULL)"""


def _children(tags: str, name: str = "children") -> str:
    return f"""{name} AS (
  SELECT topic_level_1_cluster_id AS cluster_id, tag, min(seq) AS seq
  FROM posts JOIN {tags} ON {tags}.cluster_id = topic_level_2_cluster_id GROUP BY ALL)"""


LEAF_CANDIDATES = ",\n".join(
    [POSTS, LEVEL2, _word_counts("titles", _keyword_words("title"), "leaf_counts"), _candidates("leaf_counts", [2, 3, 4, 5, 6], "leaf_cand")]
)
KEYWORD_TAGS = ",\n".join(
    [
        LEAF_CANDIDATES,
        _greedy("leaf_cand", "leaf_tags", "CAST([] AS VARCHAR[])", "unknown_topic"),
        _children("leaf_tags"),
        _word_counts("children", _tag_words("tag"), "parent_counts"),
        _candidates("parent_counts", [1, 3, 4, 5, 6], "parent_cand"),
        _greedy(
            "parent_cand",
            "parent_tags",
            "coalesce((SELECT list(tag) FROM leaf_tags WHERE tag NOT IN ('unknown_topic', 'general_topic')), CAST([] AS VARCHAR[]))",
            "general_topic",
        ),
        """tagged AS (SELECT p.*, a.tag AS topic_level_1, b.tag AS topic_level_2 FROM posts p
  LEFT JOIN parent_tags a ON a.cluster_id = p.topic_level_1_cluster_id
  LEFT JOIN leaf_tags b ON b.cluster_id = p.topic_level_2_cluster_id)""",
    ]
)
IDS = "topic_level_1_cluster_id, topic_level_2_cluster_id"
TAGS = "topic_level_1, topic_level_2"
REVIEW = f"SELECT {IDS}, {TAGS}, count(DISTINCT url) AS url_count FROM tagged WHERE {{where}} GROUP BY ALL"
WHOLE = "coalesce(topic_level_1_cluster_id, topic_level_2_cluster_id) IS NOT NULL AND topic_level_1 IS NOT NULL AND topic_level_2 IS NOT NULL"


def _seeds(rows: str, text: str, n: int, several: str, name: str = "seeds") -> str:
    return f"""{name}_docs AS (
  SELECT cluster_id, count(*) AS texts, bool_or({_strip(f"replace({text}, '_', ' ')")} <> '') AS filled FROM {rows} GROUP BY ALL),
{name}_tf AS (
  SELECT cluster_id, term, count(*) AS tf FROM (
    SELECT cluster_id, unnest({_seed_tokens(text)}) AS term FROM {rows}) GROUP BY ALL),
{name}_vocab AS (
  SELECT term, ln((1 + (SELECT count(*) FROM {name}_docs WHERE {several} OR filled)) / (1 + count(*))) + 1 AS idf
  FROM {name}_tf GROUP BY term),
{name}_weights AS (SELECT cluster_id, term, tf * idf AS weight FROM {name}_tf JOIN {name}_vocab USING (term)),
{name}_ranked AS (
  SELECT cluster_id, CAST(row_number() OVER (PARTITION BY cluster_id ORDER BY weight DESC, term DESC) AS INT) AS place, term,
    weight / sqrt(sum(weight * weight) OVER (PARTITION BY cluster_id)) AS score
  FROM {name}_weights),
{name} AS (
  SELECT d.cluster_id, coalesce(list(r.term ORDER BY r.place) FILTER (WHERE r.place <= {n}), []) AS seeds
  FROM {name}_docs d LEFT JOIN {name}_ranked r ON r.cluster_id = d.cluster_id GROUP BY d.cluster_id)"""


def _ordered_distinct(words: str) -> str:
    return f"list_filter({words}, lambda w, i: list_position({words}, w) = i)"


def _names(seeds: str, name: str) -> str:
    tokens = _tokens("array_to_string(seeds, ' ')")
    joined = f"array_to_string(({_ordered_distinct('tokens')})[1:4], '_')"
    tag = f"trim(replace(replace({joined}, '__', '_'), '--', ''), '_')"
    return f"""{name} AS (
  SELECT cluster_id, CASE WHEN tag = '' THEN 'unnamed' ELSE tag END AS tag FROM (
    SELECT cluster_id, {tag} AS tag FROM (SELECT cluster_id, {tokens} AS tokens FROM {seeds})))"""


def _gazetteer(seeds: str, best: str) -> str:
    title = f"regexp_replace(replace({_clean_html('lower(b.title)')}, 'disambiguation', ''), '^{WS}|{WS}$', '', 'g')"
    return f"""each AS (
  SELECT cluster_id, unnest(CASE WHEN len(seeds) = 0 THEN [NULL] ELSE seeds END) AS word,
    unnest(range(greatest(len(seeds), 1))) AS pos FROM {seeds}),
{best},
phrases AS (
  SELECT e.cluster_id, e.pos, CASE WHEN b.title IS NOT NULL THEN nullif({title}, '') END AS phrase FROM each e LEFT JOIN best b ON b.word = e.word),
top AS (
  SELECT *, row_number() OVER (PARTITION BY cluster_id
    ORDER BY coalesce({_num_words('phrase')}, 0) DESC, pos) AS place FROM phrases),
named AS (
  SELECT cluster_id, {_tag_format("coalesce(array_to_string(list(phrase ORDER BY place) FILTER (WHERE phrase IS NOT NULL), '_'), '')")} AS tag
  FROM top WHERE place <= 4 GROUP BY cluster_id)
SELECT cluster_id, CASE WHEN tag = '' THEN 'unnamed' ELSE tag END AS tag FROM named"""


SHORTEST = f"""best AS (
  SELECT word, title FROM (
    SELECT word, title, row_number() OVER (PARTITION BY word ORDER BY {_num_words('title')}, title) AS place FROM (
      SELECT title, unnest(list_distinct({_words('lower(title)')})) AS word FROM concepts)) WHERE place = 1)"""
RANKED = f"""known AS (SELECT title, {_words('lower(title)')} AS words FROM (SELECT DISTINCT title FROM concepts) WHERE len({_words('lower(title)')}) > 0),
usual AS (SELECT CAST(count(*) AS DOUBLE) AS titles, avg(len(words)) AS words FROM known),
postings AS (SELECT word, title, length, count(*) AS times
  FROM (SELECT title, len(words) AS length, unnest(words) AS word FROM known) GROUP BY ALL),
index AS (SELECT word, title, length,
    round(ln(1 + (u.titles - holders + 0.5) / (holders + 0.5)) * times * 2.2 / (times + 1.2 * (0.25 + 0.75 * length / u.words)), 9) AS score
  FROM (SELECT *, count(*) OVER (PARTITION BY word) AS holders FROM postings), usual u),
best AS (SELECT word, title, score FROM index QUALIFY row_number() OVER (PARTITION BY word ORDER BY score DESC, length, title) = 1)"""


def _prompt(request: str, heading: str, items: str) -> str:
    return f"{_text(request)} || chr(10) || chr(10) || '{heading}' || chr(10) || {items} || chr(10) || 'Topic:'"


LANGUAGE_TREE = """nodes AS (
  SELECT 'https://' || source || '.example.org/' || doc_id AS url, source AS site,
    ascii(lang) * 256 + ascii(lang[2:2]) AS id1, lang AS tag1,
    (ascii(lang) * 256 + ascii(lang[2:2])) * 10 + length(CAST(n_chars AS VARCHAR)) AS id2 FROM documents),
levels AS (SELECT CAST(1 AS INT) AS level, id1 AS cluster_id, url, site FROM nodes
  UNION ALL SELECT 2, id2, url, site FROM nodes)"""

CENTROIDS = """means AS (
  SELECT label, dimension, avg(x) AS value FROM (
    SELECT label, unnest(CAST(embedding AS DOUBLE[])) AS x, unnest(range(len(embedding))) AS dimension FROM embeddings)
  GROUP BY ALL)"""
CENTROID_LISTS = "middles AS (SELECT label, list(value ORDER BY dimension) AS c FROM means GROUP BY label)"



def _slices(rows: str, item: str, order: str) -> str:
    """``dealt(cluster_id, slice, items)``: all items of each cluster in slices of about ten."""
    return f"""spread AS (
  SELECT cluster_id, {item} AS item, {order} AS place, ('0x' || md5(CAST({order} AS VARCHAR))[1:8])::BIGINT
    % CAST(ceil(count(*) OVER (PARTITION BY cluster_id) / 10) AS BIGINT) AS slice FROM {rows}),
dealt AS (SELECT cluster_id, slice, list(item ORDER BY place) AS items FROM spread GROUP BY ALL)"""


TFIDF_LEAF = ",\n".join([POSTS, LEVEL2, _seeds("titles", "title", 4, "texts > 1", "leaf_seeds"), _names("leaf_seeds", "leaf_tags")])

# DuckDB counts edits in bytes: letters beyond ASCII become free upper-case letters first.
LETTERS = "translate({0}, 'áàâäãéèêëíîïñóôöúûüçß', 'ABCDEFGHIJKLMNOPQRSTU')"
LIKENESS = f"1 - levenshtein({LETTERS.format('lemma')}, {LETTERS.format('w')}) / greatest(length(lemma), length(w))"
OTHER_SEED = f"list_aggregate(list_transform(seeds, lambda w: {LIKENESS}), 'avg')"

def _reach(name: str, step: float) -> str:
    return f"""{name}_steps AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id
  AND list_distance(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) <= {step}),
{name}_reach AS (SELECT vec_id AS id, vec_id AS to_id FROM embeddings
  UNION SELECT r.id, s.b FROM {name}_reach r JOIN {name}_steps s ON s.a = r.to_id),
{name} AS (SELECT id, min(to_id) AS first FROM {name}_reach GROUP BY id)"""


# One merge per step: the closest pair of the clusters that are left.
WARD = """w AS (
  SELECT 0 AS step, min(vec_id) AS id, count(*) AS size, CAST(embedding AS DOUBLE[]) AS c,
    CAST(NULL AS BIGINT) AS absorbed, CAST(NULL AS DOUBLE) AS height
  FROM embeddings GROUP BY embedding
  UNION ALL
  SELECT w.step + 1, w.id, CASE WHEN w.id = p.l THEN p.sa + p.sb ELSE w.size END,
    CASE WHEN w.id = p.l THEN list_transform(p.ca, lambda x, i: (x * p.sa + p.cb[i] * p.sb) / (p.sa + p.sb)) ELSE w.c END,
    CASE WHEN w.id = p.l THEN p.r END, CASE WHEN w.id = p.l THEN p.h END
  FROM w, (
    SELECT a.id AS l, b.id AS r, a.c AS ca, b.c AS cb, a.size AS sa, b.size AS sb,
      sqrt(2.0 * a.size * b.size / (a.size + b.size)) * list_distance(a.c, b.c) AS h
    FROM w a JOIN w b ON a.id < b.id ORDER BY h, l, r LIMIT 1) p
  WHERE w.id <> p.r),
merges AS (SELECT id AS "left", absorbed AS "right", height, size FROM w WHERE absorbed IS NOT NULL)"""


def _cut(name: str, at: float) -> str:
    """``name(id, root)``: every leaf follows its merges up to the height."""
    return f"""{name}_up AS (
  SELECT 0 AS step, min(vec_id) AS id, min(vec_id) AS root FROM embeddings GROUP BY embedding
  UNION ALL
  SELECT u.step + 1, u.id, m."left" FROM {name}_up u JOIN merges m ON m."right" = u.root AND m.height <= {at}),
{name} AS (SELECT id, arg_max(root, step) AS root FROM {name}_up GROUP BY id)"""


def _central(rows: str, title: str, name: str) -> str:
    """``name(cluster_id, tag)`` by ten rounds of PageRank over words side by side in the titles of ``rows``."""
    n = name
    rounds = "".join(
        f""",
{n}_r{i} AS (SELECT w.cluster_id, w.word, 0.15::DOUBLE + 0.85::DOUBLE * coalesce(p.got, 0) AS rank FROM {n}_words w LEFT JOIN (
  SELECT s.cluster_id, s.other AS word, sum(s.share * r.rank) AS got FROM {n}_shares s
  JOIN {n}_r{i - 1} r ON r.cluster_id = s.cluster_id AND r.word = s.word GROUP BY ALL) p
  ON p.cluster_id = w.cluster_id AND p.word = w.word)"""
        for i in range(1, 11)
    )
    return f"""{n}_worded AS (SELECT cluster_id, seq, {title} AS title, {_words(f"lower(replace({title}, '_', ' '))")} AS ws FROM {rows}),
{n}_sides AS (SELECT cluster_id, unnest(ws[1:len(ws) - 1]) AS a, unnest(ws[2:len(ws)]) AS b FROM {n}_worded WHERE len(ws) > 1),
{n}_edges AS (SELECT cluster_id, word, other, count(*) AS weight FROM (
  SELECT cluster_id, a AS word, b AS other FROM {n}_sides WHERE a <> b
  UNION ALL SELECT cluster_id, b, a FROM {n}_sides WHERE a <> b) GROUP BY ALL),
{n}_shares AS MATERIALIZED (SELECT cluster_id, word, other, weight / sum(weight) OVER (PARTITION BY cluster_id, word) AS share FROM {n}_edges),
{n}_words AS MATERIALIZED (SELECT DISTINCT cluster_id, unnest(ws) AS word FROM {n}_worded),
{n}_r0 AS (SELECT cluster_id, word, 1.0::DOUBLE AS rank FROM {n}_words){rounds},
{n}_scored AS (SELECT e.cluster_id, e.seq, e.title, round(avg(r.rank), 9) AS score
  FROM (SELECT cluster_id, seq, title, unnest(ws) AS word FROM {n}_worded) e JOIN {n}_r10 r USING (cluster_id, word) GROUP BY ALL),
{n}_best AS (SELECT * FROM {n}_scored QUALIFY row_number() OVER (PARTITION BY cluster_id ORDER BY score DESC, seq, title) = 1),
{n} AS (SELECT c.cluster_id, coalesce(nullif({CENTRAL_TAG}, ''), 'unnamed') AS tag
  FROM (SELECT DISTINCT cluster_id FROM {n}_worded) c LEFT JOIN {n}_best b USING (cluster_id))"""


def _sweep(distance: str) -> str:
    """25 cuts between the lowest and the highest merge, with the mean silhouette by a pair's distance."""
    return f"""ends AS (SELECT min(height) AS low, max(height) AS high FROM merges WHERE height > 0),
cuts AS (SELECT i, CASE i WHEN 0 THEN low WHEN 24 THEN high ELSE power(10, log10(low) + (log10(high) - log10(low)) * i / 24) END AS at
  FROM ends, range(25) r(i)),
points AS (SELECT min(vec_id) AS id, count(*) AS size, CAST(embedding AS DOUBLE[]) AS v FROM embeddings GROUP BY embedding),
up AS (
  SELECT 0 AS step, c.i, c.at, p.id, p.id AS root FROM points p, cuts c
  UNION ALL
  SELECT u.step + 1, u.i, u.at, u.id, m."left" FROM up u JOIN merges m ON m."right" = u.root AND m.height <= u.at),
labelled AS (SELECT i, id, arg_max(root, step) AS root FROM up GROUP BY i, id),
kept AS (SELECT i, count(DISTINCT root) AS n FROM labelled GROUP BY i
  HAVING n > 1 AND n < (SELECT count(*) FROM embeddings)),
pairs AS (SELECT a.id, b.id AS other, a.size, b.size AS others, {distance} AS d FROM points a, points b),
sums AS (SELECT k.i, p.id, any_value(p.size) AS size, o.root = s.root AS own, sum(p.others) AS n, sum(p.others * p.d) AS total
  FROM kept k JOIN labelled s USING (i) JOIN pairs p ON p.id = s.id JOIN labelled o ON o.i = k.i AND o.id = p.other
  GROUP BY k.i, p.id, s.root, o.root),
sides AS (SELECT i, id, any_value(size) AS size, max(CASE WHEN n > 1 THEN total / (n - 1) END) FILTER (WHERE own) AS a,
    min(total / n) FILTER (WHERE NOT own) AS b FROM sums GROUP BY i, id)
SELECT round(any_value(c.at), 6) AS distance, any_value(k.n) AS n_clusters,
  round(sum(s.size * CASE WHEN a IS NULL OR greatest(a, b) = 0 THEN 0 ELSE (b - a) / greatest(a, b) END) / sum(s.size), 3) AS silhouette
FROM sides s JOIN cuts c USING (i) JOIN kept k USING (i) GROUP BY s.i"""


REPLY_WORDS = _squeeze(r"regexp_replace(topic, '[^\p{L}\p{N}_" + WS_BODY + "-]', '', 'g')")
CENTRAL_TAG = _tag_format(_first_words("replace(title, '_', ' ')", 6))

ORACLE_SQL = {
    "site_of_url": f"SELECT page_id, regexp_extract(url, '{SITE}', 1) AS site FROM pages",
    "drop_dev_sites": f"""SELECT * FROM (SELECT page_id, regexp_extract(url, '{SITE}', 1) AS site FROM pages)
WHERE NOT regexp_matches(site, '{"|".join(DEV_SITE_PATTERNS)}')""",
    "year_predicates": f"""WITH {POSTS} SELECT seq, CAST(date[1:4] AS INT) AS year_published, {_has_2010s('title')} AS is_2010s,
{_has_1900s('title')} AS is_1900s, {_recent('CAST(date[1:4] AS INT)', 'title')} AS is_recent FROM posts""",
    "recent_posts": f"WITH {PAGES}, {RECENT} SELECT seq, url, site, title, year_published FROM recent",
    "clean_pages": f"SELECT page_id, {_clean_html('html')} AS text FROM pages",
    "first_n_words": f"SELECT doc_id, {_first_words('text', 1000)} AS text FROM documents",
    "word_count": f"SELECT doc_id, {_num_words('text')} AS text_length FROM documents",
    "article_text": f"""WITH {POSTS} SELECT seq, {_squeeze(_clean_html("title || ' ' || text"))} AS embedding_text FROM posts""",
    "dedupe_keep_first": f"""WITH {POSTS},
a AS (SELECT * FROM posts QUALIFY row_number() OVER (PARTITION BY title ORDER BY seq) = 1),
b AS (SELECT * FROM a QUALIFY row_number() OVER (PARTITION BY url ORDER BY seq) = 1),
c AS (SELECT * FROM b WHERE {_num_words('text')} > 20)
SELECT seq, title, url FROM c QUALIFY row_number() OVER (PARTITION BY text ORDER BY seq) = 1""",
    "clean_posts": f"""WITH {PAGES}, {RECENT},
a AS (SELECT * FROM recent QUALIFY row_number() OVER (PARTITION BY title ORDER BY seq) = 1),
b AS (SELECT * FROM a QUALIFY row_number() OVER (PARTITION BY url ORDER BY seq) = 1),
c AS (SELECT seq, url, site, title, year_published, {_squeeze(_clean_html('text'))} AS text FROM b),
d AS (SELECT *, {_num_words('text')} AS text_length FROM c)
SELECT seq, url, site, title, text, year_published, text_length FROM d WHERE text <> '' AND text_length > 20
QUALIFY row_number() OVER (PARTITION BY text ORDER BY seq) = 1""",
    "union_sources": f"""WITH {POSTS}, {PAGES}
SELECT id, url, date, regexp_extract(url, '{SITE}', 1) AS site, NULL AS title FROM page_posts
UNION ALL SELECT id, url, date, NULL, title FROM posts""",
    "cap_per_site": f"""WITH {POSTS} SELECT seq, site, url FROM posts
QUALIFY row_number() OVER (PARTITION BY site ORDER BY seq) <= 7""",
    "numbered_rows": "SELECT url, page_id, row_number() OVER (ORDER BY url COLLATE \"C\", page_id) - 1 AS seq FROM pages",
    "title_words": f"""WITH {POSTS} SELECT seq, array_to_string({_keyword_words('title')}, ' ') AS keywords,
array_to_string({_tokens('title')}, ' ') AS tokens,
array_to_string({_without(_tokens('title'), INSIGNIFICANT_WORDS)}, ' ') AS significant,
array_to_string(list_filter({_tokens('title')}, lambda w: NOT regexp_matches(w, '\\p{{Nd}}')), ' ') AS without_digits FROM posts""",
    "clean_title_terms": f"""WITH {POSTS}, {LEXICON},
each AS (SELECT seq, unnest(ws) AS word, unnest(range(len(ws))) AS pos FROM (SELECT seq, {_tokens('title')} AS ws FROM posts)),
lemmas AS (SELECT word, lemma FROM lexicon WHERE sense_rank = 1),
changed AS (SELECT seq, pos, coalesce(lemma, word) AS word FROM each LEFT JOIN lemmas USING (word))
SELECT p.seq, coalesce(string_agg(c.word, ' ' ORDER BY c.pos) FILTER (WHERE c.word IS NOT NULL
  AND NOT list_contains({_list(INSIGNIFICANT_WORDS)}, c.word) AND NOT regexp_matches(c.word, '\\p{{Nd}}')), '') AS words
FROM posts p LEFT JOIN changed c ON c.seq = p.seq GROUP BY p.seq""",
    "tag_formats": f"""WITH {POSTS} SELECT seq, {_tag_format('title')} AS tag,
array_to_string({_tag_words(_tag_format('title'))}, ' ') AS parts,
{_squeeze("replace(text, '_', ' ')")} AS summary_input,
{_strip(f"replace({_clean_html('lower(title)')}, 'disambiguation', '')")} AS candidate FROM posts""",
    "parse_reply": f"""WITH a AS (SELECT doc_id,
  {_strip(f"split_part(split_part(split_part({_strip('text')}, chr(10), 1), '.', 1), ',', 1)")} AS topic FROM documents),
b AS (SELECT *, lower({REPLY_WORDS}) AS plain FROM a)
SELECT doc_id, topic, CASE WHEN topic = '' THEN 'unknown_topic' WHEN plain = '' THEN 'general_topic'
  ELSE array_to_string(string_split(plain, ' ')[1:3], '_') END AS tag FROM b""",
    "leaf_prompts": f"""WITH {POSTS}, {LEVEL2}, {_slices('titles', 'title', 'seq')}
SELECT cluster_id, slice, {_prompt('Name the common topic of these article titles in two to four words.', 'Titles:', "array_to_string(items, '. ' || chr(10))")} AS prompt FROM dealt""",
    "parent_prompts": f"""WITH {TFIDF_LEAF}, {_children('leaf_tags')},
named AS (SELECT DISTINCT cluster_id, tag FROM children), {_slices('named', 'tag', 'tag')}
SELECT cluster_id, slice, {_prompt('Name the broader topic that covers all of these tags in two to four words.', 'Tags:', "array_to_string(items, ', ' || chr(10))")} AS prompt FROM dealt""",
    "keyword_counts": f"WITH {POSTS}, {LEVEL2}, {_word_counts('titles', _keyword_words('title'), 'counts')} SELECT cluster_id, word, count, first_place.seq AS first_seq, CAST(first_place.pos AS INT) AS first_pos FROM counts",
    "keyword_tags_leaf": f"WITH {LEAF_CANDIDATES} SELECT cluster_id, array_to_string(candidates, ' ') AS candidates FROM leaf_cand",
    "parent_keyword_tags": f"""WITH {LEAF_CANDIDATES},
first_tags AS (SELECT cluster_id, candidates[1] AS tag FROM leaf_cand WHERE candidates IS NOT NULL), {_children('first_tags')},
{_word_counts('children', _tag_words('tag'), 'parent_counts')}, {_candidates('parent_counts', [1, 3, 4, 5, 6], 'parent_cand')}
SELECT cluster_id, array_to_string(candidates, ' ') AS candidates FROM parent_cand""",
    "unique_tags": f"""WITH RECURSIVE {KEYWORD_TAGS}
SELECT CAST(2 AS INT) AS level, cluster_id, tag FROM leaf_tags UNION ALL SELECT 1, cluster_id, tag FROM parent_tags""",
    "tfidf_seeds": f"""WITH {POSTS}, {LEVEL2}, {_seeds('titles', 'title', 5, 'texts > 1')}
SELECT cluster_id, place, term, round(score, 6) AS score FROM seeds_ranked WHERE place <= 5""",
    "tfidf_tags_leaf": f"WITH {TFIDF_LEAF} SELECT cluster_id, tag FROM leaf_tags",
    "tfidf_tags_parent": f"""WITH {TFIDF_LEAF}, {_children('leaf_tags')},
{_seeds('children', 'tag', 4, 'false', 'parent_seeds')}, {_names('parent_seeds', 'parent_tags')}
SELECT cluster_id, tag FROM parent_tags""",
    "gazetteer_tags": f"WITH {POSTS}, {LEVEL2}, {CONCEPTS}, {_seeds('titles', 'title', 5, 'texts > 1')}, {_gazetteer('seeds', SHORTEST)}",
    "gazetteer_tags_parent": f"""WITH {POSTS}, {LEVEL1}, {CONCEPTS},
different AS (SELECT DISTINCT cluster_id, title FROM titles), {_seeds('different', 'title', 5, 'false')}, {_gazetteer('seeds', SHORTEST)}""",
    "gazetteer_tags_ranked": f"WITH {POSTS}, {LEVEL2}, {CONCEPTS}, {_seeds('titles', 'title', 5, 'texts > 1')}, {_gazetteer('seeds', RANKED)}",
    "ranked_titles": f"""WITH {POSTS}, {CONCEPTS}, {RANKED}
SELECT word, title, round(score, 6) AS score FROM best
WHERE word IN (SELECT unnest({_words('lower(title)')}) FROM posts)""",
    "title_search": f"""WITH {POSTS}, {CONCEPTS}, {RANKED},
asked AS (SELECT DISTINCT seq AS query_id, unnest({_words('lower(title)')}) AS word FROM posts),
sums AS (SELECT query_id, title, length, round(sum(score), 9) AS score FROM asked JOIN index USING (word) GROUP BY ALL)
SELECT query_id, title, round(score, 6) AS score FROM sums
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY sums.score DESC, length, title) = 1""",
    "hypernym_tags": f"""WITH {POSTS}, {LEVEL2}, {LEXICON}, {_seeds('titles', 'title', 5, 'texts > 1')},
broader AS (SELECT DISTINCT word, lemma FROM lexicon WHERE sense_rank = 1),
cand AS (SELECT DISTINCT s.cluster_id, s.seeds, b.lemma FROM (SELECT cluster_id, seeds, unnest(seeds) AS word FROM seeds) s
  JOIN broader b USING (word)),
scored AS (SELECT cluster_id, lemma, round({OTHER_SEED}, 9) AS score FROM cand),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY cluster_id ORDER BY score DESC, lemma) AS INT) AS place FROM scored)
SELECT cluster_id, lemma, round(score, 6) AS score, place FROM ranked WHERE place <= 10""",
    "central_title_tags": f"""WITH {POSTS}, {EMBEDDED},
dims AS (SELECT topic_level_2_cluster_id AS cluster_id, unnest(v) AS x, unnest(range(len(v))) AS i FROM embedded),
middle AS (SELECT cluster_id, list(m ORDER BY i) AS c FROM (SELECT cluster_id, i, avg(x) AS m FROM dims GROUP BY ALL) GROUP BY cluster_id),
near AS (SELECT e.topic_level_2_cluster_id AS cluster_id, e.seq, e.title, round(list_distance(e.v, m.c), 9) AS distance
  FROM embedded e JOIN middle m ON m.cluster_id = e.topic_level_2_cluster_id),
best AS (SELECT * FROM near QUALIFY row_number() OVER (PARTITION BY cluster_id ORDER BY distance, seq) = 1)
SELECT cluster_id, title, {CENTRAL_TAG} AS tag,
  round(distance, 6) AS distance FROM best""",
    "centrality_tags_leaf": f"WITH {POSTS}, {LEVEL2}, {_central('titles', 'title', 'leaf_tags')} SELECT cluster_id, tag FROM leaf_tags",
    "centrality_tags_parent": f"""WITH {POSTS}, {LEVEL2}, {_central('titles', 'title', 'leaf_tags')}, {_children('leaf_tags')},
{_central('children', 'tag', 'parent_tags')} SELECT cluster_id, tag FROM parent_tags""",
    "review": f"WITH RECURSIVE {KEYWORD_TAGS} {REVIEW.format(where=WHOLE)}",
    "review_rollup": f"""WITH RECURSIVE {KEYWORD_TAGS} SELECT {IDS}, {TAGS}, count(DISTINCT url) AS url_count FROM tagged
WHERE {WHOLE} GROUP BY GROUPING SETS (({IDS}, {TAGS}), (topic_level_1_cluster_id, topic_level_1))""",
    "review_subset": f"WITH RECURSIVE {KEYWORD_TAGS} {REVIEW.format(where=WHOLE + ' AND topic_level_1_cluster_id IN (1, 3)')}",
    "titles_in_cluster": f"WITH RECURSIVE {KEYWORD_TAGS} SELECT title, topic_level_2 FROM tagged WHERE topic_level_2_cluster_id = 3",
    "rename_cluster": f"""WITH RECURSIVE {KEYWORD_TAGS} SELECT seq, topic_level_2_cluster_id,
CASE WHEN topic_level_2_cluster_id = 3 THEN 'chosen_name' ELSE topic_level_2 END AS topic_level_2 FROM tagged""",
    "rename_clusters": f"""WITH RECURSIVE {KEYWORD_TAGS} SELECT seq, topic_level_2_cluster_id,
CASE WHEN topic_level_2_cluster_id % 2 = 0 THEN 'new_' || site ELSE topic_level_2 END AS topic_level_2 FROM tagged""",
    "topic_paths": f"""WITH RECURSIVE {KEYWORD_TAGS},
tree AS (SELECT DISTINCT {IDS}, {TAGS} FROM tagged)
SELECT e.vec_id, e.label + 1 AS topic_level_2_cluster_id, t.topic_level_1_cluster_id, t.topic_level_1 || ' > ' || t.topic_level_2 AS topic_path
FROM embeddings e LEFT JOIN tree t ON t.topic_level_2_cluster_id = e.label + 1""",
    "parents_of": f"""WITH {POSTS}, tree AS (SELECT DISTINCT {IDS} FROM posts)
SELECT e.vec_id, CAST(t.topic_level_1_cluster_id AS VARCHAR) AS parents
FROM embeddings e LEFT JOIN tree t ON t.topic_level_2_cluster_id = e.label + 1""",
    "tag_overlap": f"""WITH RECURSIVE {KEYWORD_TAGS},
nodes AS (SELECT DISTINCT CAST(1 AS INT) AS level, topic_level_1_cluster_id AS cluster_id, topic_level_1 AS tag FROM tagged
  UNION SELECT DISTINCT 2, topic_level_2_cluster_id, topic_level_2 FROM tagged),
words AS (SELECT DISTINCT level, cluster_id, unnest({_tag_words('tag')}) AS word FROM nodes),
users AS (SELECT level, word, count(*) AS users FROM words GROUP BY ALL),
lapping AS (SELECT level, count(DISTINCT cluster_id) AS n FROM words JOIN users USING (level, word) WHERE users > 1 GROUP BY level)
SELECT n.level, count(*) AS tags, coalesce(any_value(l.n), 0) AS overlapping_tags,
  (SELECT count(*) FROM users u WHERE u.level = n.level AND u.users > 1) AS shared_words,
  coalesce((SELECT max(users) FROM users u WHERE u.level = n.level), 0) AS most_shared
FROM nodes n LEFT JOIN lapping l ON l.level = n.level GROUP BY n.level""",
    "similar_tags": f"""WITH RECURSIVE {KEYWORD_TAGS},
nodes AS (SELECT DISTINCT CAST(1 AS INT) AS level, topic_level_1_cluster_id AS cluster_id, topic_level_1 AS tag FROM tagged
  UNION SELECT DISTINCT 2, topic_level_2_cluster_id, topic_level_2 FROM tagged),
classes AS (SELECT level, words, min(cluster_id) AS id, count(*) AS members
  FROM (SELECT level, cluster_id, list_sort(list_distinct({_tag_words('tag')})) AS words FROM nodes) WHERE len(words) > 0 GROUP BY ALL),
pairs AS (SELECT a.level, a.id AS "first", b.id AS other, a.members AS first_clusters, b.members AS other_clusters,
    len(list_intersect(a.words, b.words)) AS shared, len(a.words) + len(b.words) AS sizes
  FROM classes a JOIN classes b ON a.level = b.level AND (a.id < b.id OR a.id = b.id AND a.members > 1))
SELECT level, "first", other, first_clusters, other_clusters, round(shared / (sizes - shared), 6) AS similarity
FROM pairs WHERE 100 * shared >= 20 * (sizes - shared)""",
    "similar_titles": f"""WITH {POSTS},
classes AS (SELECT site, words, min(seq) AS id
  FROM (SELECT site, seq, list_sort(list_distinct({_words('lower(title)')})) AS words FROM posts) WHERE len(words) > 0 GROUP BY ALL),
pairs AS (SELECT a.site, a.id AS "first", b.id AS other, CAST(len(list_intersect(a.words, b.words)) AS INT) AS shared,
    len(a.words) + len(b.words) AS sizes FROM classes a JOIN classes b ON a.site = b.site AND a.id < b.id)
SELECT site, "first", other, shared, CAST(sizes - shared AS INT) AS total FROM pairs WHERE 100 * shared >= 60 * (sizes - shared)""",
    "size_distribution": f"""WITH {LANGUAGE_TREE},
sizes AS (SELECT level, cluster_id, count(DISTINCT url) AS n FROM levels GROUP BY ALL),
moments AS (SELECT level, count(*) AS clusters, avg(n) AS mean_urls, stddev_samp(n) AS stddev_urls,
  avg(power(n - m, 2)) AS m2, avg(power(n - m, 3)) AS m3, avg(power(n - m, 4)) AS m4
  FROM (SELECT level, CAST(n AS DOUBLE) AS n, avg(n) OVER (PARTITION BY level) AS m FROM sizes) GROUP BY level)
SELECT level, clusters, round(mean_urls, 6) AS mean_urls, round(stddev_urls, 6) AS stddev_urls,
  round(m3 / power(m2, 1.5), 6) AS skewness, round(m4 / (m2 * m2) - 3, 6) AS kurtosis FROM moments""",
    "site_coverage": f"""WITH {LANGUAGE_TREE},
sites AS (SELECT level, cluster_id, count(DISTINCT site) AS n FROM levels GROUP BY ALL)
SELECT level, count(*) AS clusters, count(*) FILTER (WHERE n > 1) AS shared_clusters, round(avg(n), 6) AS mean_sites FROM sites GROUP BY level""",
    "nearest_neighbour": """WITH pairs AS (
  SELECT a.vec_id AS id, b.vec_id AS neighbour, list_distance(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) AS distance
  FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id)
SELECT id, neighbour, round(distance, 6) AS distance FROM pairs
QUALIFY row_number() OVER (PARTITION BY id ORDER BY distance, neighbour) = 1""",
    "silhouette": """WITH pairs AS (
  SELECT a.vec_id AS id, a.label AS own, b.label AS other,
    avg(list_distance(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[]))) AS mean_distance
  FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id GROUP BY ALL),
sides AS (SELECT id, max(mean_distance) FILTER (WHERE own = other) AS a, min(mean_distance) FILTER (WHERE own <> other) AS b FROM pairs GROUP BY id)
SELECT round(avg(CASE WHEN a IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette FROM sides""",
    "silhouette_squared": """WITH pairs AS (
  SELECT a.vec_id AS id, a.label AS own, b.label AS other,
    avg(power(list_distance(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 2)) AS mean_square
  FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id GROUP BY ALL),
sides AS (SELECT id, max(mean_square) FILTER (WHERE own = other) AS a, min(mean_square) FILTER (WHERE own <> other) AS b FROM pairs GROUP BY id)
SELECT round(avg(CASE WHEN a IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette FROM sides""",
    "ward_merges": f"""WITH RECURSIVE {WARD}
SELECT "left", "right", round(height, 6) AS height, size FROM merges""",
    "dendrogram": f"""WITH RECURSIVE {WARD},
grown AS (SELECT "left" AS id, arg_max(-"right" - 1, size) AS node FROM merges GROUP BY "left")
SELECT coalesce(lag(-m."right" - 1) OVER (PARTITION BY m."left" ORDER BY m.size), m."left") AS "left",
  coalesce(g.node, m."right") AS "right", -m."right" - 1 AS parent, round(m.height, 6) AS height, m.size
FROM merges m LEFT JOIN grown g ON m."right" = g.id""",
    "leaf_order": f"""WITH RECURSIVE {WARD},
grown AS (SELECT "left" AS id, arg_max(-"right" - 1, size) AS node FROM merges GROUP BY "left"),
nodes AS (SELECT coalesce(lag(-m."right" - 1) OVER (PARTITION BY m."left" ORDER BY m.size), m."left") AS "left",
  coalesce(g.node, m."right") AS "right", -m."right" - 1 AS parent, m.size FROM merges m LEFT JOIN grown g ON m."right" = g.id),
leaves AS (SELECT min(vec_id) AS id, count(*) AS size FROM embeddings GROUP BY embedding),
sizes AS (SELECT parent AS node, size FROM nodes UNION ALL SELECT id, size FROM leaves),
branches AS (SELECT parent, "left" AS node, 0 AS way FROM nodes
  UNION ALL SELECT n.parent, n."right", s.size FROM nodes n JOIN sizes s ON s.node = n."left"),
walk AS (SELECT parent AS node, CAST(0 AS BIGINT) AS place FROM nodes WHERE parent NOT IN (SELECT node FROM branches)
  UNION ALL SELECT b.node, w.place + b.way FROM walk w JOIN branches b ON b.parent = w.node)
SELECT node AS id, place FROM walk WHERE node >= 0""",
    "cut_levels": f"""WITH RECURSIVE {WARD}, {_cut('coarse', 2.5)}, {_cut('fine', 2.0)},
leaf_of AS (SELECT vec_id AS seq, min(vec_id) OVER (PARTITION BY embedding) AS id FROM embeddings)
SELECT seq, CAST(dense_rank() OVER (ORDER BY c.root) AS INT) AS topic_level_1_cluster_id,
  CAST(dense_rank() OVER (ORDER BY f.root) AS INT) AS topic_level_2_cluster_id
FROM leaf_of JOIN coarse c USING (id) JOIN fine f USING (id)""",
    "cluster_counts": f"""WITH RECURSIVE {WARD}, {_cut('coarse', 2.5)}, {_cut('fine', 2.0)}
SELECT CAST(2.5 AS DOUBLE) AS distance, count(DISTINCT root) AS n_clusters FROM coarse
UNION ALL SELECT 2.0, count(DISTINCT root) FROM fine""",
    "sweep": f"WITH RECURSIVE {WARD}, {_sweep('list_distance(a.v, b.v)')}",
    "sweep_squared": f"WITH RECURSIVE {WARD}, {_sweep('power(list_distance(a.v, b.v), 2)')}",
    "single_linkage": f"""WITH RECURSIVE {_reach('fine', 1.0)}, {_reach('coarse', 1.15)}
SELECT id, CAST(dense_rank() OVER (ORDER BY c.first) AS INT) AS topic_level_1_cluster_id,
  CAST(dense_rank() OVER (ORDER BY f.first) AS INT) AS topic_level_2_cluster_id FROM coarse c JOIN fine f USING (id)""",
    "centroids": f"WITH {CENTROIDS} SELECT label, CAST(dimension AS INT) AS dimension, round(value, 6) AS value FROM means",
    "nearest_centroid": f"""WITH {CENTROIDS}, {CENTROID_LISTS},
pairs AS (SELECT e.vec_id AS id, e.label, m.label AS nearest, list_distance(CAST(e.embedding AS DOUBLE[]), m.c) AS distance
  FROM embeddings e CROSS JOIN middles m)
SELECT id, label, CAST(nearest AS BIGINT) AS nearest, round(distance, 6) AS distance FROM pairs
QUALIFY row_number() OVER (PARTITION BY id ORDER BY distance, nearest) = 1""",
    "projected_posts": f"""WITH {POSTS},
words AS (SELECT seq, unnest({_words("lower(" + _squeeze(_clean_html("title || ' ' || text")) + ")")}) AS word FROM posts),
times AS (SELECT seq, word, count(*) AS times FROM words GROUP BY ALL),
idf AS (SELECT word, ln(((SELECT count(*) FROM posts) + 1) / (count(*) + 1)) AS idf FROM times GROUP BY word),
spelt AS (SELECT word, idf, md5(word || ':0') || md5(word || ':1') || md5(word || ':2') || md5(word || ':3') AS digits FROM idf),
directions AS (SELECT word, idf, list_transform(range(512), lambda i:
    2 * ((CAST('0x' || digits[i // 4 + 1] AS INT) >> (3 - i % 4)) & 1) - 1) AS signs FROM spelt),
each AS (SELECT seq, unnest(range(512)) AS dimension, unnest(signs) AS sign, times * idf AS weight FROM times JOIN directions USING (word)),
sums AS (SELECT seq, dimension, sum(sign * weight) AS x FROM each GROUP BY ALL),
lengths AS (SELECT seq, sqrt(sum(x * x)) AS length FROM sums GROUP BY seq)
SELECT p.seq, CAST(d.dimension AS INT) AS dimension,
  round(CAST(CAST(coalesce(CASE WHEN length > 0 THEN x / length END, 0) AS FLOAT) AS DOUBLE), 4) AS value
FROM posts p CROSS JOIN (SELECT unnest(range(512)) AS dimension) d
LEFT JOIN sums s ON s.seq = p.seq AND s.dimension = d.dimension LEFT JOIN lengths l ON l.seq = p.seq""",
    "split_stratified": f"""WITH {POSTS},
ranked AS (SELECT seq, url, topic_level_2_cluster_id,
  row_number() OVER (PARTITION BY topic_level_2_cluster_id ORDER BY md5('0' || url), url) AS place,
  round(0.2 * count(*) OVER (PARTITION BY topic_level_2_cluster_id)) AS quota FROM posts WHERE topic_level_2_cluster_id IS NOT NULL)
SELECT seq, url, topic_level_2_cluster_id, place <= quota AS is_test FROM ranked""",
    "json_round_trip": f"WITH {POSTS} SELECT text, title, url, date, id FROM posts",
    "csv_round_trip": f"WITH {POSTS} SELECT text, title, url, date, id FROM posts",
    "first_rows": f"WITH {POSTS} SELECT seq, url FROM posts ORDER BY seq LIMIT 20",
    "stream_republished": f"SELECT DISTINCT regexp_extract(url, '{SITE}', 1) AS url FROM pages",
    "stream_clean": f"""WITH {PAGES},
{RECENT},
c AS (SELECT seq, site, title, {_squeeze(_clean_html('text'))} AS text, year_published FROM recent),
d AS (SELECT *, {_num_words('text')} AS text_length FROM c)
SELECT seq, site, title, text, year_published, text_length FROM d WHERE text <> '' AND text_length > 20""",
}

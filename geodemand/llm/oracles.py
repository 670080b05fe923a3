"""DuckDB SQL for the text queries that SQL can express over whole tables."""

from __future__ import annotations

from .divergence import DIGIT, POINTS, SYMBOLS, UPPER, QualitySpec
from .template_decontam import NAME, NUMBER, TOKEN, UNIT, UNITS, TemplateSpec

SPACES = "[ \\t\\n\\x0B\\f\\r]+"


def _words(text: str) -> str:
    return f"list_filter(regexp_split_to_array(ifnull({text}, ''), '{SPACES}'), lambda w: w <> '')"


#: All pairs that share a 3-gram, counted; then everything that links reach.
NGRAM_JOIN = f"""
WITH RECURSIVE found AS (
  SELECT doc_id, {_words("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
         ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS grams
  FROM found),
grams AS (SELECT doc_id, len(grams) AS n, unnest(grams) AS gram FROM sets),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM grams a JOIN grams b ON a.gram = b.gram AND a.doc_id < b.doc_id
  WHERE 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
reach AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION
  SELECT reach.doc_id, l.y FROM reach JOIN (SELECT x, y FROM links UNION ALL SELECT y, x FROM links) l ON l.x = reach.other)
SELECT s.doc_id, CAST(len(s.grams) AS BIGINT) AS n_shingles, r.component_id
FROM sets s JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) r USING (doc_id)
"""


def quality(spec: QualitySpec = QualitySpec()) -> str:
    q = "'"
    classes = ["plain", "upper", "digit", "point", "symbol", "other"]
    term = lambda p, r: f"(CASE WHEN {p} > 0 THEN {p} * log2(2 * {p} / ({p} + {r})) ELSE 0 END + CASE WHEN {r} > 0 THEN {r} * log2(2 * {r} / ({p} + {r})) ELSE 0 END) / 2"
    shares = ["space", "lower", *classes[1:]]
    class_terms = " + ".join(term(f"c.{k} / c.total", f"r.{k}") for k in shares)
    return f"""
WITH texts AS (
  SELECT doc_id, lang, ifnull(text, '') AS text, {_words("text")} AS w,
         regexp_replace(ifnull(text, ''), '[\\p{{Ll}} \\t\\n\\x0B\\f\\r]+', '', 'g') AS rest
  FROM documents),
base AS (
  SELECT *, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars, length(rest) - length(translate(rest, '{SYMBOLS}', '')) AS n_symbols,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^ \\t\\n\\x0B\\f\\r]')) AS filled
  FROM texts),
windows AS (
  SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM base)),
repeats AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1), range(3) t(k) GROUP BY doc_id),
counted AS (
  SELECT doc_id, lang, length(text) - word_chars AS space, length(text) - length(rest) - (length(text) - word_chars) AS lower,
         length(rest) - length(regexp_replace(rest, '{UPPER}', '', 'g')) AS upper, length(rest) - length(regexp_replace(rest, '{DIGIT}', '', 'g')) AS digit,
         length(rest) - length(translate(rest, '{POINTS.replace(q, q + q)}', '')) AS point, n_symbols AS symbol, length(text) AS chars, length(rest) AS rests, n_words
  FROM base),
classes AS (SELECT *, rests - upper - digit - point - symbol AS other, nullif(chars, 0)::DOUBLE AS total FROM counted),
langs AS (
  SELECT * FROM (
    SELECT *, n >= {spec.min_share} * sum(n) OVER () AS wide FROM (
      SELECT lang, sum(n_words) AS n, {", ".join(f"sum({k}) / sum(chars) AS {k}" for k in shares)} FROM classes WHERE lang IS NOT NULL GROUP BY lang))
  WHERE n >= {spec.min_ref_words}),
spoken AS (SELECT doc_id, lang, unnest(list_transform(w, lambda x: lower(x))) AS word FROM base),
ranked AS (
  SELECT lang, word, count(*) AS n FROM spoken SEMI JOIN langs USING (lang) GROUP BY lang, word),
common AS (
  SELECT ranked.lang, word, wide, ranked.n / langs.n AS r FROM ranked JOIN langs USING (lang) WHERE ranked.n >= langs.n * {spec.min_word_share}
  QUALIFY row_number() OVER (PARTITION BY ranked.lang ORDER BY ranked.n DESC, word) <= {spec.common_words}),
mine AS (SELECT doc_id, word, count(*) AS k FROM spoken GROUP BY doc_id, word),
near AS (
  SELECT b.doc_id, c.lang, sum(ifnull(m.k, 0)) / b.n_words AS p, sum({term("ifnull(m.k, 0) / b.n_words", "c.r")}) AS jsd, 1 - sum(c.r) AS q
  FROM base b JOIN common c ON c.wide OR c.lang = b.lang LEFT JOIN mine m ON m.doc_id = b.doc_id AND m.word = c.word WHERE b.n_words > 0 GROUP BY b.doc_id, c.lang, b.n_words),
spread AS (SELECT doc_id, lang, sqrt(greatest(0, jsd + {term("greatest(0, 1 - p)", "greatest(0, q)")})) AS words_jsd FROM near),
best AS (SELECT doc_id, lang, words_jsd FROM spread QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY words_jsd, lang) = 1),
judged AS (
  SELECT c.doc_id, CASE WHEN c.n_words >= {spec.min_words} THEN words_jsd END AS a,
         CASE WHEN c.chars >= {spec.min_chars} THEN sqrt(greatest(0, {class_terms})) END AS z
  FROM classes c JOIN best ON best.doc_id = c.doc_id JOIN langs r ON r.lang = best.lang
  WHERE c.lang IS NULL OR c.lang IN (SELECT lang FROM langs)),
out AS (
  SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
         CAST(len(filled) - len(list_distinct(filled)) AS BIGINT) AS n_dup_lines, CAST(ifnull(r.n, 0) AS BIGINT) AS n_repeat_words
  FROM base LEFT JOIN repeats r USING (doc_id))
SELECT out.*, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND ifnull(a <= {spec.max_words_jsd}, true) AND ifnull(z <= {spec.max_class_jsd}, true)
         AND ifnull(a + z <= {spec.max_sum_jsd}, true) AS kept
FROM out LEFT JOIN judged USING (doc_id)
"""


def template_decontam(spec: TemplateSpec = TemplateSpec()) -> str:
    first = "left(x, 1)"
    ends = "('.', '!', '?', chr(10))"
    units = ", ".join(f"'{u}'" for u in UNITS)
    pattern = TOKEN.replace("\\n", "\n")
    tag = f"""CASE WHEN {first} IN {ends} THEN NULL WHEN {first} BETWEEN '0' AND '9' THEN '{NUMBER}'
         WHEN lower(x) IN ({units}) AND i > 1 AND left(raw[i - 1], 1) BETWEEN '0' AND '9' THEN '{UNIT}'
         WHEN {first} <> lower({first}) AND length(x) > 1 AND substr(x, 2) = substr(lower(x), 2) AND i > 1 AND left(raw[i - 1], 1) NOT IN {ends} THEN '{NAME}'
         ELSE lower(x) END"""
    cut = lambda c: f"list_transform(t[pos:pos + m - 1], lambda x: x.{c}) AS {c}s"
    return f"""
WITH cut AS (
  SELECT side, id, text, regexp_extract_all(text, '{pattern}') AS raw
  FROM (SELECT DISTINCT 'd' AS side, doc_id AS id, text FROM documents UNION ALL SELECT DISTINCT 'i', item_id, text FROM benchmark) WHERE text IS NOT NULL),
tagged AS (
  SELECT side, id, text, list_filter(list_transform(raw, lambda x, i: {{'tag': {tag}, 'raw': x}}), lambda t: t.tag IS NOT NULL) AS t FROM cut),
item_windows AS (
  SELECT id AS item_id, pos, m, {cut("tag")}, {cut("raw")}
  FROM (SELECT *, least(len(t), {spec.window}) AS m, unnest(range(1, len(t) - least(len(t), {spec.window}) + 2)) AS pos FROM tagged WHERE side = 'i' AND len(t) > 0)
  WHERE len(list_filter(tags, lambda x: x NOT IN ('{NUMBER}', '{NAME}', '{UNIT}'))) >= {spec.min_words}),
doc_windows AS (
  SELECT id AS doc_id, text, pos, m, {cut("tag")}, {cut("raw")}
  FROM (SELECT d.*, l.m, unnest(range(1, len(t) - l.m + 2)) AS pos FROM tagged d CROSS JOIN (SELECT DISTINCT m FROM item_windows) l WHERE side = 'd' AND len(t) >= l.m)),
hits AS (
  SELECT d.doc_id, d.text, i.item_id, i.pos AS item_at, i.tags, i.raws AS said, d.raws AS stands
  FROM doc_windows d JOIN item_windows i ON d.tags = i.tags),
found AS (
  SELECT h.doc_id, h.text, h.item_id, w.n AS n_windows, count(DISTINCT item_at) AS n_found
  FROM hits h JOIN (SELECT item_id, count(DISTINCT pos) AS n FROM item_windows GROUP BY item_id) w ON w.item_id IS NOT DISTINCT FROM h.item_id
  GROUP BY ALL HAVING count(DISTINCT item_at) >= {spec.min_cover} * w.n),
slots AS (
  SELECT DISTINCT text, item_id, tags[k] AS kind, lower(said[k]) AS value, lower(stands[k]) AS stand
  FROM (SELECT *, unnest(range(1, len(tags) + 1)) AS k FROM hits) WHERE tags[k] IN ('{NUMBER}', '{NAME}', '{UNIT}')),
each AS (
  SELECT text, item_id, count(*) AS n_slots, count(*) FILTER (ways = 1) AS single, sum(changed) AS n_changed
  FROM (SELECT text, item_id, kind, value, count(*) AS ways, max(CAST(value <> stand AS INTEGER)) AS changed FROM slots GROUP BY ALL) GROUP BY ALL),
clear AS (
  SELECT text, item_id, count(*) FILTER (users = 1) / count(*) AS clear FROM (SELECT text, item_id, kind, stand, count(*) AS users FROM slots GROUP BY ALL) GROUP BY ALL)
SELECT f.doc_id, f.item_id, f.n_windows, f.n_found, f.n_found / f.n_windows AS cover,
       CAST(ifnull(n_slots, 0) AS BIGINT) AS n_slots, CAST(ifnull(n_changed, 0) AS BIGINT) AS n_changed
FROM found f LEFT JOIN each e ON e.text = f.text AND e.item_id IS NOT DISTINCT FROM f.item_id
LEFT JOIN clear c ON c.text = f.text AND c.item_id IS NOT DISTINCT FROM f.item_id
WHERE ifnull(single >= {spec.min_consistent} * n_slots AND clear >= {spec.min_consistent}, true)
"""


#: Every term of every document, weighed and summed.
LEXICAL_SEARCH = """
WITH split AS (
  SELECT row_number() OVER () AS row, doc_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms
  FROM documents),
held AS (SELECT row, doc_id, CAST(len(terms) AS BIGINT) AS n, terms FROM split WHERE len(terms) > 0),
totals AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS words FROM held),
postings AS (SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(terms) AS term FROM held) GROUP BY row, term),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM postings GROUP BY term), totals),
lengths AS (SELECT row, doc_id, 100 - 75 + ((75 * n * docs) // words) AS m FROM held, totals),
asked AS (
  SELECT item_id, term, count(*) AS times
  FROM (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM benchmark)
  GROUP BY item_id, term),
scored AS (
  SELECT a.item_id, l.row, l.doc_id, CAST(sum(a.times * w.w * ((1000000000 * p.tf) // (1000 * p.tf + 8 * l.m))) AS BIGINT) AS score
  FROM asked a JOIN weights w USING (term) JOIN postings p USING (term) JOIN lengths l USING (row)
  GROUP BY a.item_id, l.row, l.doc_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored WHERE score > 0)
WHERE rank <= 10
"""

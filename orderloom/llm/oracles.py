"""SQL counterparts, where SQL can express an operator."""

from __future__ import annotations

from orderloom.llm.chat import HOSTILE, TEMPLATE

WORDS = r"[^\x20\x09-\x0D]+"
LOWERED = ("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
           "'abcdefghijklmnopqrstuvwxyz')")

QUALITY = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{WORDS}') AS ws
  FROM documents),
windows AS (
  SELECT doc_id, i, ws[i:i + 2] AS gram
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM d)),
repeated AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (
    SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM windows
    SEMI JOIN (SELECT doc_id, gram FROM windows GROUP BY ALL HAVING count(*) > 1) g
      USING (doc_id, gram))
  GROUP BY doc_id),
lines AS (
  SELECT doc_id, l, regexp_extract_all(l, '{WORDS}') AS lw
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS l FROM d)),
judged AS (
  SELECT doc_id, l, len(lw) AS n, len(regexp_extract_all(l, '[|»›•·]|::|>>')) AS seps,
    len(regexp_extract_all(l, '[#*$%&|<>]')) AS symbols, len(list_distinct(lw)) AS different,
    len(list_filter(lw, lambda x: regexp_matches(x, '[.!?…:;,"''”’»)\]]$'))) AS ended,
    regexp_matches(l, '(?i)all rights reserved|cookie policy|privacy policy|terms of (use|service)|lorem ipsum|enable javascript|javascript is (disabled|required)|use of cookies|click here|read more|sign up for our|subscribe to our|share on (facebook|twitter)|skip to (main )?content|powered by|back to top') AS boiler
  FROM lines WHERE len(lw) > 0),
failed AS (
  SELECT *, (seps >= 3 AND seps * 4 >= n - seps) OR (symbols * 100 > 30 * n AND n > 2)
    OR (n > 60 AND ended = 0) OR (n >= 10 AND different * 100 < 30 * n)
    OR (n <= 40 AND boiler) AS bad FROM judged),
by_doc AS (
  SELECT doc_id, count(*) - count(DISTINCT l) AS dup, count(*) FILTER (bad) AS gone,
    coalesce(sum(n) FILTER (bad), 0) AS gone_words FROM failed GROUP BY doc_id),
base AS (
  SELECT d.doc_id, len(ws) AS n_words,
    coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    coalesce(dup, 0) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words,
    coalesce(gone, 0) AS n_lines_removed, coalesce(gone_words, 0)::BIGINT AS gone_words
  FROM d LEFT JOIN repeated r USING (doc_id) LEFT JOIN by_doc USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words)
    AND 100 * gone_words <= 40 * n_words AS kept,
  n_lines_removed, n_words - gone_words AS n_words_kept
FROM base"""

JACCARD = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all({LOWERED}, '{WORDS}') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + 2], ' ') AS g
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 1, 2))) AS i FROM d
        WHERE len(ws) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b USING (g)
  WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * shared >= 90 * (x.n + y.n - shared)),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, c AS component_id
FROM (SELECT a AS doc_id, min(b) AS c FROM reach GROUP BY a) LEFT JOIN sizes USING (doc_id)"""


def _escaped(text: str) -> str:
    return (f"replace(replace({text}, '\\', '\\\\'), '{TEMPLATE.lead}', "
            f"'{TEMPLATE.lead[0]}\\{TEMPLATE.lead[1:]}')")


CHAT = rf"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{HOSTILE}' UNION ALL SELECT -1, 1, 'assistant', '{HOSTILE}'),
o AS (
  SELECT *, row_number() OVER w - 1 AS i, lag(role) OVER w AS before,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, role DESC, text DESC) = 1 AS last
  FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)),
f AS (
  SELECT *, NOT CASE
    WHEN i = 0 THEN role IN ('system', 'user')
    WHEN before = 'system' THEN role = 'user'
    WHEN before IN ('user', 'tool') THEN role IN ('assistant', 'tool')
    ELSE role IN ('user', 'tool') END AS fault FROM o)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum({len(TEMPLATE.start) + len(TEMPLATE.middle) + len(TEMPLATE.end)}
    + length({_escaped('role')}) + length({_escaped('text')}))::BIGINT AS formatted_chars,
  NOT bool_or(fault) AND bool_or(last AND role <> 'system') AS valid,
  min(i) FILTER (fault)::INT AS first_fault
FROM f GROUP BY conv_id"""

BENCHMARK_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
DECONTAMINATE = rf"""
WITH items AS (
  SELECT item_id, ws, least(13, len(ws)) AS n FROM (
    SELECT item_id, regexp_extract_all({LOWERED}, '{BENCHMARK_WORDS}') AS ws FROM benchmark)
  WHERE len(ws) > 0),
patterns AS (
  SELECT DISTINCT item_id, n, array_to_string(ws[i:i + n - 1], ' ') AS p
  FROM (SELECT *, unnest(range(1, len(ws) - n + 2)) AS i FROM items)),
d AS (SELECT doc_id, regexp_extract_all({LOWERED}, '{BENCHMARK_WORDS}') AS ws FROM documents),
places AS (
  SELECT doc_id, n, i, array_to_string(ws[i:i + n - 1], ' ') AS p
  FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i
        FROM d, (SELECT DISTINCT n FROM patterns) WHERE len(ws) >= n)),
found AS (SELECT DISTINCT doc_id, n, i, item_id FROM places JOIN patterns USING (n, p)),
hit AS (
  SELECT doc_id, count(DISTINCT w) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS w FROM found) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY doc_id)
SELECT doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)"""

URLS = r"""
WITH u AS (
  SELECT page_id, coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*[^?#]*(\?[^#]*)', 1), '') AS query
  FROM pages),
r AS (
  SELECT *, '.' || host AS dotted, CASE
    WHEN ends_with('.' || host, '.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN ends_with('.' || host, '.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN ends_with('.' || host, '.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN ends_with('.' || host, '.net') AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM u)
SELECT page_id, host, path, rule, CASE
  WHEN rule IN ('example.com/de/', 'net/') THEN 'block'
  WHEN rule IS NOT NULL THEN 'allow'
  WHEN regexp_matches(dotted || path || query,
    '(?s)/wp-login|/cart/|/checkout/|\.exe$|\.zip$|^[^/]*\.doubleclick\.[^/]*/') THEN 'block'
  ELSE 'allow' END AS verdict
FROM r"""

COLLOCATIONS = rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(p, '[^\x20\x09]+') AS ws
  FROM (SELECT lang, unnest(regexp_split_to_array({LOWERED}, '[.,;:!?\x0A-\x0D]')) AS p FROM documents)),
total AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM pieces GROUP BY lang),
f AS (
  SELECT lang, m, array_to_string(ws[i:i + m - 1], ' ') AS phrase, count(*) AS f
  FROM (SELECT lang, ws, m, unnest(range(1, len(ws) - m + 2)) AS i
        FROM pieces, (SELECT unnest(range(1, 6)) AS m) WHERE len(ws) >= m)
  GROUP BY ALL HAVING count(*) >= 100),
c AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE m > 1),
cut AS (
  SELECT lang, phrase, f AS a, k, array_to_string(w[1:k], ' ') AS first,
    array_to_string(w[k + 1:], ' ') AS rest
  FROM (SELECT *, unnest(range(1, m)) AS k FROM c)),
scored AS (
  SELECT cut.lang, cut.phrase, a, l.f AS l, r.f AS r, n, k,
    (1000::HUGEINT * a * n) // (l.f::HUGEINT * r.f) AS score
  FROM cut JOIN total USING (lang) JOIN f l ON l.lang = cut.lang AND l.phrase = first
    JOIN f r ON r.lang = cut.lang AND r.phrase = rest),
lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (
  SELECT lang, array_to_string(w[i:i + s - 1], ' ') AS phrase, max(f) AS more
  FROM (SELECT *, unnest(range(1, m - s + 2)) AS i
        FROM c, (SELECT unnest(range(2, 5)) AS s) WHERE s < m) GROUP BY ALL)
SELECT lang, rank, phrase, a, l, r, n, score FROM (
  SELECT lang, phrase, a, l, r, n, score::BIGINT AS score, row_number() OVER (
    PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM lowest LEFT JOIN inside USING (lang, phrase) WHERE more IS NULL OR 100 * more < 100 * a)
WHERE rank <= 2000"""

TERMS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
SEARCH = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({LOWERED}, '{TERMS}') AS ws FROM documents),
s AS (SELECT count(*) FILTER (len(ws) > 0) AS docs, sum(len(ws))::BIGINT AS words FROM d),
tf AS (
  SELECT doc_id, t, n, count(*) AS tf
  FROM (SELECT doc_id, len(ws) AS n, unnest(ws) AS t FROM d) GROUP BY ALL),
w AS (
  SELECT t, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::BIGINT AS w
  FROM tf, s GROUP BY t, docs),
q AS (
  SELECT item_id, t, count(*) AS repeats
  FROM (SELECT item_id, unnest(regexp_extract_all({LOWERED}, '{TERMS}')) AS t FROM benchmark) GROUP BY ALL),
scored AS (
  SELECT item_id, doc_id, sum(repeats * w * ((1000000000 * tf) // (
    1000 * tf + 8 * (100 - 75 + (75 * n * docs) // words))))::BIGINT AS score
  FROM q JOIN w USING (t) JOIN tf USING (t), s GROUP BY item_id, doc_id)
SELECT * FROM (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank,
    doc_id, score FROM scored WHERE score > 0)
WHERE rank <= 10"""

COPIES = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
  doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))"""

ORACLES: dict[str, str] = {
    "op1_quality_rules": QUALITY,
    "op4_jaccard_join": JACCARD,
    "op5_chat_format": CHAT,
    "op6_decontaminate": DECONTAMINATE,
    "op8_url_filter": URLS,
    "op11_collocations": COLLOCATIONS,
    "op12_lexical_search": SEARCH,
    "op13_exact_dedup": COPIES,
}

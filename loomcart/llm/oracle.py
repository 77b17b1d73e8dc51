"""DuckDB texts for the operators that SQL can express."""

from __future__ import annotations

WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
 '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

OP1 = f"""
WITH item_words AS (SELECT CAST(item_id AS VARCHAR) AS item, {WORDS} AS w FROM benchmark),
item_windows AS (
  SELECT DISTINCT item, least(10, len(w)) AS n, array_to_string(w[i:i + 9], ' ') AS phrase
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM item_words WHERE len(w) > 0)),
doc_words AS (SELECT doc_id, {WORDS} AS w FROM documents),
starts AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
  FROM doc_words, (SELECT DISTINCT n FROM item_windows) WHERE len(w) >= n),
found AS (SELECT s.doc_id, s.i, s.n, v.item FROM starts s
  JOIN item_windows v ON v.n = s.n AND v.phrase = array_to_string(s.w[s.i:s.i + s.n - 1], ' ')),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, i, n FROM found)) GROUP BY 1),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list
  FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(list, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""


# Texts as hex digits, two for each byte, so that substr works on bytes.
OP3 = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
starts AS (SELECT doc_id, h, unnest(range(1, CAST(length(h) / 2 - 48 AS BIGINT))) AS i FROM d WHERE length(h) >= 100),
windows AS (SELECT doc_id, i, md5_number(substr(h, 2 * i - 1, 100)) AS w FROM starts),
first AS (SELECT w, min(doc_id) AS doc_id FROM windows GROUP BY w),
hit AS (SELECT v.doc_id, v.i FROM windows v JOIN first f ON f.w = v.w AND f.doc_id < v.doc_id),
bytes AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM hit),
removed AS (SELECT doc_id, p, p - row_number() OVER (PARTITION BY doc_id ORDER BY p) AS run FROM bytes),
spans AS (SELECT doc_id, min(p) AS a, max(p) + 1 AS b FROM removed GROUP BY doc_id, run),
counts AS (SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans FROM spans GROUP BY doc_id),
edges AS (SELECT doc_id, b AS a, lead(a) OVER (PARTITION BY doc_id ORDER BY a) AS b FROM spans
  UNION ALL SELECT doc_id, 1, min(a) FROM spans GROUP BY doc_id),
kept AS (SELECT e.doc_id, string_agg(substr(h, CAST(2 * e.a - 1 AS BIGINT),
    CAST(2 * (coalesce(e.b, length(h) // 2 + 1) - e.a) AS BIGINT)), '' ORDER BY e.a) AS k
  FROM edges e JOIN d USING (doc_id) GROUP BY e.doc_id)
SELECT d.doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(k, h))) AS kept_sha256
FROM d LEFT JOIN counts USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

OP4 = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
starts AS (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13),
windows AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS phrase FROM starts),
first AS (SELECT phrase, min(doc_id) AS doc_id FROM windows GROUP BY phrase),
hit AS (SELECT v.doc_id, v.i FROM windows v JOIN first f ON f.phrase = v.phrase AND f.doc_id < v.doc_id),
removed AS (SELECT doc_id, list(DISTINCT p) AS gone FROM (SELECT doc_id, unnest(range(i, i + 13)) AS p FROM hit) GROUP BY 1),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (SELECT x.doc_id, string_agg(word, ' ' ORDER BY p) AS k FROM words x
  LEFT JOIN (SELECT doc_id, unnest(gone) AS p FROM removed) g USING (doc_id, p) WHERE g.p IS NULL GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed,
  sha256(coalesce(k, '')) AS kept_sha256
FROM d LEFT JOIN removed USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


# A turn is rendered as "### role:", a line break, the text with a backslash before \\, # and <, "</turn>" and a line break.
OP5 = r"""
WITH t AS (SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(14 + length(role) + length(text) + length(regexp_replace(text, '[^\\#<]', '', 'g'))) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
"""

# Base 32 of a SHA-1: five hex digits are four letters.
OP6 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
first AS (SELECT html, min(page_id) AS first FROM p GROUP BY html)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes,
  list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST((CAST('0x' || substr(h, CAST(i // 4 * 5 + 1 AS BIGINT), 5) AS INTEGER) >> CAST(15 - i % 4 * 5 AS INTEGER)) & 31 AS BIGINT) + 1, 1)),
    'string_agg', '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM p JOIN first USING (html)
"""

OP7 = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
pieces AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS x FROM pieces),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM common JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 85 * (na.n + nb.n - c)),
ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(doc_id, c) AS (SELECT doc_id, doc_id FROM d UNION SELECT ways.b, reach.c FROM reach JOIN ways ON ways.a = reach.doc_id),
least_of AS (SELECT doc_id, min(c) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM least_of LEFT JOIN n USING (doc_id)
"""


OP12 = r"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(unnest(string_split_regex(translate(coalesce(text, ''),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS w FROM documents),
n AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM pieces GROUP BY 1),
starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM pieces),
sized AS (SELECT lang, w[i:i + m - 1] AS p FROM starts, (SELECT unnest(range(1, 6)) AS m) WHERE i + m - 1 <= len(w)),
f AS (SELECT lang, p, count(*) AS f FROM sized GROUP BY 1, 2 HAVING count(*) >= 100),
cuts AS (SELECT f.lang, f.p, f.f AS a, unnest(range(1, len(f.p))) AS k FROM f WHERE len(p) > 1),
scored AS (SELECT c.lang, c.p, c.a, c.k, l.f AS l, r.f AS r, n.n,
  CAST((1000 * c.a::HUGEINT * n.n) // (l.f::HUGEINT * r.f) AS BIGINT) AS score
  FROM cuts c JOIN n USING (lang) JOIN f l ON l.lang = c.lang AND l.p = c.p[1:c.k] JOIN f r ON r.lang = c.lang AND r.p = c.p[c.k + 1:]),
weakest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
inside AS (SELECT lang, unnest([p[1:len(p) - 1], p[2:]]) AS p, f FROM f WHERE len(p) > 2),
gone AS (SELECT DISTINCT i.lang, i.p FROM inside i JOIN f USING (lang, p) WHERE 100 * i.f >= 100 * f.f),
named AS (SELECT lang, array_to_string(p, ' ') AS phrase, a, l, r, n, score FROM weakest ANTI JOIN gone USING (lang, p))
SELECT lang, row_number() OVER best AS rank, phrase, a, l, r, n, score FROM named
WINDOW best AS (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) QUALIFY row_number() OVER best <= 2000
"""

TERMS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
 '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""

OP13 = f"""
WITH d AS (SELECT doc_id, {TERMS} AS w FROM documents),
total AS (SELECT count(*) FILTER (len(w) > 0) AS docs, CAST(sum(len(w)) AS BIGINT) AS tokens FROM d),
tf AS (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, len(w) AS n, unnest(w) AS term FROM d) GROUP BY ALL),
asked AS (SELECT item_id, unnest(list_distinct({TERMS})) AS term FROM benchmark),
weight AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight
  FROM tf SEMI JOIN asked USING (term), total GROUP BY term, docs),
score AS (SELECT item_id, doc_id, CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // tokens)))) AS BIGINT) AS score
  FROM asked JOIN weight USING (term) JOIN tf USING (term), total GROUP BY 1, 2)
SELECT item_id, CAST(row_number() OVER best AS INTEGER) AS rank, doc_id, score FROM score WHERE score > 0
WINDOW best AS (PARTITION BY item_id ORDER BY score DESC, doc_id) QUALIFY row_number() OVER best <= 50
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_decontaminate": OP1,
        "op3_suffix_array": OP3,
        "op4_substring": OP4,
        "op5_chat_format": OP5,
        "op6_warc": OP6,
        "op7_minhash": OP7,
        "op12_collocations": OP12,
        "op13_pair_bounds": OP13,
    }

"""DuckDB SQL for the training-data queries that SQL can express."""
from __future__ import annotations

from tessera.llm.common import ALNUM_BREAK_SQL, WORD_BREAK_SQL
from tessera.llm.queries import MIX_SEED, MIX_WEIGHTS
from tessera.llm.license_scan import BLOCK_STEP, BLOCK_WORDS, NAMING, PHRASES, TEMPLATES, THRESHOLD, THRESHOLDS

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = f"regexp_extract_all({_LOWER}, '{ALNUM_BREAK_SQL}')"

SQL: dict[str, str] = {}

SQL["op2_substring_dedup"] = f"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD_BREAK_SQL}') AS w FROM documents),
k AS (SELECT doc_id, p, array_to_string(w[p:p + 49], ' ') AS win
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS p FROM d WHERE len(w) >= 50)),
f AS (SELECT win, min(doc_id) AS first_doc FROM k GROUP BY win HAVING count(DISTINCT doc_id) > 1),
r AS (SELECT DISTINCT doc_id, unnest(range(p, p + 50)) AS q FROM k JOIN f USING (win) WHERE doc_id > first_doc),
x AS (SELECT d.doc_id, q, word, r.doc_id IS NULL AS stays
      FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS q FROM d) d LEFT JOIN r USING (doc_id, q)),
y AS (SELECT *, lag(stays) OVER (PARTITION BY doc_id ORDER BY q) AS stayed FROM x),
a AS (SELECT doc_id, count(*) FILTER (NOT stays) AS n_removed, string_agg(word, ' ' ORDER BY q) FILTER (stays) AS kept,
             count(*) FILTER (NOT stays AND coalesce(stayed, true)) AS n_intervals
      FROM y GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256, CAST(length(coalesce(kept, '')) AS BIGINT) AS kept_chars,
  CAST(coalesce(n_intervals, 0) AS BIGINT) AS n_intervals
FROM d LEFT JOIN a USING (doc_id)
"""

SQL["op7_decontamination"] = f"""
WITH d AS (SELECT doc_id, {_ALNUM} AS w FROM documents),
i AS (SELECT item_id, {_ALNUM} AS w FROM benchmark),
iw AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[p:p + least(len(w), 10) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS p FROM i WHERE len(w) > 0)),
dw AS (
  SELECT doc_id, p, s.n, array_to_string(w[p:p + s.n - 1], ' ') AS win
  FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS p FROM d) CROSS JOIN (SELECT DISTINCT n FROM iw) s
  WHERE p + s.n - 1 <= len(w)),
m AS (SELECT doc_id, p, dw.n, item_id FROM dw JOIN iw ON dw.n = iw.n AND dw.win = iw.win),
hw AS (SELECT DISTINCT doc_id, unnest(range(p, p + n)) AS q FROM m),
hit AS (SELECT doc_id, count(*) AS n_hit, count(*) FILTER (before IS NULL OR before < q - 1) AS n_spans
        FROM (SELECT doc_id, q, lag(q) OVER (PARTITION BY doc_id ORDER BY q) AS before FROM hw) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids
       FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM m) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)
"""


def _license_sql() -> str:
    """Base phrases by position; containment by counting a template's distinct words in every line block, and in every
    window of twice its length that begins at a multiple of its length."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    phrases = ", ".join(f"({quote(p)}, {len(p.split())}, {quote(label)})" for p, label in PHRASES)
    named = lambda label: "[" + ", ".join(quote(w) for w in NAMING.get(label, ())) + "]::VARCHAR[]"
    templates = ", ".join(f"({i}, {quote(label)}, {quote(text)}, {THRESHOLDS.get(label, THRESHOLD)}::DOUBLE, {named(label)})" for i, (label, text) in enumerate(TEMPLATES))
    lower = _LOWER
    return f"""
WITH d AS (SELECT doc_id, {_ALNUM} AS w FROM documents),
p(phrase, n, label) AS (VALUES {phrases}),
b AS (SELECT doc_id, q - 1 AS first_word, label
      FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS q FROM d WHERE list_contains(w, 'license')) JOIN p ON array_to_string(w[q:q + n - 1], ' ') = phrase),
base AS (SELECT doc_id, count(*) AS n_base, min(first_word) AS first_word, max(first_word) AS last_word FROM b GROUP BY doc_id),
l AS (SELECT doc_id, unnest(string_split({lower}, chr(10))) AS line FROM documents),
lw AS (SELECT doc_id, row_number() OVER () AS line_no, regexp_extract_all(line, '{ALNUM_BREAK_SQL}') AS w FROM l),
bl AS (SELECT doc_id, line_no, i, unnest(list_distinct(w[i + 1:i + {BLOCK_WORDS}])) AS word
       FROM (SELECT doc_id, line_no, w, unnest(CASE WHEN len(w) <= {BLOCK_WORDS} THEN [0] ELSE range(0, len(w) - {BLOCK_WORDS - BLOCK_STEP}, {BLOCK_STEP}) END) AS i
             FROM lw)),
t(t, label, text, share, naming) AS (VALUES {templates}),
tl AS (SELECT t, label, share, naming, regexp_extract_all({lower}, '{ALNUM_BREAK_SQL}') AS w FROM t),
tw AS (SELECT t, unnest(list_distinct(w)) AS word FROM tl),
tn AS (SELECT t, label, share, naming, len(list_distinct(w)) AS size, len(w) AS step FROM tl),
wi AS (SELECT doc_id, total, word, i - 1 AS i FROM (SELECT doc_id, len(w) AS total, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d)
       WHERE word IN (SELECT word FROM tw)),
wk AS (SELECT doc_id, total, t, word, unnest([i // step - 1, i // step]) AS k, step FROM wi JOIN tw USING (word) JOIN tn USING (t)),
held AS (SELECT doc_id, 'line' AS kind, line_no AS a, i AS b, t, list(DISTINCT word) AS words FROM bl JOIN tw USING (word) GROUP BY ALL
         UNION ALL
         SELECT doc_id, 'window' AS kind, 0 AS a, k AS b, t, list(DISTINCT word) AS words FROM wk
         WHERE k = 0 OR (k > 0 AND (k + 1) * step < total) GROUP BY ALL),
m AS (SELECT doc_id, label, len(words) / size AS containment FROM held JOIN tn USING (t)
      WHERE len(words) >= ceil(share * size - 1e-9) AND list_has_all(words, naming)),
s AS (SELECT doc_id, max(containment) AS score FROM m GROUP BY doc_id),
bn AS (SELECT doc_id, string_agg(label, ',' ORDER BY label) AS x FROM (SELECT DISTINCT doc_id, label FROM b) GROUP BY doc_id),
mn AS (SELECT doc_id, string_agg(label, ',' ORDER BY label) AS x
       FROM (SELECT doc_id, label FROM b UNION SELECT doc_id, label FROM m) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base,
  CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
  coalesce(bn.x, '') AS base_labels, coalesce(mn.x, '') AS labels,
  CASE WHEN coalesce(n_base, 0) > 0 THEN 1.0::DOUBLE ELSE coalesce(score, 0.0::DOUBLE) END AS score
FROM d LEFT JOIN base USING (doc_id) LEFT JOIN s USING (doc_id) LEFT JOIN bn USING (doc_id) LEFT JOIN mn USING (doc_id)
"""


SQL["op5_license_scan"] = _license_sql()

SQL["op8_near_dedup"] = f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{WORD_BREAK_SQL}') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[p:p + 4], ' ') AS sh
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS p FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
i AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y ON x.sh = y.sh AND x.doc_id < y.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM i JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * k >= 75 * (na.n + nb.n - k)),
u AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
r(v, c) AS (SELECT doc_id, doc_id FROM documents UNION SELECT u.b, r.c FROM r JOIN u ON u.a = r.v),
c AS (SELECT v, min(c) AS component_id FROM r GROUP BY v)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM d LEFT JOIN n USING (doc_id) JOIN c ON c.v = d.doc_id
"""

SQL["op9_exact_dedup"] = """
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) AS r
           FROM documents),
g AS (SELECT text, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY text)
SELECT doc_id, keep_id, group_size, r = 1 AS kept, sha256(text) AS text_sha256 FROM t JOIN g USING (text)
"""


def mix_sql(source: str, weights: dict[str, float], seed: int) -> str:
    """(doc_id, copies) and the copies' order keys of the Poisson replication over a table or query `source`;
    means up to 256 (larger ones are drawn in parts)."""
    listed = ", ".join(f"('{s}', {float(w)}::DOUBLE)" for s, w in weights.items())
    bits = lambda text, digits: f"CAST('0x' || substr(md5({text}), 1, {digits}) AS BIGINT)"
    doc = "coalesce(CAST(doc_id AS VARCHAR), 'null')"
    return f"""
WITH RECURSIVE src AS (SELECT * FROM {source}),
w(source, weight) AS (VALUES {listed}),
n AS (SELECT source, count(*) AS n, any_value(weight) AS weight FROM src JOIN w USING (source) GROUP BY source),
rate AS (SELECT source, weight / sum(weight) OVER () * sum(n) OVER () / n AS mean FROM n),
cdf AS (
  SELECT source, mean, 0 AS k, exp(-mean) AS term, exp(-mean) AS total FROM rate
  UNION ALL SELECT source, mean, k + 1, term * mean / (k + 1), total + term * mean / (k + 1) FROM cdf WHERE k < mean + 60),
table_ AS (SELECT source, list(total ORDER BY k) AS p FROM (SELECT * FROM cdf UNION ALL BY NAME
  (WITH RECURSIVE one AS (SELECT 0 AS k, exp(-1.0::DOUBLE) AS term, exp(-1.0::DOUBLE) AS total
     UNION ALL SELECT k + 1, term / (k + 1), total + term / (k + 1) FROM one WHERE k < 60) SELECT '<rest>' AS source, k, term, total FROM one)) GROUP BY source),
drawn AS (
  SELECT src.*, len(list_filter(p, lambda x: x <= {bits(f"'{seed}:' || {doc} || ':1'", 13)} / 4503599627370496.0::DOUBLE)) AS copies
  FROM src JOIN table_ t ON t.source = CASE WHEN src.source IN (SELECT source FROM n) THEN src.source ELSE '<rest>' END)
SELECT * REPLACE (CAST(copies AS INTEGER) AS copies, CAST(copy AS INTEGER) AS copy),
  {bits(f"'{seed}-order:' || {doc} || ':' || copy", 15)} AS shuffle_key
FROM (SELECT *, unnest(range(1, copies + 1)) AS copy FROM drawn)
"""


SQL["op3_mixing"] = f"SELECT doc_id, source, copy, copies, shuffle_key, text FROM ({mix_sql('documents', MIX_WEIGHTS, MIX_SEED)})"

#: Floors of 256-fold components are whole doubles, so list_dot_product is exact.
SQL["op11_hard_negatives"] = """
WITH q AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), a AS (SELECT * FROM q WHERE vec_id % 100 = 0),
scores AS (
  SELECT a.vec_id AS anchor_id, a.label AS anchor_label, q.vec_id, q.label, CAST(list_dot_product(a.v, q.v) AS BIGINT) AS score
  FROM a JOIN q ON a.vec_id <> q.vec_id
), positives AS (
  SELECT anchor_id, anchor_label, vec_id AS positive_id, score AS positive_score FROM scores WHERE label = anchor_label
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
       s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scores s ON s.anchor_id = p.anchor_id AND s.label <> p.anchor_label
  AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) <= 10
"""

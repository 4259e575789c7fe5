"""SQL counterparts of the corpus queries, where SQL can express them.

Secrets need the places of matches, which DuckDB's functions do not give; language
profiles, byte-pair encoding and shards of free choice are beyond SQL too; repeated
substrings can be said in SQL but take minutes on the smallest tables. Tests compare these
with plain Python versions.
"""

from __future__ import annotations

from newsloom.llm.licenses import EQUIVALENT, NOTICES

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_JACCARD = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\\x20\\x09-\\x0D]+') AS ws FROM documents
),
s AS (
  SELECT DISTINCT doc_id, unnest(
    CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' ')) END) AS t
  FROM w
),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.t = y.t AND x.doc_id <> y.doc_id
  GROUP BY ALL
),
l AS (
  SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 85 * (na.n + nb.n - c)
),
r AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, least(w.doc_id, coalesce(m.b, w.doc_id)) AS component_id
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT a, min(b) AS b FROM r GROUP BY a) m ON m.a = w.doc_id
"""

_WARC = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS d FROM pages),
f AS (SELECT d, min(page_id) AS first FROM p WHERE n >= 100 GROUP BY d)
SELECT page_id, n AS payload_bytes, p.d AS payload_digest,
  CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first <> page_id THEN first END AS refers_to
FROM p LEFT JOIN f USING (d)
"""

_TOPK = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0
)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
FROM s QUALIFY rank <= 5
"""

_WORDS = f"regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
_DECONTAMINATION = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
b AS (SELECT item_id::VARCHAR AS item, {_WORDS} AS ws FROM benchmark),
bw AS (
  SELECT DISTINCT item, least(len(ws), 10) AS n,
    unnest(list_transform(range(1, greatest(len(ws) - 9, 1) + 1), lambda i: array_to_string(ws[i:i + 9], ' '))) AS s
  FROM b WHERE len(ws) > 0
),
dw AS (
  SELECT doc_id, n, unnest(range(1, len(ws) - n + 2)) AS i, ws FROM d, (SELECT DISTINCT n FROM bw) WHERE len(ws) >= n
),
h AS (
  SELECT doc_id, dw.n, i, item FROM (SELECT doc_id, n, i, array_to_string(ws[i:i + n - 1], ' ') AS s FROM dw) dw
  JOIN bw ON bw.n = dw.n AND bw.s = dw.s
),
c AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM h) GROUP BY doc_id),
t AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, item FROM h) GROUP BY doc_id
)
SELECT d.doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN t USING (doc_id)
"""


def _canonical(text: str) -> str:
    plain = f"""regexp_replace(lower({text}),
      '(?m)^[^\\p{{L}}\\p{{N}}\\n]*(?:copyright|©)[^\\n]*(?:\\(c\\)|©|\\d{{4}})[^\\n]*$', ' ', 'g')"""
    words = f"' ' || trim(regexp_replace({plain}, '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')) || ' '"
    for spelling, usual in EQUIVALENT.items():
        words = f"replace({words}, ' {spelling} ', ' {usual} ')"
    return f"trim({words})"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_KNOWN = ", ".join(f"({_quoted(i)}, {_quoted(t)})" for i, many in NOTICES.items() for t in many)
_LICENSES = f"""
WITH k AS (SELECT DISTINCT license_id, {_canonical("text")} AS c FROM (VALUES {_KNOWN}) AS v(license_id, text)),
u AS (
  SELECT doc_id, text AS unit, true AS whole FROM documents
  UNION ALL SELECT doc_id, unnest(string_split(text, chr(10))), false FROM documents
),
m AS (SELECT doc_id, whole, {_canonical("unit")} AS c FROM u WHERE unit IS NOT NULL)
SELECT doc_id, license_id, count(*) FILTER (WHERE NOT whole) AS n_lines, bool_or(whole) AS whole
FROM m JOIN k USING (c) WHERE c <> '' GROUP BY doc_id, license_id
"""

_LEXICAL = f"""
WITH d AS (SELECT row_number() OVER () AS i, doc_id, {_WORDS} AS ws FROM documents),
q AS (SELECT DISTINCT i, item_id, unnest(ws) AS t FROM (SELECT row_number() OVER () AS i, item_id, {_WORDS} AS ws FROM benchmark)),
s AS (SELECT count(*) FILTER (len(ws) > 0) AS n_docs, sum(len(ws))::BIGINT AS terms FROM d),
tf AS (SELECT i, t, count(*) AS tf FROM (SELECT i, unnest(ws) AS t FROM d) GROUP BY ALL),
w AS (SELECT t, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM tf, s GROUP BY t, n_docs),
m AS (SELECT i, doc_id, 100 - 50 + ((50 * len(ws) * n_docs) // terms) AS m FROM d, s WHERE len(ws) > 0),
x AS (
  SELECT q.i, item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
  FROM q JOIN tf USING (t) JOIN w USING (t) JOIN m ON m.i = tf.i GROUP BY q.i, item_id, m.i, doc_id
)
SELECT item_id, (row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id))::INTEGER AS rank, doc_id, score
FROM x WHERE score > 0 QUALIFY rank <= 50
"""

_PHRASES = f"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(regexp_split_to_array({_LOWER.format("coalesce(text, '')")}, '[.,;:!?\\x0A-\\x0D]')) AS p FROM documents
),
w AS (SELECT lang, regexp_extract_all(p, '[^\\x20\\x09]+') AS ws FROM p),
n AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM w GROUP BY lang),
g AS (
  SELECT lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i:i + k - 1], ' '))) AS phrase
  FROM w, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(ws) >= k
),
f AS (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= 30),
c AS (
  SELECT * FROM f WHERE k > 1 AND NOT EXISTS (
    SELECT 1 FROM f l WHERE l.lang = f.lang AND l.k > f.k AND contains(' ' || l.phrase || ' ', ' ' || f.phrase || ' ')
    AND 100 * l.f >= 80 * f.f)
),
u AS (SELECT lang, phrase, f AS a, string_split(phrase, ' ') AS ws, unnest(range(1, k)) AS cut, k FROM c),
s AS (
  SELECT u.lang, u.phrase, a, cut, x.f AS l, y.f AS r, (2000000::HUGEINT * a // (x.f + y.f))::BIGINT AS score
  FROM u JOIN f x ON x.lang = u.lang AND x.phrase = array_to_string(ws[1:cut], ' ')
  JOIN f y ON y.lang = u.lang AND y.phrase = array_to_string(ws[cut + 1:u.k], ' ')
),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM b JOIN n USING (lang) QUALIFY rank <= 2000
"""

ORACLES: dict[str, str] = {
    "op2_jaccard": _JACCARD,
    "op3_warc": _WARC,
    "op5_licenses": _LICENSES,
    "op6_topk": _TOPK,
    "op7_decontamination": _DECONTAMINATION,
    "op11_lexical": _LEXICAL,
    "op13_phrases": _PHRASES,
}

"""DuckDB SQL with the same result as each query, over the same tables."""

from __future__ import annotations

from newsloom.functions.text import STOP_WORDS
from registry.derived import ARTICLES_SQL

STAMP = "2026-05-06T12:00:00"
BATCH = "20260506_120000"
NEXT_BATCH = "20260506_130000"

# Unicode white space and word characters, spelled out for RE2.
SPACE = (
    r"\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
WORD = r"\p{L}\p{N}_"
TAG = r"(?s)<!--.*?-->|</[^>]*>|<[A-Za-z!?][^>]*>"
URL = rf"http[^{SPACE}]+|www[^{SPACE}]+"
DISALLOWED = rf"[^{WORD}{SPACE}\x{{600}}-\x{{6ff}}\x{{c0}}-\x{{24f}}.,!?;:''\x22-]"

# The character references that the tables hold. The ampersand, which also goes
# without its semicolon, comes last.
ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&nbsp;": " ", "&copy;": "©", "&middot;": "·"}


def unescape(x: str) -> str:
    for name, char in ENTITIES.items():
        x = f"replace({x}, '{name}', '{char}')"
    return f"regexp_replace({x}, '&amp;?', '&', 'g')"


def pieces(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, '{TAG}'), lambda p: p <> '')"


def strip_html(x: str) -> str:
    return unescape(f"array_to_string({pieces(f'coalesce({x}, chr(32))')}, ' ')")


def strip_space(x: str) -> str:
    return f"regexp_replace({x}, '^[{SPACE}]+|[{SPACE}]+$', '', 'g')"


def text_pieces(x: str) -> str:
    split = f"regexp_split_to_array({x}, '{TAG}')"
    decoded = f"list_transform({split}, lambda p: {strip_space(unescape('p'))})"
    return f"list_filter({decoded}, lambda p: p <> '')"


def collapse(x: str) -> str:
    return f"regexp_replace({x}, '[{SPACE}]+', ' ', 'g')"


def remove_urls(x: str) -> str:
    return f"regexp_replace({x}, '{URL}', '', 'g')"


def char_filter(x: str) -> str:
    return f"regexp_replace({x}, '{DISALLOWED}', ' ', 'g')"


def normalize(x: str) -> str:
    return f"trim({char_filter(collapse(remove_urls(strip_html(x))))}, ' ')"


def sentinel_free(x: str) -> str:
    """coalesce to '' for a column that may be NULL."""
    return f"coalesce({x}, '')"


def normal_date(d: str, scraped: str) -> str:
    t = strip_space(d)
    key = (
        rf"regexp_replace(regexp_replace({t}, '^(?i:mon|tue|wed|thu|fri|sat|sun),\s+', ''), "
        rf"'(\d:\d\d:\d\d)\s*(GMT|Z|[+-]\d\d:?\d\d)$', '\1')"
    )
    iso = "'%Y-%m-%dT%H:%M:%S'"
    return rf"""CASE WHEN coalesce({d}, '') = '' THEN NULL
      WHEN regexp_full_match({t}, '\d{{1,2}}:\d{{2}}')
        THEN strftime(try_strptime(substr({scraped}, 1, 10) || ' ' || {t}, '%Y-%m-%d %H:%M'), {iso})
      ELSE coalesce(strftime(try_strptime({key}, ['%d %b %Y %H:%M:%S', {iso},
        '%Y-%m-%d %H:%M:%S', '%Y-%m-%d', '%d/%m/%Y', '%d-%m-%Y']), {iso}), {d}) END"""


def iso_time(x: str) -> str:
    """ISO text to a timestamp, zone dropped."""
    return rf"""CASE WHEN regexp_full_match({x}, '\d{{4}}-\d\d-\d\d([T ]\d\d:\d\d:\d\d(\.\d+)?(Z|[+-]\d\d:?\d\d)?)?')
      THEN try_cast(replace(regexp_replace({x}, '(\d\d:\d\d:\d\d(\.\d+)?)(Z|[+-]\d\d:?\d\d)$', '\1'), 'T', ' ') AS TIMESTAMP) END"""


def language(text: str, source: str) -> str:
    arabic = f"length(regexp_replace({text}, '[^\\x{{600}}-\\x{{6ff}}]', '', 'g'))"
    latin = f"length(regexp_replace({text}, '[^a-zA-Z]', '', 'g'))"
    src = f"lower(coalesce({source}, ''))"
    return f"""CASE WHEN coalesce({text}, '') = '' THEN 'unknown'
      WHEN regexp_matches({src}, 'hespress|akhbarona|barlamane|lakom')
        THEN CASE WHEN {arabic} > {latin} THEN 'ar' ELSE 'fr' END
      WHEN regexp_matches({src}, 'bbc|reuters|cnn') THEN 'en'
      WHEN {arabic} > {latin} THEN 'ar' ELSE 'en' END"""


def tokens(x: str) -> str:
    """Whole words; the tables hold no Arabic marks, where this would differ."""
    return (
        f"list_filter(regexp_split_to_array(lower({x}), '[^{WORD}]+'), "
        f"lambda w: regexp_full_match(w, '[a-zA-Z\\x{{600}}-\\x{{6ff}}]{{4,}}'))"
    )


STOP = ", ".join(f"'{w}'" for w in STOP_WORDS)
NAMES = "CASE {c} WHEN 'en' THEN 'English' WHEN 'ar' THEN 'Arabic' WHEN 'fr' THEN 'French' WHEN 'unknown' THEN 'Unknown' ELSE {c} END"
SOURCE_KEY = "replace(lower(source), ' ', '_')"

A = "WITH a AS (" + ARTICLES_SQL.format(documents="documents") + ")"
KEPT = A + """, kept AS (
  SELECT * EXCLUDE (copy) FROM (
    SELECT *, row_number() OVER (PARTITION BY coalesce(url, '') ORDER BY {order}) AS copy FROM a)
  WHERE copy = 1)"""


def checked_sql(order: str = "pos") -> str:
    return KEPT.format(order=order) + f""", cleaned AS (
  SELECT {normalize('title')} AS title, nullif({normalize(sentinel_free('author'))}, '') AS author,
    {normal_date('publication_date', 'scraped_at')} AS publication_date,
    nullif({normalize(sentinel_free('category'))}, '') AS category,
    {normalize('content')} AS content, source, url, language AS given, scraped_at, pos FROM kept),
checked AS (
  SELECT title, author, publication_date, category, content, CAST(length(content) AS INT) AS content_length,
    source, url, coalesce(nullif(given, ''), {language('content', 'source')}) AS language, scraped_at, pos,
    CASE WHEN title = '' THEN 'missing_title' WHEN length(title) < 5 THEN 'title_too_short'
      WHEN content = '' THEN 'missing_content' WHEN length(content) < 50 THEN 'content_too_short'
      WHEN url = '' THEN 'missing_url' ELSE 'ok' END AS reason FROM cleaned),
silver AS (SELECT * EXCLUDE (reason) FROM checked WHERE reason = 'ok')"""


C = checked_sql()
DAY = "substr(coalesce(nullif(publication_date, ''), scraped_at), 1, 10)"
EVENTS = C + """, numbered AS (SELECT *, row_number() OVER (ORDER BY pos) AS sequence FROM silver)"""


def event_id(batch: str) -> str:
    return f"sha256('{batch}:' || CAST(sequence AS VARCHAR) || ':' || url)"


def event_rows(batch: str, loaded: str) -> str:
    return f"""SELECT {event_id(batch)} AS event_id, 'article_published' AS event_type,
      TIMESTAMP '2026-05-06 12:00:00' AS event_time, '{batch}' AS batch_id, source, sha256(url) AS url_hash,
      url, title, {iso_time('publication_date')} AS publication_date, language, category,
      TIMESTAMP '{loaded}' AS loaded_at FROM numbered"""


def keyword_counts(table: str) -> str:
    return f"""SELECT keyword, count(*) AS frequency FROM (
      SELECT unnest({tokens("content || ' ' || title")}) AS keyword FROM {table})
      WHERE keyword NOT IN ({STOP}) GROUP BY keyword"""


BY_SOURCE = "SELECT source, count(*) AS article_count FROM silver GROUP BY 1"
BY_CATEGORY = (
    "SELECT coalesce(nullif(category, ''), 'Uncategorized') AS category, count(*) AS article_count "
    "FROM silver GROUP BY 1"
)
BY_LANGUAGE = (
    f"SELECT language AS language_code, {NAMES.format(c='language')} AS language, "
    "count(*) AS article_count FROM silver GROUP BY ALL"
)
BY_DATE = f"SELECT {DAY} AS date, count(*) AS article_count FROM silver WHERE {DAY} <> '' GROUP BY 1"
TOP = f"SELECT * FROM ({keyword_counts('silver')}) ORDER BY frequency DESC, keyword LIMIT 30"
AVERAGE = "coalesce(round(CAST(sum(content_length) AS DOUBLE) / nullif(count(*), 0), 1), 0.0)"


def as_ints(sql: str, *keys: str, count: str = "article_count") -> str:
    return f"SELECT {', '.join(keys)}, CAST({count} AS INT) AS {count} FROM ({sql})"


def violations(rows: str, layer: str, checks: list[tuple[str, str, str]], severity: str = "WARNING") -> str:
    """One row per (type, message, condition)."""
    parts = [
        f"SELECT '{layer}' AS layer, '{kind}' AS type, '{severity}' AS severity, '{message}' AS message, "
        f"count(*) FILTER (WHERE {condition}) AS violations FROM {rows}"
        for kind, message, condition in checks
    ]
    return " UNION ALL ".join(parts)


def required(fields: list[str], what: str) -> list[tuple[str, str, str]]:
    return [("missing_field", f"{what.capitalize()} has no {f}", f"coalesce(CAST({f} AS VARCHAR), '') = ''") for f in fields]


FOREIGN = A + f", f AS (SELECT *, CASE WHEN pos % 9 = 0 THEN '' ELSE '{STAMP}' END AS processed_at FROM a)"
SILVER_FIELDS = ["title", "content", "url", "source", "language", "processed_at"]
SILVER_REQUIRED = required(SILVER_FIELDS, "processed article")
MARKUP = ("normalization_error", "Markup left in the text", "regexp_matches(coalesce(content, ''), '[<>]')")
LANGUAGE = ("language_detection", "Language is none of the known codes", "coalesce(language, '') NOT IN ('en', 'ar', 'fr')")
DATES = (
    "date_format", "Date is no time stamp",
    f"coalesce(publication_date, '') <> '' AND ({iso_time('publication_date')}) IS NULL",
)
SILVER_CHECKS = [*SILVER_REQUIRED, MARKUP, LANGUAGE, DATES]
EVENT_FIELDS = ["event_id", "event_type", "event_time", "batch_id", "url", "payload"]
BROKEN_EVENTS = EVENTS + f""", e AS (
  SELECT {event_id(BATCH)} AS event_id, CASE WHEN sequence % 5 = 0 THEN 'other' ELSE 'article_published' END AS event_type,
    '{STAMP}' AS event_time, CASE WHEN sequence % 7 = 0 THEN '' ELSE '{BATCH}' END AS batch_id, url, 'x' AS payload
  FROM numbered)"""


def score(errors: str, warnings: str) -> str:
    return f"100.0 - least(({errors} * 10 + {warnings} * 2) / CAST(50.0 AS DOUBLE), 1.0) * 100"


def verdict(s: str) -> str:
    return f"CASE WHEN {s} >= 90 THEN 'EXCELLENT' WHEN {s} >= 75 THEN 'GOOD' ELSE 'POOR' END"


# Pages.


def without_blocks(x: str, *tags: str) -> str:
    for tag in tags:
        x = rf"regexp_replace({x}, '(?is)<{tag}(?:\s[^>]*)?>.*?</{tag}\s*>', '', 'g')"
    return x


def first_block(x: str, tag: str) -> str:
    return rf"regexp_extract({x}, '(?is)<{tag}(?:\s[^>]*)?>(.*?)(?:</{tag}\s*>|\z)', 1)"


BASE = "regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+', 0)"
HREFS = rf"""list_transform(regexp_extract_all({without_blocks("regexp_replace(html, '(?s)<!--.*?-->', '', 'g')", 'script', 'style')},
  '(?i)<a\s(?:[^>]*?\s)?href\s*=\s*"([^"]*)"', 1), lambda h: {unescape('h')})"""
LINKS = f"""links AS (
  SELECT page_id, url, {BASE} AS base, CAST(i - 1 AS INT) AS pos, hs[i] AS href,
    CASE WHEN starts_with(hs[i], '/') THEN {BASE} || hs[i] ELSE hs[i] END AS resolved
  FROM (SELECT *, unnest(range(1, len(hs) + 1)) AS i FROM (SELECT page_id, url, {HREFS} AS hs FROM pages)))"""
BODY = (
    "array_to_string("
    + text_pieces(first_block(without_blocks("html", "script", "style", "nav", "aside"), "article"))
    + ", ' ')"
)
TITLE = (
    "array_to_string("
    + text_pieces(first_block("regexp_replace(html, '(?s)<!--.*?-->', '', 'g')", "h1"))
    + ", '')"
)
# Paragraphs of an article as a tree shows them: one that is never closed holds
# everything that follows it.
SEGMENTS = "string_split(" + first_block(without_blocks("html", "script", "style", "nav", "aside"), "article") + ", '<p>')"
PARAGRAPHS = (
    "array_to_string(list_transform(range(2, len(seg) + 1), lambda i: CASE WHEN contains(seg[i], '</p>') "
    f"THEN array_to_string({text_pieces("string_split(seg[i], '</p>')[1]")}, '') "
    f"ELSE array_to_string({text_pieces("array_to_string(seg[i:], '<p>')")}, '') END), ' ')"
)
FEED = """feed AS (
  SELECT doc_id, CASE WHEN doc_id % 11 = 0 THEN '' ELSE 'Item ' || CAST(doc_id AS VARCHAR) END AS title,
    CASE WHEN doc_id % 10 = 0 THEN '' WHEN doc_id % 3 = 1 THEN '/news/' || CAST(doc_id AS VARCHAR)
      WHEN doc_id % 7 = 0 THEN 'https://other.example/' || CAST(doc_id AS VARCHAR)
      ELSE 'https://www.bbc.com/news/' || CAST(doc_id AS VARCHAR) END AS link,
    '<p>' || text || '</p> &amp; more' AS description,
    CASE doc_id % 3 WHEN 0 THEN 'bbc_news' WHEN 1 THEN 'al_jazeera' ELSE 'reuters' END AS site,
    CASE doc_id % 2 WHEN 0 THEN 'world' ELSE 'business' END AS category FROM documents)"""

CRAWL = f"""WITH s AS (SELECT page_id, html, page_id % 6 AS k, page_id % 6 IN (0, 2, 3) AS listed, {SEGMENTS} AS seg,
          ['https://www.hespress.com', 'https://www.bbc.com', 'https://barlamane.com', 'https://www.akhbarona.com',
           'https://www.aljazeera.com', 'https://www.reuters.com'][page_id % 6 + 1] || '/' || CAST(page_id AS VARCHAR) || '.html' AS url
          FROM pages),
        b AS (SELECT *, CASE WHEN listed THEN {BODY} ELSE {PARAGRAPHS} END AS body,
          CASE WHEN listed THEN {TITLE} ELSE 'Item ' || CAST(page_id AS VARCHAR) END AS title FROM s),
        c AS (SELECT *, CASE WHEN k = 5 AND body = '' THEN 'about ' || url ELSE body END AS content FROM b),
        crawled AS (SELECT title, CAST(NULL AS VARCHAR) AS author,
          CASE WHEN NOT listed THEN 'Mon, 06 May 2026 12:00:00 GMT' END AS publication_date,
          CASE WHEN NOT listed THEN 'world' END AS category, content,
          ['Hespress', 'BBC News', 'Barlamane', 'Akhbarona', 'Al Jazeera', 'Reuters'][k + 1] AS source, url,
          CASE WHEN listed THEN 'ar' ELSE 'en' END AS language, '{STAMP}' AS scraped_at
          FROM c WHERE content <> '' AND title <> '')"""

ORACLES: dict[str, str] = {
    # Scalar functions
    "strip_html": f"{A} SELECT pos, {strip_html('content')} AS plain FROM a",
    "strip_html_pages": f"SELECT page_id, {strip_html(without_blocks('html', 'script', 'style'))} AS plain FROM pages",
    "remove_urls": f"{A} SELECT pos, {remove_urls('content')} AS without_urls FROM a",
    "collapse_ws": f"SELECT doc_id, {collapse('text')} AS collapsed FROM documents",
    "char_filter": f"{A} SELECT pos, {char_filter('content')} AS filtered FROM a",
    "normalize_text": f"""{A} SELECT pos, {normalize('title')} AS title,
        {normalize(sentinel_free('author'))} AS author, {normalize(sentinel_free('category'))} AS category,
        {normalize('content')} AS content, CAST(length({normalize('content')}) AS INT) AS content_length FROM a""",
    "normalize_date": f"{A} SELECT pos, {normal_date('publication_date', 'scraped_at')} AS publication_date FROM a",
    "parse_datetime": f"{A} SELECT pos, {iso_time('publication_date')} AS published, {iso_time('scraped_at')} AS scraped FROM a",
    "detect_language": f"{A} SELECT pos, {language('content', 'source')} AS detected FROM a",
    "language_or_detect": f"""{A}, c AS (SELECT pos, coalesce(nullif(language, ''), {language('content', 'source')}) AS code FROM a)
        SELECT pos, code, {NAMES.format(c='code')} AS name FROM c""",
    "publication_day": f"{C} SELECT pos, {DAY} AS day FROM silver",
    "tokenize": f"""{A} SELECT pos, token, count(*) AS n FROM (
        SELECT pos, unnest({tokens("content || ' ' || title")}) AS token FROM a) GROUP BY ALL""",
    "stopword_filter": f"{A} {keyword_counts('a')}",
    "url_hash": f"{A} SELECT pos, sha256(url) AS url_hash FROM a",
    # Silver
    "dedup_articles": f"{KEPT.format(order='pos')} SELECT pos, url FROM kept",
    "validate_articles": f"{C} SELECT pos, url, reason FROM checked",
    "rejects_by_reason": f"{C} SELECT reason, count(*) AS rejected FROM checked WHERE reason <> 'ok' GROUP BY 1",
    "silver_articles": f"{C} SELECT * FROM silver",
    "silver_stats": f"""{C}, n AS (SELECT (SELECT count(*) FROM a) AS total,
        (SELECT count(*) FROM silver) AS valid, (SELECT count(*) FROM checked WHERE reason <> 'ok') AS invalid)
        SELECT *, total - valid - invalid AS duplicate FROM n""",
    "silver_profile": f"""{C} SELECT source, CASE WHEN language IN ('en', 'ar', 'fr') THEN language END AS language,
        count(*) AS article_count FROM silver GROUP BY ALL""",
    "bronze_sources": f"{A} SELECT count(DISTINCT nullif(source, '')) AS sources, count(*) AS articles FROM a",
    # Gold
    "articles_by_source": f"{C} {BY_SOURCE}",
    "articles_by_category": f"{C} {BY_CATEGORY}",
    "articles_by_language": f"{C} {BY_LANGUAGE}",
    "articles_by_date": f"{C} {BY_DATE}",
    "top_keywords": f"{C} {TOP}",
    "summary_stats": f"""{C} SELECT count(*) AS total_articles, count(DISTINCT source) AS total_sources,
        array_to_string(list_sort(list(DISTINCT source)), ',') AS sources,
        array_to_string(list_sort(list(DISTINCT language)), ',') AS languages,
        {AVERAGE} AS avg_content_length FROM silver""",
    "article_groups": f"""{C} SELECT source, category, language, {DAY} AS day, count(*) AS group_count,
        CAST(sum(content_length) AS BIGINT) AS group_length FROM silver GROUP BY ALL""",
    "sample_articles": f"""{C}, f AS (SELECT {SOURCE_KEY} AS file_name, pos, url FROM silver),
        r AS (SELECT *, dense_rank() OVER (ORDER BY file_name) AS file_no,
          row_number() OVER (PARTITION BY file_name ORDER BY pos) AS n FROM f)
        SELECT file_name, pos, url FROM r WHERE file_no <= 2 AND n <= 10""",
    "dashboard_extract": f"""{C}, f AS (SELECT {SOURCE_KEY} AS file_name, pos, url FROM silver),
        r AS (SELECT *, dense_rank() OVER (ORDER BY file_name) AS file_no,
          row_number() OVER (PARTITION BY file_name ORDER BY pos) AS n FROM f)
        SELECT (SELECT count(*) FROM silver) AS total_articles, (SELECT count(*) FROM ({BY_SOURCE})) AS sources,
          (SELECT count(*) FROM ({BY_LANGUAGE})) AS languages, (SELECT count(*) FROM ({BY_DATE})) AS days,
          (SELECT keyword FROM ({TOP}) ORDER BY frequency DESC, keyword LIMIT 1) AS first_keyword,
          (SELECT string_agg(url, ' ' ORDER BY file_name, pos) FROM r WHERE file_no <= 2 AND n <= 10) AS sample_urls""",
    # Warehouse
    "wh_dim_source": f"{C} {as_ints(BY_SOURCE, 'source')}",
    "wh_dim_category": f"{C} {as_ints(BY_CATEGORY, 'category')}",
    "wh_dim_language": f"{C} {as_ints(BY_LANGUAGE, 'language_code', 'language')}",
    "wh_fact_articles_by_day": rf"""{C} SELECT try_cast(date AS DATE) AS publication_day, CAST(article_count AS INT) AS article_count
        FROM ({BY_DATE}) WHERE regexp_full_match(date, '\d{{4}}-\d\d-\d\d') AND try_cast(date AS DATE) IS NOT NULL""",
    "wh_rejected_days": rf"""{C} SELECT * FROM ({BY_DATE})
        WHERE NOT regexp_full_match(date, '\d{{4}}-\d\d-\d\d') OR try_cast(date AS DATE) IS NULL""",
    "wh_fact_keywords": f"{C} {as_ints(TOP, 'keyword', count='frequency')}",
    "wh_fact_articles": f"""{C} SELECT sha256(url) AS url_hash, url, title, author,
        {iso_time('publication_date')} AS publication_date, category, content, content_length, source, language,
        {iso_time('scraped_at')} AS scraped_at, TIMESTAMP '2026-05-06 12:00:00' AS processed_at FROM silver""",
    "wh_summary": f"""{C} SELECT CAST(1 AS TINYINT) AS id, CAST(count(*) AS INT) AS total_articles,
        CAST(count(DISTINCT source) AS INT) AS total_sources, CAST({AVERAGE} AS DECIMAL(12,2)) AS avg_content_length,
        TIMESTAMP '2026-05-06 12:00:00' AS generated_at FROM silver""",
    "load_stats": f"""{C} SELECT 'articles' AS part, count(*) AS n FROM silver
        UNION ALL SELECT 'sources', count(*) FROM ({BY_SOURCE})
        UNION ALL SELECT 'categories', count(*) FROM ({BY_CATEGORY})
        UNION ALL SELECT 'languages', count(*) FROM ({BY_LANGUAGE})
        UNION ALL SELECT 'dates', count(*) FROM ({BY_DATE}) UNION ALL SELECT 'keywords', count(*) FROM ({TOP})""",
    # Lake
    "scan_articles": f"""{A} SELECT * EXCLUDE (pos), CAST(pos % 50 + 1 AS INT) AS place FROM a""",
    "json_roundtrip": f"{A} SELECT * FROM a",
    "bronze_history": f"""{A} SELECT {SOURCE_KEY} || '_' || run AS file_name, count(*) AS article_count
        FROM a, (VALUES ('{BATCH}'), ('{NEXT_BATCH}')) AS runs(run) GROUP BY 1""",
    "latest_snapshot": f"{C} SELECT pos, url, 'ok' AS reason FROM silver",
    "newest_run_without_pointer": f"{C} SELECT count(*) AS article_count FROM silver",
    "silver_build": f"""{checked_sql(SOURCE_KEY + ", pos")}
        SELECT *, {SOURCE_KEY} || '_{BATCH}' AS file_name FROM silver""",
    "lake_run": f"""{checked_sql(SOURCE_KEY + ", pos")}
        SELECT 'bronze' AS part, count(*) AS n FROM a
        UNION ALL SELECT unnest(['silver', 'events', 'warehouse_events', 'gold_articles', 'fact_articles']), count(*) FROM silver
        UNION ALL SELECT unnest(['articles_by_source', 'dim_source']), count(*) FROM ({BY_SOURCE})
        UNION ALL SELECT unnest(['articles_by_category', 'dim_category']), count(*) FROM ({BY_CATEGORY})
        UNION ALL SELECT unnest(['articles_by_language', 'dim_language']), count(*) FROM ({BY_LANGUAGE})
        UNION ALL SELECT 'articles_by_date', count(*) FROM ({BY_DATE})
        UNION ALL SELECT 'fact_articles_by_day', count(*) FROM ({BY_DATE}) WHERE try_cast(date AS DATE) IS NOT NULL
        UNION ALL SELECT unnest(['top_keywords', 'fact_keywords']), count(*) FROM ({TOP})
        UNION ALL SELECT unnest(['summary_stats', 'warehouse_summary']), 1""",
    # Events
    "event_sequence": f"{EVENTS} SELECT pos, url, sequence FROM numbered",
    "build_events": f"""{EVENTS} SELECT {event_id(BATCH)} AS event_id, 'article_published' AS event_type,
        '{BATCH}' AS batch_id, source, url, title, publication_date, language, category,
        content_length AS payload_length, sequence FROM numbered""",
    "event_upsert": f"""{EVENTS} {event_rows(BATCH, '2026-05-06 13:00:00')}
        UNION ALL {event_rows(NEXT_BATCH, '2026-05-06 13:00:00')}""",
    "event_upsert_stored": f"""{EVENTS} {event_rows(BATCH, '2026-05-06 13:00:00')}
        UNION ALL {event_rows(NEXT_BATCH, '2026-05-06 13:00:00')}""",
    "event_sequence_files": f"""{C}, f AS (SELECT 'f' || CAST(pos // 3 AS VARCHAR) AS file_name, pos * 1000003 AS pos, url FROM silver)
        SELECT *, row_number() OVER (ORDER BY file_name, pos) AS sequence FROM f""",
    "event_upsert_log": """WITH k AS (SELECT *, event_id % 9 <> 0 AS later FROM events),
        m AS (SELECT *, min(later::INT) OVER (PARTITION BY user_id) = later::INT AS counts FROM k)
        SELECT CAST(user_id AS VARCHAR) AS event_id,
        arg_min(event_type, (ts, event_type, value, event_id)) FILTER (WHERE counts) AS event_type,
        arg_min(value, (ts, event_type, value, event_id)) FILTER (WHERE counts) AS value, max(ts) AS loaded_at,
        arg_min(event_id, (ts, event_type, value, event_id)) FILTER (WHERE counts) AS log_id FROM m GROUP BY user_id""",
    "stream_publish": f"""{C} SELECT sha256('articles:' || CAST(pos + 1 AS VARCHAR) || ':' || url) AS event_id,
        'articles' AS batch_id, url, title, language, pos + 1 AS sequence FROM silver""",
    "stream_dedup": f"{A} SELECT DISTINCT url FROM a",
    "stream_dedup_exact": f"{KEPT.format(order='pos')} SELECT pos, url FROM kept",
    "stream_dedup_log": "SELECT DISTINCT user_id FROM events",
    # Pages and feeds
    "page_links": f"WITH {LINKS} SELECT page_id, pos, href FROM links",
    "page_links_resolved": f"WITH {LINKS} SELECT page_id, pos, resolved AS href FROM links",
    "link_filter": rf"""WITH {LINKS}, k AS (
        SELECT page_id, pos, ['hespress', 'akhbarona', 'barlamane'][page_id % 3 + 1] AS site, base,
          resolved || ['.html', '/12.html', '/tag/x', '/a/b', ''][pos % 5 + 1] AS href FROM links),
        p AS (SELECT *, substr(href, length(base) + 1) AS rest FROM k WHERE starts_with(href, base))
        SELECT page_id, pos, site, href FROM p
        WHERE (site = 'hespress' AND ends_with(href, '.html'))
          OR (site = 'akhbarona' AND regexp_matches(href, '/\d+\.html$'))
          OR (site = 'barlamane'
            AND NOT regexp_matches(href, '/category/|/page/|/tag/|/author/|/fr|/feed|/contact|/about')
            AND trim(rest, '/') <> '' AND length(trim(rest, '/')) - length(replace(trim(rest, '/'), '/', '')) <= 1)""",
    "top_links_per_page": f"""WITH {LINKS}, d AS (
        SELECT page_id, resolved AS href, min(pos) AS pos FROM links WHERE starts_with(resolved, base) GROUP BY ALL),
        r AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY pos) - 1 AS rank FROM d)
        SELECT page_id, CAST(rank AS INT) AS rank, href FROM r WHERE rank < 3""",
    "crawl_cap": f"""{A}, d AS (SELECT *, pos % 6 AS category_rank,
          row_number() OVER (PARTITION BY source, url ORDER BY pos % 6, pos) AS copy FROM a),
        r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY category_rank, pos) AS n
          FROM d WHERE copy = 1 AND title <> '' AND content <> '')
        SELECT source, url, category_rank, pos FROM r WHERE n <= 50""",
    "source_union_counts": f"""{A} SELECT s.source, count(a.source) AS article_count
        FROM (VALUES ('Hespress'), ('BBC News'), ('Barlamane'), ('Akhbarona'), ('Al Jazeera'), ('Reuters')) AS s(source)
        LEFT JOIN a USING (source) GROUP BY 1""",
    "page_title": f"SELECT page_id, {TITLE} AS title FROM pages",
    "page_body": f"SELECT page_id, {BODY} AS body FROM pages",
    "body_cut": f"SELECT page_id, substr({BODY}, 1, 5000) AS content FROM pages WHERE {BODY} <> ''",
    "page_metadata": f"""SELECT page_id, {TITLE} AS title, 'ByAnn& Bo' AS author, '2026-05-06' AS publication_date,
        'Worldnews' AS category, {BODY} AS content FROM pages""",
    "page_articles": f"""WITH s AS (SELECT *, page_id % 6 IN (0, 2, 3) AS listed, {SEGMENTS} AS seg FROM pages),
        c AS (SELECT *, CASE WHEN listed THEN {BODY} ELSE {PARAGRAPHS} END AS body FROM s)
        SELECT page_id, url, CASE WHEN listed THEN {TITLE} END AS title, CAST(NULL AS VARCHAR) AS author,
          CAST(NULL AS VARCHAR) AS publication_date, CAST(NULL AS VARCHAR) AS category, body AS content,
          ['Hespress', 'BBC News', 'Barlamane', 'Akhbarona', 'Al Jazeera', 'Reuters'][page_id % 6 + 1] AS source,
          CASE WHEN listed THEN 'ar' ELSE 'en' END AS language, '{STAMP}' AS scraped_at
        FROM c WHERE body <> '' AND (NOT listed OR {TITLE} <> '')""",
    "page_outcomes": f"""WITH s AS (SELECT *, page_id % 6 IN (0, 2, 3) AS listed, {SEGMENTS} AS seg FROM pages)
        SELECT ['hespress', 'bbc_news', 'barlamane', 'akhbarona', 'al_jazeera', 'reuters'][page_id % 6 + 1] AS site,
          count(*) AS pages, CAST(0 AS BIGINT) AS failed,
          count(*) FILTER (WHERE CASE WHEN listed THEN {BODY} ELSE {PARAGRAPHS} END <> '' AND (NOT listed OR {TITLE} <> '')) AS articles
        FROM s GROUP BY 1""",
    "bronze_build": f"{CRAWL} SELECT * FROM crawled",
    "crawl_to_gold": f"{CRAWL} SELECT source, count(*) AS bronze, true AS shown_whole FROM crawled GROUP BY source",
    "body_fallback": f"""SELECT page_id, CASE WHEN page_id % 5 = 0 OR page_id % 7 = 0 OR {BODY} = ''
        THEN 'about ' || url ELSE {BODY} END AS content FROM pages""",
    "rss_items": f"""WITH {FEED}, u AS (SELECT *, CASE WHEN site = 'al_jazeera' AND starts_with(link, '/')
          THEN 'https://www.aljazeera.com' || link ELSE link END AS url FROM feed)
        SELECT site, title, url, 'Mon, 06 May 2026 12:00:00 GMT' AS publication_date, description, category,
          CASE WHEN site = 'bbc_news' AND category = 'world' OR site = 'reuters' AND category = 'business' THEN 0
            WHEN site = 'bbc_news' THEN 1 ELSE 2 END AS category_rank FROM u
        WHERE title <> '' AND url <> '' AND NOT (site = 'bbc_news' AND NOT contains(url, 'bbc.com'))""",
    "rss_join_pages": f"""SELECT doc_id, p.url, {BODY} AS body FROM documents d JOIN pages p ON d.doc_id = p.page_id""",
    # Data quality
    "dq_q3_bronze_required": f"{A} " + violations("a", "bronze", required(["title", "content", "url", "source"], "article")),
    "dq_q4_bronze_short_content": f"{A} " + violations(
        "a", "bronze", [("content_quality", "Content is below the usual length", "length(content) BETWEEN 1 AND 99")]
    ),
    "dq_q7_silver_required": f"{FOREIGN} " + violations("f", "silver", SILVER_REQUIRED),
    "dq_q8_silver_markup": f"{FOREIGN} " + violations("f", "silver", [MARKUP]),
    "dq_q9_silver_language": f"{FOREIGN} " + violations("f", "silver", [LANGUAGE]),
    "dq_q10_silver_dates": f"{FOREIGN} " + violations("f", "silver", [DATES]),
    "dq_silver_clean": f"{C}, f AS (SELECT *, 'x' AS processed_at FROM silver) " + violations("f", "silver", SILVER_CHECKS),
    "dq_q13_event_required": f"{BROKEN_EVENTS} " + violations("e", "streaming", required(EVENT_FIELDS, "streaming event")),
    "dq_q14_event_type": f"{BROKEN_EVENTS} " + violations(
        "e", "streaming", [("invalid_event_type", "Event is of another type", "event_type <> 'article_published'")]
    ),
    "dq_q2_q6_files": "WITH b AS (SELECT DISTINCT doc_id // 50 AS block FROM documents) " + violations(
        "b", "bronze",
        [("format_error", "No JSON array", "block % 3 = 1"), ("file_error", "Unreadable file", "block % 3 = 2")], "ERROR",
    ),
    "dq_q1_q5_bronze_layer": f"""{A} SELECT 'bronze' AS layer, 'missing_data' AS type, 'ERROR' AS severity,
        'Layer holds no data files' AS message, CAST(0 AS BIGINT) AS violations
        UNION ALL SELECT 'bronze', 'data_freshness', 'WARNING', 'No new file for a day', 1 UNION ALL """ + violations(
        "a", "bronze",
        [*required(["title", "content", "url", "source"], "article"),
         ("content_quality", "Content is below the usual length", "length(content) BETWEEN 1 AND 99")],
    ),
    "dq_q1_no_bronze": """SELECT 'bronze' AS layer, 'missing_data' AS type, 'ERROR' AS severity, 'Layer holds no data files' AS message,
        CAST(count(*) > 0 AS BIGINT) AS violations FROM documents""",
    "dq_q12_empty_events": """SELECT 'streaming' AS layer, 'empty_data' AS type, 'WARNING' AS severity,
        'Published event run has no rows' AS message, CAST(count(*) > 0 AS BIGINT) AS violations FROM documents""",
    "dq_report_stats": f"""{checked_sql(SOURCE_KEY + ", pos")} SELECT count(*) AS total_articles, true AS has_bronze, CAST(0 AS BIGINT) AS gold_files,
        CAST(1 AS BIGINT) AS damaged_layers FROM silver""",
    "silver_incremental": f"""{checked_sql(SOURCE_KEY + ", CASE WHEN pos % 3 = 0 THEN 1 ELSE 0 END, pos")}
        SELECT pos, url, title, content_length, language, reason FROM checked""",
    "lake_facts": f"""{checked_sql(SOURCE_KEY + ", pos")}, r AS (
          SELECT 'bronze' AS layer, language, source FROM a UNION ALL SELECT 'silver', language, source FROM silver)
        SELECT layer, 'total' AS kind, CAST(NULL AS VARCHAR) AS name, count(*) AS articles FROM r GROUP BY layer
        UNION ALL SELECT layer, 'language', language, count(*) FROM r GROUP BY layer, language
        UNION ALL SELECT layer, 'source', source, count(*) FROM r GROUP BY layer, source""",
    "crawl_outcomes": f"""{CRAWL} SELECT ['hespress', 'bbc_news', 'barlamane', 'akhbarona', 'al_jazeera', 'reuters'][k + 1] AS site,
        CASE WHEN k = 5 THEN 0 ELSE count(*) END AS pages, CAST(0 AS BIGINT) AS failed,
        CASE WHEN k IN (0, 5) THEN 0 ELSE count(*) FILTER (WHERE content <> '' AND title <> '') END AS articles FROM c GROUP BY k""",
    "feed_outcomes": f"""WITH {FEED} SELECT site, category, CASE WHEN site = 'reuters' THEN 0 ELSE count(*) END AS items,
        site = 'reuters' AS unreadable FROM feed GROUP BY site, category""",
    "dq_damaged_pages": f"""{A} SELECT coalesce(pos % 64, 0) AS part, count(*) AS n_rows,
        CASE WHEN coalesce(pos % 64, 0) = 1 THEN CAST(0 AS BIGINT) ELSE count(*) END AS n_readable,
        CASE WHEN coalesce(pos % 64, 0) = 1 THEN 'file_error' ELSE 'ok' END AS status FROM a GROUP BY coalesce(pos % 64, 0)""",
    "articles_per_language_and_source": f"""{A} SELECT 'language' AS kind, language AS name, count(*) AS article_count FROM a GROUP BY language
        UNION ALL SELECT 'source', source, count(*) FROM a GROUP BY source""",
    "gold_defaults": f"""{C} SELECT 'articles_by_source' AS part, count(*) AS n FROM ({BY_SOURCE})
        UNION ALL SELECT unnest(['articles_by_category', 'articles_by_language', 'articles_by_date', 'top_keywords', 'summary_stats']), 0""",
    "run_report": f"""{checked_sql(SOURCE_KEY + ", pos")}
        SELECT unnest(['silver', 'gold', 'quality', 'dashboard']) AS step, 'completed' AS status, true AS success, CAST(NULL AS BIGINT) AS rows
        UNION ALL SELECT 'bronze', 'completed', true, count(*) FROM a
        UNION ALL SELECT unnest(['streaming', 'warehouse']), 'completed', true, count(*) FROM silver""",
    "dq_q11_q12_event_layer": """SELECT 'streaming' AS layer, 'missing_latest' AS type, 'WARNING' AS severity,
        'No event run is published' AS message, CAST(count(*) > 0 AS BIGINT) AS violations FROM documents""",
    "dq_q15_q19_gold_layer": f"""{C}, bad AS (SELECT count(*) AS n FROM ({BY_SOURCE}) WHERE starts_with(source, 'src'))
        SELECT 'gold' AS layer, type, severity, message, CAST(n AS BIGINT) AS violations FROM (
        SELECT 'missing_file' AS type, 'ERROR' AS severity, 'Table ' || t || ' was not written' AS message, CAST(t = 'articles_by_date' AS INT) AS n
          FROM (SELECT unnest(['articles_by_source', 'articles_by_category', 'articles_by_language', 'articles_by_date', 'top_keywords', 'summary_stats']) AS t)
        UNION ALL SELECT 'empty_data', 'WARNING', 'Table ' || t || ' has no rows', CAST(t = 'articles_by_category' AS INT)
          FROM (SELECT unnest(['articles_by_source', 'articles_by_category', 'articles_by_language', 'top_keywords']) AS t)
        UNION ALL SELECT 'structure_error', 'WARNING', 'Rows of articles_by_source lack a value', n FROM bad
        UNION ALL SELECT 'structure_error', 'WARNING', 'Rows of ' || t || ' lack a value', 0
          FROM (SELECT unnest(['articles_by_language', 'top_keywords']) AS t)
        UNION ALL SELECT 'missing_key', 'WARNING', 'Summary has no ' || t, 0
          FROM (SELECT unnest(['total_articles', 'total_sources', 'generated_at']) AS t)
        UNION ALL SELECT 'invalid_stats', 'WARNING', 'No article counted', 0)""",
    "dq_q16_q17_summary": f"""{C}, s AS (SELECT CAST(0 AS BIGINT) AS total_articles, CAST(0 AS BIGINT) AS total_sources, NULL AS generated_at
        UNION ALL SELECT count(*), count(DISTINCT source), '{STAMP}' FROM silver) """ + violations(
        "s", "gold",
        [("missing_key", f"Summary has no {f}", f"{f} IS NULL") for f in ("total_articles", "total_sources", "generated_at")]
        + [("invalid_stats", "No article counted", "coalesce(total_articles, 0) <= 0")],
    ),
    "dq_q20_q21_consistency": f"""{C}, n AS (SELECT (SELECT 2 * count(*) FROM a) AS bronze,
        (SELECT count(*) FROM silver) AS silver, (SELECT count(*) FROM checked) AS gold)
        SELECT *, silver < bronze * 0.8 AS article_count_mismatch, abs(gold - silver) > 5 AS summary_mismatch FROM n""",
    "dq_q22_score": f"""{A}, i AS (SELECT source, count(*) FILTER (WHERE title = '') % 3 AS errors,
        count(*) FILTER (WHERE author IS NULL) % 12 AS warnings FROM a GROUP BY 1),
        s AS (SELECT *, {score('errors', 'warnings')} AS quality_score FROM i)
        SELECT *, {verdict('quality_score')} AS verdict FROM s""",
    "dq_q23_report": f"""{FOREIGN}, i AS ({violations("f", "silver", SILVER_CHECKS)}),
        t AS (SELECT CAST(0 AS BIGINT) AS errors, CAST(sum(violations) AS BIGINT) AS warnings,
          count(*) FILTER (WHERE violations > 0) AS fired FROM i),
        s AS (SELECT *, {score('errors', 'warnings')} AS quality_score FROM t)
        SELECT errors, warnings, quality_score, {verdict('quality_score')} AS verdict, quality_score >= 75 AS acceptable, fired FROM s""",
    "dq_w9_sample_issues": f"""{FOREIGN}, v AS ({" UNION ALL ".join(
        f"SELECT pos, {i} AS check_no, '{kind}' AS type, 'WARNING' AS severity, '{message}' AS message FROM f WHERE {condition}"
        for i, (kind, message, condition) in enumerate(SILVER_CHECKS))})
        SELECT pos, type, severity, message FROM v ORDER BY pos, check_no LIMIT 5""",
}

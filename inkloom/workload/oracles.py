"""Expected results as plain SQL over the given tables (DuckDB dialect).

Nothing here parses a payload: payloads are built from relational columns, so
the SQL states the outcome from those columns directly.
"""

from __future__ import annotations

from inkloom.workload.payloads import BASE
from inkloom.workload.registry import CATALOG_SEARCH, SEARCH, SIZE_LIMIT

EPOCH = 1_700_000_000

# Fixed values, written out again so that a slip in the code under test shows.
BLOCK_TAGS = "p br hr li blockquote pre h1 h2 h3 h4 h5 h6 tr table ul ol div".split()
UNSAFE_TAGS = "script style iframe object embed noscript form svg canvas video audio".split()


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def sub(x: str, pattern: str, by: str, flags: str = "g") -> str:
    return f"regexp_replace({x}, {q(pattern)}, {by}, {q(flags)})"


NL, TAB, CR, NBSP = "chr(10)", "chr(9)", "chr(13)", "chr(160)"
TRIMMED = f"' ' || {NL} || {TAB} || {CR} || {NBSP}"


def safe_sql(x: str) -> str:
    for tag in UNSAFE_TAGS:
        x = sub(x, rf"<{tag}\b[^>]*>.*?</{tag}\s*>", "''", "gis")
    x = sub(x, r"<!--.*?-->", "''", "gs")
    return sub(x, r"<!DOCTYPE.*?>", "''", "gis")


def entities_sql(x: str) -> str:
    """The entities that occur in the pages; '&amp;' last."""
    named = [("lt", "'<'"), ("gt", "'>'"), ("quot", "'\"'"), ("apos", "''''"), ("nbsp", "' '"), ("#46", "'.'"), ("#x41", "'A'"), ("#160", NBSP), ("amp", "'&'")]
    for name, char in named:
        x = f"replace({x}, '&{name};', {char})"
    return x


def text_sql(x: str) -> str:
    x = sub(x, rf"</?({'|'.join(BLOCK_TAGS)})\b[^>]*>", NL, "gi")
    x = entities_sql(sub(x, "<[^>]+>", "''"))
    x = f"replace({x}, {CR}, '')"
    x = sub(x, r"[\t ]+\n", NL)
    x = sub(x, r"\n[\t ]+", NL)
    x = sub(x, r"\n{3,}", f"{NL} || {NL}")
    x = sub(x, r"[\t ]{2,}", "' '")
    return f"trim({x}, {TRIMMED})"


def pct_sql(x: str) -> str:
    """Escapes of a rooted link: spaces and letters outside ASCII."""
    x = f"url_encode({x})"
    for code, char in (("%2F", "/"), ("%2C", ","), ("%3A", ":"), ("%3F", "?"), ("%23", "#"), ("%21", "!"), ("%26", "&"), ("%3D", "="), ("%2B", "+"), ("%3B", ";"), ("%24", "$"), ("%40", "@"), ("%28", "("), ("%29", ")"), ("%2A", "*"), ("%25", "%"), ("%27", "''")):
        x = f"replace({x}, '{code}', '{char}')"
    return x


MARKUP = """
    '<p style="text-align:center;color:red; Font-Weight : bold;position:x" onclick="bad()">No&#46; ' || page_id || ' &#x41;&#160;&lt;b&gt;</p>'
    || '<img data-lazy-src="/images/' || page_id || '.jpg" onerror="bad()" alt="pic &amp; ' || page_id || '" width="120" height="x">'
    || '<IMG src='''' data-src=''/images/' || (page_id % 7) || '.png''><img src=/images/' || page_id || '.jpg>'
    || '<img data-src="javascript:bad"><td colspan="2" rowspan=1000 align=RIGHT>c</td><ol start="-3"><del>d</del></ol>'
    || '<a href="mailto:a@b.example" title="A &quot;q&quot;">m</a><a href="javascript:x()">j</a><hr/></br><blink>k</blink>'
"""

LINE_SLUG = "'line-' || l_linenumber || '-' || l_partkey"
LINE_BOOK = "'order-' || l_orderkey"
CAST_D = "CAST(NULL AS DOUBLE)"
NULL_S = "CAST(NULL AS VARCHAR)"

# chapters of orders: number and fields of the i-th
ORDER_CHAPTERS = """
    SELECT o_orderkey, 'order-' || o_orderkey AS parent_slug, l.* FROM orders JOIN (
      SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY CAST(round(l_extendedprice * 100) AS BIGINT) * 100000 + l_suppkey * 10 + l_linenumber, l_partkey) AS i FROM lineitem
    ) l ON l_orderkey = o_orderkey WHERE o_orderkey % 10 <> 9
"""

TALK = f"""
    SELECT 'conv-' || conv_id AS book_slug, turn, 'turn-' || turn AS slug, role, text,
           role = 'assistant' AND length(text) % 2 = 0 AS paid,
           role = 'user' AND turn >= 6 AS gone,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) - 1 AS up,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS down
    FROM conversations
"""
TALK_CODED = f"""
    SELECT *, CASE WHEN role = 'system' OR gone THEN 'NOT_FOUND' WHEN paid THEN 'CHAPTER_UNAVAILABLE' END AS error_code
    FROM ({TALK})
"""
PART_ID = "CASE WHEN p_size % 2 = 0 THEN CAST(p_partkey AS VARCHAR) ELSE 'B' || p_partkey END"
PART_SLUG = f"CASE WHEN p_partkey % 3 < 2 THEN 'part-' || p_partkey ELSE {PART_ID} END"
PART_PAGE = f"p_partkey // 20 + 1"
PART_TITLE = f"CASE WHEN p_partkey % 7 = 0 THEN {PART_SLUG} ELSE p_name END"
LAST = lambda value: f"CASE WHEN p_partkey % 4 = 0 THEN {value} END"

LINES = """
    SELECT l_orderkey AS book_slug,
           CAST(round(l_extendedprice * 100) AS BIGINT) * 100000 + l_suppkey * 10 + l_linenumber AS pos,
           CAST(floor(l_quantity / 10) AS DOUBLE) AS volume,
           CASE WHEN l_linenumber < 6 THEN CAST(l_linenumber AS DOUBLE) END AS number,
           'part-' || lpad(CAST(l_partkey AS VARCHAR), 9, '0') AS title,
           l_returnflag = 'R' AS is_donate, l_linestatus = 'O' AS is_subscription
    FROM lineitem
"""


def _ranked(order: str, by: str, start: int, to: int | None) -> str:
    stop = "" if to is None else f"AND rank <= {to}"
    return f"""
    SELECT '{order}' AS wanted, book_slug, pos, title, rank, rank - {start} AS "index" FROM (
      SELECT *, row_number() OVER (PARTITION BY book_slug ORDER BY {by}) - 1 AS rank FROM ({LINES})
    ) WHERE rank >= {start} {stop}"""


LOG = """
    SELECT event_id, '/u/' || user_id AS url, ts, event_type,
           lpad(CAST(event_id AS VARCHAR), 12, '0') AS capture_id,
           'build-' || dayofyear(ts) AS build_id,
           CASE event_type WHEN 'error' THEN 500 WHEN 'signup' THEN 404 WHEN 'click' THEN 429 ELSE 200 END AS status,
           CASE event_type WHEN 'view' THEN 'chapter' WHEN 'click' THEN 'catalog' WHEN 'purchase' THEN 'book'
                           WHEN 'signup' THEN 'page_html' ELSE 'build_id' END AS kind,
           value, props
    FROM events
"""

# tokens of cleaned pages: every tag that can occur, written out
CLEAN_TOKEN = f"""
    CASE
      WHEN t NOT LIKE '<%' THEN t
      WHEN t LIKE '<p style=%' THEN '<p style="text-align:center;font-weight:bold">'
      WHEN t LIKE '<img data-lazy-src=%' THEN '<img src="{BASE}/images/' || page_id || '.jpg" alt="pic &amp; ' || page_id || '" width="120" loading="lazy" decoding="async">'
      WHEN t LIKE '<IMG src='''' %' THEN '<img src="{BASE}/images/' || (page_id % 7) || '.png" alt="" loading="lazy" decoding="async">'
      WHEN t LIKE '<img src=/%' THEN '<img src="{BASE}/images/' || page_id || '.jpg" alt="" loading="lazy" decoding="async">'
      WHEN t LIKE '<img%' THEN ''
      WHEN t LIKE '<td %' THEN '<td colspan="2" style="text-align:right">'
      WHEN t LIKE '<ol %' THEN '<ol start="-3">'
      WHEN t = '<del>' THEN '<s>' WHEN t = '</del>' THEN '</s>'
      WHEN t = '<b>' THEN '<strong>' WHEN t = '</b>' THEN '</strong>'
      WHEN t = '<hr/>' THEN '<hr>' WHEN t = '</br>' THEN ''
      WHEN t LIKE '<a href="mailto:%' THEN '<a href="mailto:a@b.example" title="A &quot;q&quot;">'
      WHEN t LIKE '<a href="javascript:%' THEN '<a>'
      WHEN t LIKE '<a href="/%' THEN '<a href="{BASE}' || {pct_sql("regexp_extract(t, 'href=\"([^\"]*)\"', 1)")} || '" rel="noopener noreferrer nofollow">'
      WHEN regexp_matches(t, '^<div[ >]') THEN '<div>'
      WHEN regexp_matches(t, '^</?(p|br|hr|li|ul|ol|td|a|h1|div)>$') THEN t
      ELSE ''
    END
"""


def clean_sql(x: str) -> str:
    return f"trim(array_to_string(list_transform(regexp_extract_all({safe_sql(x)}, '<[^>]*>|[^<]+'), lambda t: {CLEAN_TOKEN}), ''), {TRIMMED})"


PAGES_MARKED = f"SELECT page_id, {MARKUP} || html AS html FROM pages"
PAGES_CLEAN = f"SELECT page_id, html, {clean_sql('html')} AS formatted_html FROM ({PAGES_MARKED})"


ORACLES: dict[str, str] = {}

ORACLES["load_captures"] = f"""
SELECT 'page-' || page_id AS capture_id, 'page_html' AS kind, false AS is_json, {NULL_S} AS object_id, strlen(html) AS html_bytes FROM pages
UNION ALL
SELECT 'book-' || o_orderkey, 'book', true, CASE WHEN o_orderkey % 10 <> 9 THEN CAST(o_orderkey AS VARCHAR) END, NULL FROM orders
UNION ALL
SELECT 'line-' || l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey, 'chapter', true, CAST(l_partkey AS VARCHAR), NULL FROM lineitem
"""

ORACLES["quarantine_payloads"] = f"""
SELECT 'd' || doc_id AS capture_id, CASE WHEN strlen(text) > {SIZE_LIMIT} THEN 'RESPONSE_TOO_LARGE' ELSE 'INVALID_PAYLOAD' END AS error_code,
       CASE WHEN strlen(text) <= {SIZE_LIMIT} THEN substr(text, 1, 500) END AS preview, {NULL_S} AS k, CAST(NULL AS BOOLEAN) AS k_is_num
FROM documents
UNION ALL
SELECT 'e' || event_id, NULL, NULL, regexp_extract(props, '"k": ([0-9]+)', 1), true FROM events
"""

ORACLES["classify_fetches"] = f"""
SELECT event_id, code, retryable, retry_after_ms,
       CASE WHEN retryable THEN CASE WHEN retry_after_ms IS NULL THEN floor(backoff * 0.8 + 0.5) ELSE least(8000.0, retry_after_ms) END END AS delay_low_ms,
       CASE WHEN retryable THEN CASE WHEN retry_after_ms IS NULL THEN floor(backoff * 1.2 + 0.5) ELSE least(8000.0, retry_after_ms) END END AS delay_high_ms
FROM (
  SELECT event_id,
         CASE status WHEN 200 THEN 'OK' WHEN 404 THEN 'NOT_FOUND' ELSE 'HTTP_ERROR' END AS code,
         status IN (429, 500) AND event_id % 6 < 4 AS retryable,
         CASE WHEN event_type = 'click' AND event_id % 3 = 0
                THEN CAST((epoch_us(ts) // 1000000 + 5) * 1000 - epoch_us(ts) // 1000 AS DOUBLE)
              WHEN event_type = 'click' AND event_id % 3 = 1 THEN value * 1000 END AS retry_after_ms,
         least(8000.0, 250.0 * pow(2.0, event_id % 6)) AS backoff
  FROM ({LOG})
)
"""

ORACLES["latest_per_url"] = f"""
SELECT url, event_id, status, epoch_us(ts) AS fetched_us FROM ({LOG})
QUALIFY row_number() OVER (PARTITION BY url ORDER BY ts DESC, capture_id DESC) = 1
"""

ORACLES["stale_captures"] = f"""
WITH newest AS (SELECT kind, url, max(ts) AS ts FROM ({LOG}) GROUP BY kind, url),
     ttl(kind, ms) AS (VALUES ('build_id', 300000), ('catalog', 30000), ('book', 300000), ('chapter', 900000), ('page_html', 300000))
SELECT kind, url, epoch_us(ts) AS fetched_us, epoch_us(ts) // 1000 + ms AS expires_ms
FROM newest JOIN ttl USING (kind)
WHERE epoch_us(ts) // 1000 + ms <= (SELECT epoch_us(max(ts)) FROM events) / 1000.0
"""

ORACLES["page_embedded_data"] = f"""
SELECT *, CASE WHEN build_id IS NULL THEN 'BUILD_ID_NOT_FOUND' END AS error_code FROM (SELECT page_id,
       CASE page_id % 4 WHEN 0 THEN 'build-' || page_id WHEN 1 THEN 'q' || page_id WHEN 2 THEN 'static ' || page_id END AS build_id,
       CASE page_id % 4 WHEN 0 THEN '/a&b' END AS data_page,
       CASE page_id % 4 WHEN 0 THEN '<' END AS data_note,
       page_id % 4 < 2 AS has_data
FROM pages)
"""

ORACLES["current_build_captures"] = f"""
WITH log AS ({LOG}), newest AS (SELECT build_id AS current FROM log ORDER BY ts DESC, capture_id DESC LIMIT 1)
SELECT url AS route, event_id, build_id, status FROM log, newest
QUALIFY row_number() OVER (PARTITION BY url ORDER BY build_id = current DESC, status = 200 DESC, ts DESC, capture_id DESC) = 1
"""

_SITES = f"""
  SELECT 'site' || (user_id % 2) AS site, '/r/' || (user_id % 97) AS route, event_id, lpad(CAST(event_id AS VARCHAR), 12, '0') AS capture_id, l.status, e.ts AS moment,
         'b' || (epoch_us(e.ts) // 864000000000 - CASE WHEN event_id % 5 = 0 THEN 1 ELSE 0 END) AS build_id
  FROM events e JOIN ({LOG}) l USING (event_id)
"""
ORACLES["captures_by_build"] = f"""
WITH log AS ({_SITES}),
firsts AS (SELECT site, build_id, min({{'moment': moment, 'id': capture_id}}) AS first FROM log GROUP BY ALL),
builds AS (SELECT site, build_id, first.moment AS since, lead(first.moment) OVER o AS until, lead(build_id) OVER o AS next_build FROM firsts WINDOW o AS (PARTITION BY site ORDER BY first))
SELECT l.site, route, event_id, l.build_id, c.build_id AS current_build, CASE WHEN status = 404 THEN own.next_build END AS retry_build, status
FROM log l LEFT JOIN builds c ON c.site = l.site AND l.moment >= c.since AND (c.until IS NULL OR l.moment < c.until)
JOIN builds own ON own.site = l.site AND own.build_id = l.build_id
QUALIFY row_number() OVER (PARTITION BY l.site, route ORDER BY status <> 404 DESC, own.since DESC, status = 200 DESC, moment DESC, capture_id DESC) = 1
"""

ORACLES["fetch_plan"] = f"""
SELECT DISTINCT 'book' AS kind, 'order-' || key AS book_slug, {NULL_S} AS chapter_slug, '/_next/data/build%201/order-' || key || '.json' AS request
FROM (SELECT o_orderkey AS key FROM orders)
UNION ALL
SELECT DISTINCT 'chapter', {LINE_BOOK}, 'глава ' || l_linenumber || '!',
       '/_next/data/build%201/order-' || l_orderkey || '/%D0%B3%D0%BB%D0%B0%D0%B2%D0%B0%20' || l_linenumber || '!.json' FROM lineitem
UNION ALL
SELECT DISTINCT 'catalog', {NULL_S}, {NULL_S},
       '/v3/books?genre=a+b&genre=c&page=' || ({PART_PAGE}) || '&pageSize=100&expand=lastChapter%2CverticalImage%2ChorizontalImage%2CsquareImage%2CuserRating' FROM part
UNION ALL
SELECT DISTINCT 'catalog_data', {NULL_S}, {NULL_S},
       '/_next/data/build%201/books/all.json?page=' || ({PART_PAGE}) || '&pageSize=100&order=new&expand=lastChapter%2CverticalImage%2ChorizontalImage%2CsquareImage%2CuserRating' FROM part
UNION ALL
SELECT DISTINCT 'page_html', {LINE_BOOK}, 'глава ' || l_linenumber || '!', '/order-' || l_orderkey || '/%D0%B3%D0%BB%D0%B0%D0%B2%D0%B0%20' || l_linenumber || '!' FROM lineitem
"""

ORACLES["catalog_items"] = f"""
SELECT {PART_PAGE} AS page, p_partkey % 20 AS pos, {PART_ID} AS id, p_size % 2 = 0 AS id_is_num FROM part
"""

ORACLES["catalog_page_info"] = f"""
SELECT page, (SELECT max(p_partkey) + 1 FROM part) AS total_count, (SELECT max(p_partkey) // 20 + 1 FROM part) AS page_count,
       page AS current_page, CASE WHEN page % 7 IN (1, 3) THEN 20 ELSE 20 END AS per_page, n AS n_items
FROM (SELECT {PART_PAGE} AS page, count(*) AS n FROM part GROUP BY 1)
"""

_SOURCE = """
SELECT '{mode}' AS mode, page, {pick} FROM pages
"""
_V3 = "'v3-' || page AS capture_id, 'v3' AS source, '/books' AS route"
ORACLES["catalog_source_select"] = f"""
WITH pages AS (SELECT DISTINCT {PART_PAGE} AS page FROM part),
next AS (
  SELECT page, CASE WHEN page % 5 = 0 THEN 'home-' ELSE 'books-' END || page AS capture_id, 'next' AS source,
         CASE WHEN page % 5 = 0 THEN '/' ELSE '/books' END AS route, {NULL_S} AS error_code FROM pages
)
SELECT 'auto' AS mode, * FROM next WHERE page % 3 <> 0
UNION ALL SELECT 'auto', page, {_V3}, NULL FROM pages WHERE page % 3 = 0
UNION ALL SELECT 'next', * FROM next
UNION ALL SELECT 'v3', page, {_V3}, CASE page % 3 WHEN 1 THEN 'INVALID_PAYLOAD' WHEN 2 THEN 'HTTP_ERROR' END FROM pages
"""

ORACLES["catalog_traverse"] = f"""
SELECT page, n AS n_items FROM (SELECT {PART_PAGE} AS page, count(*) AS n FROM part GROUP BY 1)
WHERE page >= 2 AND page <= greatest(3, (SELECT max(p_partkey) // 20 - 1 FROM part))
"""

ORACLES["traverse_catalogs"] = """
WITH pages AS (
  SELECT p_brand, p_size, p_partkey % 4 + 1 AS page, count(*) FILTER (p_partkey % 11 > 0) AS n_items, max(CASE WHEN p_partkey % 13 = 0 THEN 2 END) AS page_count
  FROM part GROUP BY ALL
),
runs AS (SELECT *, row_number() OVER c AS place, min(CASE WHEN n_items = 0 OR page >= page_count THEN page END) OVER (PARTITION BY p_brand, p_size) AS stop
         FROM pages WINDOW c AS (PARTITION BY p_brand, p_size ORDER BY page))
SELECT p_brand, p_size, page, n_items FROM runs WHERE page = place AND (stop IS NULL OR page <= stop)
"""

ORACLES["book_summaries"] = f"""
SELECT {PART_PAGE} AS page, p_partkey % 20 AS pos, {PART_ID} AS id, p_size % 2 = 0 AS id_is_num, {PART_SLUG} AS slug,
       CASE WHEN p_partkey % 3 = 1 THEN '{BASE}/part-' || p_partkey || '/about?x=1' ELSE '{BASE}/' || ({PART_SLUG}) END AS url,
       {PART_TITLE} AS title, 'En ' || p_name AS title_en, '<p>' || p_type || ' &amp; ' || p_brand || '</p>' AS description_html,
       p_type AS status, CAST(p_size AS BIGINT) AS views, CAST(floor(p_retailprice) AS BIGINT) AS likes, CAST(NULL AS BIGINT) AS dislikes,
       {LAST("CAST(p_partkey * 10 AS VARCHAR)")} AS last_id, {LAST("true")} AS last_id_is_num,
       {NULL_S} AS last_book_id, CAST(NULL AS BOOLEAN) AS last_book_id_is_num,
       {LAST("'last-' || p_size")} AS last_slug, {LAST("'part-' || p_partkey")} AS last_book_slug,
       {LAST(f"'{BASE}/part-' || p_partkey || '/last-' || p_size")} AS last_url,
       {LAST("'Chapter ' || p_size || ',5 end'")} AS last_title, {NULL_S} AS last_number_label,
       {LAST("p_size + 0.5::DOUBLE")} AS last_number, {LAST("CAST(p_size AS DOUBLE)")} AS last_volume,
       {NULL_S} AS last_published_at, {NULL_S} AS last_created_at, {NULL_S} AS last_updated_at,
       CAST(NULL AS BIGINT) AS last_views, {CAST_D} AS last_price, {LAST("true")} AS last_is_donate,
       {LAST("false")} AS last_is_subscription, {LAST("false")} AS last_is_sponsored,
       CAST(NULL AS BOOLEAN) AS last_is_edited, CAST(NULL AS BOOLEAN) AS last_is_user_paid
FROM part
"""


def norm_sql(x: str) -> str:
    return f"trim(regexp_replace(lower({x}), '\\s+', ' ', 'g'))"


_SEARCHED = f"""
  SELECT 'p' || page_id AS key, regexp_extract(html, '<title[^>]*>(.*?)</title>', 1, 'is') AS title, {text_sql(safe_sql("html"))} AS text FROM pages
  UNION ALL
  SELECT 'd' || doc_id, source, {text_sql("text")} FROM documents
"""
ORACLES["search_books"] = f"""
SELECT key, title FROM ({_SEARCHED}) WHERE contains({norm_sql("title")}, {norm_sql(q(SEARCH))}) OR contains({norm_sql("text")}, {norm_sql(q(SEARCH))})
"""

ORACLES["search_many_needles"] = f"""
WITH searched AS (SELECT key, {norm_sql("title")} AS title, {norm_sql("text")} AS text FROM ({_SEARCHED})),
needles AS (
  SELECT DISTINCT needle, {norm_sql("needle")} AS wanted FROM (
    SELECT substr(text, doc_id % 50 + 1, CASE WHEN doc_id % 3 = 0 THEN 2 ELSE 9 END) AS needle FROM documents WHERE doc_id % 20 = 0
    UNION ALL SELECT unnest(string_split(p_name, ' ')) FROM part
  )
)
SELECT needle, key FROM needles JOIN searched ON wanted <> '' AND (contains(title, wanted) OR contains(text, wanted))
"""

ORACLES["search_catalog_captures"] = f"""
SELECT {PART_PAGE} AS page, p_partkey % 20 AS pos, {PART_ID} AS id, {PART_TITLE} AS title FROM part
WHERE contains(lower({PART_TITLE}), {norm_sql(q(CATALOG_SEARCH.replace(chr(9), ' ')))}) OR contains(lower('En ' || p_name), {norm_sql(q(CATALOG_SEARCH.replace(chr(9), ' ')))})
   OR contains(lower(p_type || ' & ' || p_brand), {norm_sql(q(CATALOG_SEARCH.replace(chr(9), ' ')))})
"""

_B = lambda value: f"CASE WHEN o_orderkey % 10 <> 9 THEN {value} END"
_CUST = "'Customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0')"
_C = lambda value: f"CASE WHEN o_orderkey % 10 <> 9 AND o_orderkey % 3 = 0 THEN {value} END"
ORACLES["book_details"] = f"""
SELECT 'order-' || o_orderkey AS book_slug, CASE WHEN o_orderkey % 10 = 9 THEN 'INVALID_PAYLOAD' END AS error_code,
       {_B("CAST(o_orderkey AS VARCHAR)")} AS id, {_B("'order-' || o_orderkey")} AS slug,
       {_B(f"'{BASE}/order-' || o_orderkey || CASE WHEN o_orderkey % 4 = 3 THEN '/' ELSE '' END")} AS url,
       {_B("o_orderpriority || ' ' || o_orderkey")} AS title, {_B("o_orderstatus")} AS status,
       {_B("CAST(floor(o_totalprice) AS BIGINT)")} AS views, {_B("'Full ' || o_orderkey")} AS full_title, {_B(_CUST)} AS author,
       {_C("CAST(o_custkey % 25 AS VARCHAR)")} AS country_id, {_C("true")} AS country_id_is_num,
       {_C("'NATION_' || (o_custkey % 25)")} AS country_title, {_C("'n' || (o_custkey % 25)")} AS country_code,
       {_B("'<b>' || o_orderpriority || '</b>'")} AS additional_info_html, {NULL_S} AS important_info_html,
       {_B("o_totalprice")} AS chapter_cost
FROM orders
"""

ORACLES["book_genres"] = f"""
SELECT book_id, row_number() OVER (PARTITION BY book_id ORDER BY i) - 1 AS pos, CAST(i AS VARCHAR) AS id, true AS id_is_num, w AS title,
       CASE WHEN i % 2 = 0 THEN upper(w) ELSE lower(w) END AS slug
FROM (
  SELECT {PART_ID} AS book_id, unnest(words) AS w, unnest(range(len(words))) AS i
  FROM (SELECT *, list_concat(string_split(p_name, ' '), [' ', p_type]) AS words FROM part)
) WHERE trim(w) <> ''
"""

ORACLES["book_images"] = f"""
WITH slots AS (
  SELECT {PART_ID} AS book_id, 0 AS pos, '{BASE}/img/' || p_brand || '.png' AS url, 'vertical' AS kind, {NULL_S} AS path, * FROM part
  UNION ALL SELECT {PART_ID}, 1, '{BASE}/img/h/' || p_partkey || '.jpg', 'horizontal', '/img/h/' || p_partkey || '.jpg', * FROM part
  UNION ALL SELECT {PART_ID}, 2, 'https://cdn.example/' || p_partkey || '%20v.png', 'horizontal', NULL, * FROM part WHERE p_partkey % 2 = 0
)
SELECT book_id, pos, url, kind, CAST(p_partkey AS VARCHAR) AS id, true AS id_is_num, path, p_type AS name, p_name AS alt FROM slots
"""

ORACLES["book_people"] = f"""
WITH o AS (SELECT 'order-' || o_orderkey AS book_slug, {_CUST} AS cname, * FROM orders WHERE o_orderkey % 10 <> 9)
SELECT book_slug, 0 AS pos, 'translator' AS role, CAST(o_custkey AS VARCHAR) AS id, o_orderkey % 2 = 1 AS id_is_num, cname AS name, {NULL_S} AS username, {NULL_S} AS url FROM o
UNION ALL SELECT book_slug, 1, 'translator', NULL, NULL, NULL, 'u' || (o_custkey % 10), NULL FROM o
UNION ALL SELECT book_slug, 2, 'creator', CAST(o_custkey AS VARCHAR), true, cname, NULL, '/u/' || o_custkey FROM o
UNION ALL SELECT book_slug, 3, 'team', CAST(o_orderkey % 100 AS VARCHAR), true, 'Clerk ' || (o_orderkey % 100), NULL, NULL FROM o
"""

_LISTED = "'line-' || l_linenumber || '-' || l_partkey"
ORACLES["book_chapters"] = f"""
SELECT parent_slug, i - 1 AS pos, CAST(o_orderkey * 100 + i AS VARCHAR) AS id, true AS id_is_num, {NULL_S} AS book_id, CAST(NULL AS BOOLEAN) AS book_id_is_num,
       {_LISTED} AS slug, parent_slug AS book_slug,
       '{BASE}/' || parent_slug || '/' || {_LISTED} || CASE WHEN i % 3 = 2 THEN '?a=1' ELSE '' END AS url,
       CASE WHEN i % 2 = 1 THEN 'Chapter ' || i ELSE 'chapter ' || i || '.5' END AS title,
       CASE WHEN i % 2 = 0 THEN 'chapter ' || i || ',5' END AS number_label,
       CASE WHEN i % 2 = 1 THEN CAST(i AS DOUBLE) ELSE i + 0.5::DOUBLE END AS number, CAST(i % 3 AS DOUBLE) AS volume,
       strftime(l_shipdate, '%Y-%m-%d') AS published_at, {NULL_S} AS created_at, {NULL_S} AS updated_at, CAST(NULL AS BIGINT) AS views,
       l_extendedprice AS price, l_returnflag = 'R' AS is_donate, i % 2 = 1 AS is_subscription, false AS is_sponsored,
       CAST(NULL AS BOOLEAN) AS is_edited, CAST(NULL AS BOOLEAN) AS is_user_paid
FROM ({ORDER_CHAPTERS})
"""

_HERE = "error_code IS NULL"
ORACLES["download_books"] = f"""
WITH captured AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey AS supplier, l_returnflag AS flag FROM lineitem WHERE l_suppkey % 7 <> 0
  QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber, l_partkey ORDER BY l_shipdate DESC, 'line-' || l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey DESC) = 1
),
chapters AS (
  SELECT c.*, {_LISTED} AS slug,
         CASE WHEN supplier IS NULL THEN 'NOT_FOUND' WHEN supplier % 11 = 0 THEN 'HTTP_ERROR' WHEN flag = 'R' THEN 'CHAPTER_UNAVAILABLE' END AS error_code,
         row_number() OVER (PARTITION BY o_orderkey ORDER BY i % 3, CASE WHEN i % 2 = 1 THEN i ELSE i + 0.5 END) - 1 AS "index"
  FROM ({ORDER_CHAPTERS}) c LEFT JOIN captured USING (l_orderkey, l_linenumber, l_partkey) WHERE o_orderkey % 10 <> 8
),
counts AS (SELECT o_orderkey, count(*) FILTER ({_HERE}) AS good, count(*) FILTER (NOT {_HERE}) AS bad FROM chapters GROUP BY ALL),
books AS (SELECT *, CASE o_orderkey % 10 WHEN 8 THEN 'NOT_FOUND' WHEN 9 THEN 'INVALID_PAYLOAD' END AS error_code FROM orders LEFT JOIN counts USING (o_orderkey))
SELECT 'book' AS "row", 'order-' || o_orderkey AS book_slug, NULL AS "index", CASE WHEN {_HERE} THEN 'order-' || o_orderkey END AS slug,
       CASE WHEN {_HERE} THEN o_orderpriority || ' ' || o_orderkey END AS title, error_code, NULL AS formatted_html, NULL AS text,
       CASE WHEN {_HERE} THEN coalesce(good, 0) END AS succeeded, CASE WHEN {_HERE} THEN coalesce(bad, 0) END AS failed FROM books
UNION ALL
SELECT 'chapter', parent_slug, "index", slug, CASE WHEN i % 2 = 1 THEN 'Chapter ' || i ELSE 'chapter ' || i || '.5' END, error_code,
       CASE WHEN {_HERE} THEN '<p>Line <strong>' || l_linenumber || '</strong> of&nbsp;' || l_orderkey || '</p><img src="{BASE}/i/' || l_partkey || '.png" alt="" loading="lazy" decoding="async">' END,
       CASE WHEN {_HERE} THEN 'Line ' || l_linenumber || ' of ' || l_orderkey END, NULL, NULL FROM chapters
"""

_R = lambda value: f"CASE WHEN l_linenumber > 2 THEN {value} END"
ORACLES["chapter_details"] = f"""
SELECT {LINE_SLUG} AS request_slug, {NULL_S} AS error_code, CAST(l_partkey AS VARCHAR) AS id, true AS id_is_num,
       CAST(l_orderkey AS VARCHAR) AS book_id, true AS book_id_is_num, {LINE_SLUG} AS slug, {LINE_BOOK} AS book_slug,
       '{BASE}/' || {LINE_BOOK} || '/' || {LINE_SLUG} AS url, 'Part ' || l_partkey AS title, 'Глава ' || l_linenumber || ',5' AS number_label,
       CASE WHEN l_linenumber % 2 = 1 THEN CAST(l_linenumber AS DOUBLE) ELSE l_linenumber + 0.5::DOUBLE END AS number,
       CAST(floor(l_quantity / 10) AS DOUBLE) AS volume, strftime(l_shipdate, '%Y-%m-%d') AS published_at,
       {NULL_S} AS created_at, {NULL_S} AS updated_at, CAST(NULL AS BIGINT) AS views, l_extendedprice AS price,
       l_returnflag = 'R' AS is_donate, l_linestatus = 'O' AS is_subscription, false AS is_sponsored,
       l_linenumber % 3 = 1 AS is_edited, CASE WHEN l_linenumber % 3 = 0 THEN true END AS is_user_paid, l_linestatus AS status,
       CAST(l_suppkey AS VARCHAR) AS translator_id, true AS translator_id_is_num,
       CASE WHEN l_linenumber % 2 = 0 THEN 'e' || l_linenumber END AS editor_id, CASE WHEN l_linenumber % 2 = 0 THEN false END AS editor_id_is_num,
       {_R("CAST(l_orderkey AS VARCHAR)")} AS ref_id, {_R(LINE_BOOK)} AS ref_slug, {_R(f"'{BASE}/' || {LINE_BOOK} || '/x'")} AS ref_url,
       {_R("'Order ' || l_orderkey")} AS ref_title, {_R("'En ' || l_orderkey")} AS ref_title_en, CAST(l_quantity AS BIGINT) AS symbols_count
FROM lineitem
"""

ORACLES["chapter_numbers"] = f"""
SELECT book, label, number FROM (
  SELECT l_orderkey AS book,
         CASE l_linenumber % 3 WHEN 0 THEN 'ГЛАВА ' WHEN 1 THEN 'x Chapter' ELSE 'часть ' END || l_linenumber || ',' || l_suppkey AS label,
         CASE WHEN l_linenumber % 3 < 2 THEN CAST(l_linenumber || '.' || l_suppkey AS DOUBLE) END AS number
  FROM lineitem
  UNION ALL SELECT conv_id, 'глава ' || turn || '. ' || role, CAST(turn AS DOUBLE) FROM conversations
)
"""

ORACLES["chapter_people"] = f"""
WITH l AS (SELECT {LINE_BOOK} AS book_slug, {LINE_SLUG} AS chapter_slug, CAST(l_suppkey AS VARCHAR) AS s, l_suppkey % 4 AS k, l_linenumber AS n FROM lineitem)
SELECT book_slug, chapter_slug, 0 AS pos, 'translator' AS role, s AS id, k <> 1 AS id_is_num, CASE WHEN k < 2 THEN 'S' || s END AS name, {NULL_S} AS username, {NULL_S} AS url FROM l
UNION ALL SELECT book_slug, chapter_slug, 1, 'translator', CASE WHEN k = 1 THEN s END, CASE WHEN k = 1 THEN true END, CASE WHEN k = 2 THEN 'T' END, NULL, NULL FROM l WHERE k IN (1, 2)
UNION ALL SELECT book_slug, chapter_slug, CASE WHEN k IN (1, 2) THEN 2 ELSE 1 END, 'editor', 'e' || n, false, NULL, 'ed', NULL FROM l WHERE n % 2 = 0
"""

ORACLES["chapter_neighbors"] = f"""
WITH l AS (SELECT {LINE_BOOK} AS book_slug, {LINE_SLUG} AS chapter_slug, l_linenumber AS n FROM lineitem)
SELECT book_slug, chapter_slug, 'next' AS direction, CAST(n + 1 AS VARCHAR) AS to_id, true AS to_id_is_num, 'line-' || (n + 1) AS to_slug,
       book_slug AS to_book_slug, '{BASE}/' || book_slug || '/line-' || (n + 1) AS to_url, 'Next ' || (n + 1) AS to_title FROM l WHERE n < 7
UNION ALL
SELECT book_slug, chapter_slug, 'previous', 'p' || (n - 1), false, 'line-' || (n - 1), book_slug,
       '{BASE}/' || book_slug || '/line-' || (n - 1) || '?a=1', 'line-' || (n - 1) FROM l WHERE n > 1
"""

ORACLES["chapter_availability"] = f"""
WITH every AS (
  SELECT {LINE_BOOK} AS book_slug, {LINE_SLUG} AS chapter_slug, l_returnflag = 'R' AS paid, false AS gone, l_linestatus = 'O' AS sub, l_extendedprice AS price FROM lineitem
  UNION ALL SELECT book_slug, slug, CASE WHEN NOT gone THEN paid END, gone, CASE WHEN NOT gone THEN false END, CASE WHEN NOT gone THEN 4.0 END FROM ({TALK}) WHERE role <> 'system'
), modes(allowed) AS (VALUES (false), (true))
SELECT allowed, book_slug, chapter_slug, NOT gone AND NOT paid AS available, CASE WHEN gone THEN 'NOT_FOUND' WHEN paid AND NOT allowed THEN 'CHAPTER_UNAVAILABLE' END AS error_code,
       paid AS is_donate, sub AS is_subscription, price
FROM every, modes
"""

_ASC = "coalesce(volume, 0), coalesce(number, 9007199254740991), title, pos"
_DESC = "coalesce(volume, 0) DESC, coalesce(number, 9007199254740991) DESC, title DESC, pos"
ORACLES["select_chapters"] = " UNION ALL ".join(
    [_ranked("source", "pos", 0, None), _ranked("ascending", _ASC, 1, 3), _ranked("descending", _DESC, 0, 4)]
)

ORACLES["last_free_chapter"] = f"""
SELECT book_slug, pos, title, number, volume FROM ({LINES}) WHERE NOT is_donate AND NOT is_subscription
QUALIFY row_number() OVER (PARTITION BY book_slug ORDER BY pos DESC) = 1
"""

_PAGE = "CASE WHEN error_code IS NULL THEN '<p>' || text || '</p>' END"
_CLEANED = f"trim(raw_html, {TRIMMED})"
ASSEMBLED = f"""
    SELECT book_slug, "index", slug, error_code, raw_html, {_CLEANED} AS formatted_html, {text_sql(_CLEANED)} AS text,
           CASE WHEN error_code IS NULL THEN '' END AS image_urls
    FROM (SELECT book_slug, up AS "index", slug, error_code, {_PAGE} AS raw_html FROM ({TALK_CODED}))
"""
ORACLES["assemble_book"] = ASSEMBLED
ORACLES["write_library"] = ASSEMBLED

ORACLES["until_first_error"] = f"""
SELECT book_slug, "index", slug FROM (
  SELECT *, min(CASE WHEN error_code IS NOT NULL THEN "index" END) OVER (PARTITION BY book_slug) AS stop FROM ({ASSEMBLED})
) WHERE stop IS NULL OR "index" < stop
"""

ORACLES["download_summary"] = f"""
SELECT book_slug, count(*) FILTER (error_code IS NULL) AS succeeded, count(*) FILTER (error_code IS NOT NULL) AS failed
FROM ({TALK_CODED}) GROUP BY book_slug
"""
ORACLES["read_library_books"] = ORACLES["download_summary"]

ORACLES["drop_unsafe_html"] = f"SELECT page_id, {safe_sql('html')} AS html FROM pages"
ORACLES["clean_html"] = f"SELECT page_id, formatted_html AS html FROM ({PAGES_CLEAN})"

ORACLES["html_images"] = f"""
SELECT page_id, 0 AS rank, 0 AS pos, '{BASE}/images/' || page_id || '.jpg' AS url, page_id || '.jpg' AS name, 'pic & ' || page_id AS alt FROM pages
UNION ALL
SELECT page_id, 1, 1, '{BASE}/images/' || (page_id % 7) || '.png', (page_id % 7) || '.png', NULL FROM pages
"""

ORACLES["html_text"] = f"SELECT page_id, {text_sql(safe_sql('html'))} AS text FROM ({PAGES_MARKED})"

ORACLES["chapter_content"] = f"""
SELECT 'page' AS book_slug, CAST(p.page_id AS VARCHAR) AS chapter_slug, p.html AS raw_html, p.formatted_html, {text_sql("p.formatted_html")} AS text,
       '{BASE}/images/' || p.page_id || '.jpg {BASE}/images/' || (p.page_id % 7) || '.png' AS image_urls,
       CAST(NULL AS BIGINT) AS symbols_count, strlen(o.html) AS page_html_bytes
FROM ({PAGES_CLEAN}) p JOIN pages o USING (page_id)
UNION ALL
SELECT {LINE_BOOK}, {LINE_SLUG},
       CASE WHEN l_returnflag <> 'R' THEN '<p>Line <b>' || l_linenumber || '</b> of&nbsp;' || l_orderkey || '</p><img src="/i/' || l_partkey || '.png">' END,
       CASE WHEN l_returnflag <> 'R' THEN '<p>Line <strong>' || l_linenumber || '</strong> of&nbsp;' || l_orderkey || '</p><img src="{BASE}/i/' || l_partkey || '.png" alt="" loading="lazy" decoding="async">' END,
       CASE WHEN l_returnflag <> 'R' THEN 'Line ' || l_linenumber || ' of ' || l_orderkey END,
       CASE WHEN l_returnflag <> 'R' THEN '{BASE}/i/' || l_partkey || '.png' END, CAST(l_quantity AS BIGINT), NULL
FROM lineitem
"""

ORACLES["resolve_urls"] = f"""
SELECT page_id, pos, link, '{BASE}' || {pct_sql("link")} AS url FROM (
  SELECT page_id, unnest(links) AS link, unnest(range(len(links))) AS pos
  FROM (SELECT page_id, regexp_extract_all(html, '<a href="([^"]*)"', 1) AS links FROM pages)
)
UNION ALL SELECT page_id, -1, url, url FROM pages
"""

ORACLES["url_keys"] = f"""
WITH p AS (
  SELECT page_id, regexp_extract(url, '^https?://([^/]*)', 1) AS host,
         list_filter(string_split(regexp_replace(regexp_replace(url, '^https?://[^/]*', ''), '[?#].*', ''), '/'), lambda s: s <> '') AS parts
  FROM pages
), forms AS (
  SELECT page_id, 'url' AS form, host = 'blog.ththan.example.net' AND len(parts) >= 2 AS good, parts[1] AS b, parts[2] AS c FROM p
  UNION ALL SELECT page_id, 'path', len(parts) >= 2, parts[1], parts[2] FROM p
  UNION ALL SELECT page_id, 'pair', len(parts) >= 1, parts[1], 'глава ' || page_id FROM p
)
SELECT page_id, form, CASE WHEN good THEN b END AS book_slug, CASE WHEN good THEN c END AS chapter_slug,
       CASE WHEN NOT good THEN 'INVALID_INPUT' END AS error_code FROM forms
"""

_TALK_TEXT = f"CASE WHEN role <> 'system' AND NOT gone AND NOT paid THEN '<p>' || text || '</p>' END"
ORACLES["stream_captures"] = f"""
SELECT 'talk-' || substr(book_slug, 6) || '-' || turn || '-b' AS capture_id, error_code, {{clean}} AS formatted_html, {text_sql("{clean}")} AS text
FROM (SELECT *, {_TALK_TEXT} AS h FROM ({TALK_CODED})) WHERE role <> 'system'
UNION ALL
SELECT 'talk-' || substr(book_slug, 6) || '-' || turn || '-a', 'HTTP_ERROR', NULL, NULL FROM ({TALK}) WHERE role <> 'system'
""".replace("{clean}", f"trim(h, {TRIMMED})")

ORACLES["stream_dedupe"] = f"""
WITH RECURSIVE log AS (SELECT url, kind, epoch_us(ts) AS us, capture_id FROM ({LOG})),
ttl(kind, days) AS (VALUES ('build_id', 5), ('catalog', 2), ('book', 10), ('chapter', 3), ('page_html', 1)),
kept AS (
  SELECT url, kind, min(us) AS us FROM log GROUP BY ALL
  UNION ALL
  SELECT k.url, k.kind, min(l.us) FROM kept k JOIN ttl t ON t.kind = k.kind
  JOIN log l ON l.url = k.url AND l.kind = k.kind AND l.us >= k.us + t.days * 86400000000 GROUP BY ALL
)
SELECT url, kind, kept.us AS fetched_us, min(log.capture_id) AS capture_id
FROM kept JOIN log USING (url, kind, us) GROUP BY ALL
"""

ORACLES["stream_library"] = f"""
SELECT book_slug, count(*) FILTER (error_code IS NULL) AS succeeded, count(*) FILTER (error_code IS NOT NULL) AS failed
FROM ({TALK_CODED}) WHERE role <> 'system' GROUP BY book_slug
"""

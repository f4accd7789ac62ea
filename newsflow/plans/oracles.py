"""ANSI SQL for the registered queries, over the same tables."""

# Article statistics derived from ``events`` (see ``inputs.event_stats``).
_EVENT_STATS = """
event_stats AS (
  SELECT 'http://' || event_type || '.example/' || user_id AS url,
         'http://' || event_type || '.example/' AS domain,
         CAST(length(props) AS BIGINT) AS nbytes,
         event_id AS eventid,
         CASE WHEN event_type = 'signup' THEN '' ELSE 'c-' || user_id END AS gkgid,
         CASE WHEN event_type = 'error' THEN 404 ELSE 200 END AS status,
         strftime(ts, '%Y%m%d') AS accessdate,
         'Event ' || event_id AS title,
         event_type AS site_name,
         '' AS author,
         CASE WHEN value >= 10 THEN props ELSE '' END AS keywords,
         CASE WHEN value < 20 THEN event_type END AS description,
         CAST(year(ts) AS INTEGER) AS year,
         CAST(month(ts) AS INTEGER) AS month,
         CAST(day(ts) AS INTEGER) AS day
  FROM events)
"""

_EVENT_FLAGS = (
    _EVENT_STATS
    + """
, event_flags AS (
  SELECT domain, eventid, gkgid, year, month, day,
         CASE WHEN coalesce(length(keywords), 0) = 0 THEN 0 ELSE 1 END AS hasKeywords,
         CASE WHEN coalesce(length(description), 0) = 0 THEN 0 ELSE 1 END AS hasDescription
  FROM event_stats WHERE status = 200)
"""
)

_DOCUMENT_STATS = """
document_stats AS (
  SELECT 'https://' || source || '.example/' || lang || '/' || d.doc_id AS url,
         'https://' || source || '.example/' AS domain,
         n_chars AS nbytes,
         CASE WHEN d.doc_id > 0 THEN d.doc_id END AS eventid,
         'd-' || d.doc_id AS gkgid,
         200 AS status,
         '202401' || lpad(CAST(CAST(substr(source, 4) AS INTEGER) + 1 AS VARCHAR), 2, '0') AS accessdate,
         'Document ' || d.doc_id AS title,
         source AS site_name,
         CAST(NULL AS VARCHAR) AS author,
         CASE WHEN quality = 1 THEN lang END AS keywords,
         CASE WHEN toxic = 0 THEN source END AS description
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
"""

_RECORDS = """
records AS (
  SELECT 'c-' || c_custkey AS gkgid,
         CAST(20240000000000 + c_custkey * 1000000 AS VARCHAR) AS stamp,
         c_mktsegment AS Themes,
         c_name AS Persons,
         CASE WHEN c_acctbal > 0 THEN r_name END AS Organizations,
         '1#' || n_name || '#' || r_name || '#' || r_name || '#46#2#' || r_name || ';' ||
         '4#' || c_mktsegment || ', ' || n_name || ' (general)#' || r_name || '#' || r_name ||
         'A8#' || c_acctbal || '#-1.5#' || c_custkey AS packed
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
located AS (
  SELECT *, array_to_string(list_sort(list_distinct(list_transform(
              list_filter(string_split(regexp_replace(packed, '-?[0-9]+\\.?[0-9]?', '', 'g'), '#'),
                          lambda p: p <> ''),
              lambda p: regexp_replace(p, ';.*', '')))), ';') AS locations
  FROM records),
dated AS (
  SELECT *, CAST(try_strptime(substr(stamp, 1, 8), '%Y%m%d') AS DATE) AS date FROM located)
, entities AS (
  SELECT gkgid, Themes, Persons, coalesce(Organizations, '') AS Organizations,
         locations AS Locations, CAST(year(date) AS INTEGER) AS year,
         CAST(month(date) AS INTEGER) AS month, CAST(day(date) AS INTEGER) AS day
  FROM dated WHERE date IS NOT NULL)
"""

_MANIFEST = """
slots AS (
  SELECT DISTINCT strftime(time_bucket(INTERVAL 15 MINUTE, ts), '%Y%m%d%H%M%S') AS batch,
         CASE event_type WHEN 'click' THEN 'gkg' WHEN 'view' THEN 'mentions' ELSE 'export' END AS kind
  FROM events),
manifest AS (
  SELECT 'http://feed.example/v2/' || name AS url, name, batch, substr(batch, 1, 8) AS ymd, kind
  FROM (SELECT *, batch || CASE kind WHEN 'gkg' THEN '.gkg.csv.zip' ELSE '.' || kind || '.CSV.zip' END
               AS name
        FROM slots) s)
"""

_GRID = """
grid AS (
  SELECT strftime(t, '%Y%m%d') AS ymd, t AS batch_ts, strftime(t, '%Y%m%d%H%M%S') AS batch, kind,
         'http://feed.example/v2/' || strftime(t, '%Y%m%d%H%M%S') ||
         CASE kind WHEN 'gkg' THEN '.gkg.csv.zip' ELSE '.export.CSV.zip' END AS url
  FROM (SELECT day + n * INTERVAL 15 MINUTE AS t, kind
        FROM (SELECT DISTINCT date_trunc('day', ts) AS day FROM events) d,
             (SELECT unnest(range(96)) AS n) s,
             (SELECT unnest(['export', 'gkg']) AS kind) k) g)
"""

_JOINED = """
SELECT f.*, e.Themes, e.Persons, e.Organizations, e.Locations,
       e.year AS gkg_year, e.month AS gkg_month, e.day AS gkg_day
FROM event_flags f {how} JOIN entities e ON f.gkgid = e.gkgid
"""

_LINKS = """
links AS (
  SELECT page_id, url, unnest(found) AS link, unnest(range(len(found))) AS pos
  FROM (SELECT page_id, url, regexp_extract_all(html, '<a href="([^"]*)"', 1) AS found FROM pages) p),
home AS (
  SELECT page_id, url, pos, link, regexp_extract(url, '^(https?://[^/?#]*)', 1) || '/' AS basedomain
  FROM links)
"""

_DOMAIN_COUNTS = """
counted AS (
  SELECT page_id, url, basedomain AS domain, count(*) AS n_links FROM home GROUP BY ALL)
"""

_TITLE = """
replace(replace(replace(replace(regexp_extract(html, '<title>([^<]*)</title>', 1),
        '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&')
"""

_PAIRS = """
order_pairs AS (
  SELECT o_orderkey AS id, 'http://customer.example/' || o_custkey AS url,
         strftime(o_orderdate, '%Y%m%d%H%M%S') AS batch FROM orders),
event_pairs AS (
  SELECT event_id AS id, 'http://customer.example/' || user_id AS url,
         strftime(ts, '%Y%m%d') || '000000' AS batch FROM events),
last_orders AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY batch DESC, id DESC) AS rn
                 FROM order_pairs) o WHERE rn = 1),
last_events AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY batch DESC, id DESC) AS rn
                 FROM event_pairs) e WHERE rn = 1)
"""

_PAGE_STATS = f"""
SELECT url, regexp_extract(url, '^(https?://[^/?#]*)', 1) || '/' AS domain,
       CAST(length(html) AS BIGINT) AS nbytes, eventid, 'p-' || eventid AS gkgid, 200 AS status,
       '20240101' AS accessdate, {_TITLE} AS title, '' AS site_name, '' AS author, '' AS keywords,
       '' AS description
FROM (SELECT url, page_id AS eventid, html,
             row_number() OVER (PARTITION BY url ORDER BY page_id DESC) AS rn
      FROM pages WHERE url NOT LIKE '%cheap-pills%') p
WHERE rn = 1
"""

_WHITELISTED = "status = 200 AND regexp_matches(domain, '(click|pu.chase|err)')"

_SEARCH_DOCS = (
    "WITH "
    + _DOCUMENT_STATS
    + """
SELECT title, accessdate, coalesce(text, '') AS article,
       '' AS author, coalesce(keywords, '') AS keywords, coalesce(description, '') AS description,
       eventid, gkgid
FROM document_stats s JOIN documents d ON s.gkgid = 'd-' || d.doc_id
"""
)

_REBUILT = (
    "WITH "
    + _LINKS
    + ","
    + _DOMAIN_COUNTS
    + """
SELECT CASE WHEN p.page_id = 0 THEN 'g_p-0' ELSE CAST(p.page_id AS VARCHAR) END AS article_id, p.url,
       regexp_extract(p.url, '^(https?://[^/?#]*)', 1) || '/' AS basedomain,
       CASE WHEN p.page_id > 0 THEN domain END AS domain,
       CASE WHEN p.page_id > 0 THEN n_links END AS n_links
FROM pages p LEFT JOIN counted c ON p.page_id = c.page_id
"""
)

ORACLES: dict[str, str] = {
    "daily_domain_stats": f"""
WITH {_EVENT_FLAGS}
SELECT year, month, day, domain, count(*) AS n_articles,
       CAST(sum(hasKeywords) AS BIGINT) AS n_keywords,
       CAST(sum(hasDescription) AS BIGINT) AS n_descriptions,
       CAST(sum(hasKeywords * hasDescription) AS BIGINT) AS n_both
FROM event_flags GROUP BY year, month, day, domain
""",
    "article_flags": f"""
WITH {_DOCUMENT_STATS}
SELECT domain, eventid, gkgid, 2024 AS year, 1 AS month,
       CAST(substr(accessdate, 7, 2) AS INTEGER) AS day,
       CASE WHEN keywords IS NULL THEN 0 ELSE 1 END AS hasKeywords,
       CASE WHEN description IS NULL THEN 0 ELSE 1 END AS hasDescription
FROM document_stats
""",
    "domain_whitelist": """
SELECT * FROM (SELECT page_id, regexp_extract(url, '^(https?://[^/?#]*)', 1) || '/' AS domain FROM pages) d
WHERE regexp_matches(domain, '(example.org|cheap-pills)')
""",
    "whitelisted_articles": f"WITH {_EVENT_STATS} SELECT * FROM event_stats WHERE {_WHITELISTED}",
    "whitelisted_ids": f"""
WITH {_EVENT_STATS}
SELECT DISTINCT gkgid FROM event_stats
WHERE regexp_matches(domain, '(click|pu.chase|err)') AND gkgid <> ''
""",
    "monthly_articles": f"""
WITH {_EVENT_STATS}
SELECT url, eventid, gkgid, keywords, description, year, month, day
FROM event_stats WHERE {_WHITELISTED}
""",
    "run_totals": """
SELECT count(*) FILTER (WHERE url NOT LIKE '%cheap-pills%') AS n_fetched, count(*) AS n_tried,
       CAST(sum(CASE WHEN url NOT LIKE '%cheap-pills%' THEN length(html) END) AS BIGINT) AS n_chars
FROM pages
""",
    "duplicate_counts": """
SELECT source, count(*) AS n_rows, count(DISTINCT text) AS n_distinct,
       count(*) - count(DISTINCT text) AS n_duplicates
FROM documents GROUP BY source
""",
    "url_duplicate_counts": """
SELECT 'events' AS feed, count(*) AS n_rows, count(DISTINCT o_custkey) AS n_distinct,
       count(*) - count(DISTINCT o_custkey) AS n_duplicates FROM orders
UNION ALL
SELECT 'gkg', count(*), count(DISTINCT user_id), count(*) - count(DISTINCT user_id) FROM events
""",
    "url_domain": "SELECT page_id, regexp_extract(url, '^(https?://[^/?#]*)', 1) || '/' AS domain FROM pages",
    "url_basename": "SELECT page_id, regexp_extract(url, '[^/]*$') AS name FROM pages",
    "article_key": """
SELECT d.doc_id, CASE WHEN l.doc_id > 0 THEN CAST(l.doc_id AS VARCHAR) ELSE 'g_' || d.doc_id END AS article_id
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
""",
    "clean_text": """
SELECT doc_id, regexp_replace(replace(text || ' ' || chr(9) || source, chr(160), ' '), '[\\n\\r\\t]', ' ', 'g') AS text
FROM documents
""",
    "escape_title": """
SELECT doc_id, array_to_string(list_transform(string_split_regex(text, ''), lambda c:
         CASE WHEN c = '' THEN '' WHEN c = '\\' THEN '\\\\' WHEN c = chr(9) THEN '\\t'
              WHEN c = chr(10) THEN '\\n' WHEN c = chr(13) THEN '\\r'
              WHEN ord(c) BETWEEN 32 AND 126 THEN c
              WHEN ord(c) < 256 THEN printf('\\x%02x', ord(c))
              WHEN ord(c) < 65536 THEN printf('\\u%04x', ord(c))
              ELSE printf('\\U%08x', ord(c)) END), '') AS title
FROM documents
""",
    "null_to_empty": f"""
WITH {_DOCUMENT_STATS}
SELECT url, '' AS author, coalesce(keywords, '') AS keywords, coalesce(description, '') AS description
FROM document_stats
""",
    "locations": f"WITH {_RECORDS} SELECT gkgid, locations FROM located",
    "date_parts": """
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
       CAST(day(o_orderdate) AS INTEGER) AS day, strftime(o_orderdate, '%m') AS month_label,
       strftime(o_orderdate, '%Y') AS year_label, strftime(o_orderdate, '%Y%m%d') AS ymd
FROM orders
""",
    "valid_dates": """
SELECT o_orderkey, CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month,
       CAST(day(d) AS INTEGER) AS day
FROM (SELECT o_orderkey, try_strptime(CAST(19980000 + o_custkey % 1400 AS VARCHAR), '%Y%m%d') AS d
      FROM orders) o
WHERE d IS NOT NULL
""",
    "batch_of_ts": """
SELECT event_id, strftime(ts, '%Y%m%d%H%M%S') AS batch, date_trunc('second', ts) AS batch_ts,
       strftime(ts, '%Y%m%d') AS ymd
FROM events
""",
    "url_ids_merge": f"""
WITH {_PAIRS}
SELECT o.url, o.id AS eventid, coalesce(e.batch || '-' || e.id, '') AS gkgid
FROM last_orders o LEFT JOIN last_events e ON o.url = e.url
""",
    "url_ids_merge_bucketed": f"""
WITH {_PAIRS}
SELECT o.url, o.id AS eventid, coalesce(e.batch || '-' || e.id, '') AS gkgid
FROM last_orders o LEFT JOIN last_events e ON o.url = e.url
""",
    "url_ids_merge_outer": f"""
WITH {_PAIRS}
SELECT coalesce(e.url, o.url) AS url, e.id AS eventid, coalesce(o.batch || '-' || o.id, '') AS gkgid
FROM last_events e FULL JOIN last_orders o ON o.url = e.url
""",
    "article_gkg_join": f"WITH {_EVENT_FLAGS}, {_RECORDS} {_JOINED.format(how='LEFT')}",
    "article_gkg_join_inner": f"WITH {_EVENT_FLAGS}, {_RECORDS} {_JOINED.format(how='INNER')}",
    "article_gkg_join_salted": f"WITH {_EVENT_FLAGS}, {_RECORDS} {_JOINED.format(how='LEFT')}",
    "article_entity_report": f"""
WITH {_EVENT_FLAGS}, {_RECORDS} {_JOINED.format(how='LEFT')}
WHERE regexp_matches(f.domain, '(click|pu.chase|err)')
""",
    "gkg_entities": f"WITH {_RECORDS} SELECT * FROM entities",
    "id_semi_join": f"""
WITH {_EVENT_STATS}
SELECT gkgid, eventid, year, month, day, title, site_name, author, keywords, description, url, domain
FROM event_stats
WHERE status = 200 AND gkgid IN (SELECT 'c-' || doc_id FROM labels WHERE quality = 1)
""",
    "unseen_anti_join": """
SELECT doc_id, source, n_chars FROM documents d
WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)
""",
    "unseen_by_day_filters": """
SELECT event_id, user_id, event_type, strftime(ts, '%Y%m%d') AS ymd FROM events e
WHERE event_type <> 'error' AND NOT EXISTS (
    SELECT 1 FROM events o
    WHERE o.event_type = 'error' AND o.user_id = e.user_id AND CAST(o.ts AS DATE) = CAST(e.ts AS DATE)
)
""",
    "search_docs": _SEARCH_DOCS,
    "batch_grid": f"WITH {_GRID} SELECT * FROM grid",
    "missing_slots": f"""
WITH {_GRID}, {_MANIFEST}
SELECT batch, kind, url FROM grid g
WHERE NOT EXISTS (SELECT 1 FROM manifest m WHERE m.batch = g.batch AND m.kind = g.kind)
""",
    "day_completeness": f"""
WITH {_MANIFEST}
SELECT ymd, kind, count(DISTINCT batch) AS n_batches,
       CASE WHEN count(DISTINCT batch) > 70 THEN 1 ELSE 0 END AS is_complete
FROM manifest GROUP BY ymd, kind
""",
    "manifest_by_kind": f"""
WITH {_MANIFEST}
SELECT kind, count(*) AS n_files, min(batch) AS first_batch, max(batch) AS last_batch
FROM manifest GROUP BY kind
""",
    "first_files": f"WITH {_MANIFEST} SELECT kind, ymd, min(name) AS first_name FROM manifest GROUP BY kind, ymd",
    "complete_days": f"""
WITH {_GRID}, {_MANIFEST},
u AS (SELECT ymd, kind, batch FROM manifest UNION ALL SELECT ymd, kind, batch FROM grid WHERE kind = 'gkg')
SELECT ymd, kind, count(DISTINCT batch) AS n_batches,
       CASE WHEN count(DISTINCT batch) > 90 THEN 1 ELSE 0 END AS is_complete
FROM u GROUP BY ymd, kind
""",
    "extract_pairs": """
SELECT event_id AS eventid, 'http://' || event_type || '.example/' || user_id AS url FROM events
""",
    "processed_tree": f"""
WITH {_EVENT_FLAGS}
SELECT year, month, day, domain, count(*) AS n_articles,
       CAST(sum(hasKeywords) AS BIGINT) AS n_keywords,
       CAST(sum(hasDescription) AS BIGINT) AS n_descriptions,
       CAST(sum(hasKeywords * hasDescription) AS BIGINT) AS n_both
FROM event_flags GROUP BY year, month, day, domain
""",
    "entity_pairs": """
SELECT strftime(ts, '%Y%m%d') || '000000-' || event_id AS id, 'http://' || event_type || '.example/' || user_id AS url,
       strftime(ts, '%Y%m%d') || '000000' AS batch FROM events
""",
    "backfilled_day": _PAGE_STATS,
    "run_log": """
SELECT 'pages r1' AS kind, 'rows: ' || count(*) || '; n_fetched: '
       || count(*) FILTER (WHERE url NOT LIKE '%cheap-pills%') || '; n_chars: '
       || CAST(sum(CASE WHEN url NOT LIKE '%cheap-pills%' THEN length(html) END) AS BIGINT) AS message
FROM pages
""",
    "article_texts": """
SELECT CAST(doc_id AS VARCHAR) AS article_id, text,
       '202401' || lpad(CAST(CAST(substr(source, 4, 9) AS INTEGER) + 1 AS VARCHAR), 2, '0') AS ymd
FROM documents
""",
    "manifest_urls_by_kind": f"WITH {_MANIFEST} SELECT kind, url FROM manifest",
    "whitelist_from_file": f"""
WITH {_EVENT_STATS}
SELECT url, domain, eventid FROM event_stats
WHERE EXISTS (SELECT 1 FROM (SELECT DISTINCT substr(event_type, 1, 4) AS line FROM events
  WHERE event_type <> 'view') w WHERE regexp_matches(domain, line))
""",
    "whitelist_of_any_length": """
WITH site AS (
  SELECT c_custkey, 'www.' || lower(c_name) || '.' || lower(c_mktsegment) || '.example' AS domain FROM customer
), line AS (
  SELECT DISTINCT 'customer.' || lpad(o_custkey::VARCHAR, 9, '0') AS line FROM orders
  WHERE o_orderpriority = '1-URGENT'
)
SELECT c_custkey, domain FROM site
WHERE regexp_matches(domain, '0{4}[12]99\\.b') OR regexp_matches(domain, '(?i)MACH.*00077')
  OR EXISTS (SELECT 1 FROM line WHERE regexp_matches(domain, line.line))
""",
    "domain_rollup": f"""
WITH {_EVENT_STATS}, flagged AS (
  SELECT substr(accessdate, 1, 4)::INTEGER AS year, substr(accessdate, 5, 2)::INTEGER AS month,
    substr(accessdate, 7, 2)::INTEGER AS day, domain,
    CASE WHEN keywords <> '' THEN 1 ELSE 0 END AS k, CASE WHEN description <> '' THEN 1 ELSE 0 END AS d
  FROM event_stats WHERE status = 200
)
SELECT year, month, day, domain, GROUPING(year, month, day, domain)::INTEGER AS level, count(*) AS n_articles,
  sum(k)::BIGINT AS n_keywords, sum(d)::BIGINT AS n_descriptions, sum(k * d)::BIGINT AS n_both
FROM flagged GROUP BY ROLLUP (year, month, day, domain)
""",
    "missing_runs": f"""
WITH {_GRID}, {_MANIFEST}, missing AS (
  SELECT kind, batch, strptime(batch, '%Y%m%d%H%M%S') AS began FROM grid g
  WHERE NOT EXISTS (SELECT 1 FROM manifest m WHERE m.batch = g.batch AND m.kind = g.kind)
), numbered AS (
  SELECT *, epoch(began)::BIGINT // 900 - row_number() OVER (PARTITION BY kind ORDER BY began) AS island FROM missing
)
SELECT kind, min(batch) AS first_batch, max(batch) AS last_batch, count(*) AS n_slots
FROM numbered GROUP BY kind, island
""",
    "manifest_by_date": f"""
WITH {_MANIFEST}
SELECT ymd, string_agg(url, ' ' ORDER BY url) AS urls
FROM manifest WHERE kind <> 'mentions' GROUP BY ymd
""",
    "manifest_day": f"""
WITH {_MANIFEST}
SELECT url, name, batch, ymd, kind FROM manifest WHERE kind <> 'mentions' AND ymd = '20240115'
""",
    "first_batch": f"WITH {_MANIFEST} SELECT min(batch) AS batch, min(ymd) AS ymd FROM manifest",
    "page_links": f"""
WITH {_LINKS}
SELECT CAST(page_id AS VARCHAR) AS article_id, '20240101' AS ymd, CAST(pos AS INTEGER) AS pos, link FROM links
""",
    "absolute_links": f"""
WITH {_LINKS}
SELECT CAST(page_id AS VARCHAR) AS article_id, '20240101' AS ymd, CAST(pos AS INTEGER) AS pos,
       regexp_extract(url, '^(https?://[^/?#]*)', 1) || link AS link
FROM links
""",
    "page_domain_counts": f"""
WITH {_LINKS}, {_DOMAIN_COUNTS}
SELECT CAST(page_id AS VARCHAR) AS article_id, '20240101' AS ymd, domain, n_links FROM counted
""",
    "rebuilt_domains": _REBUILT,
    "page_title": f"SELECT page_id, {_TITLE} AS title FROM pages",
    "page_meta": f"""
SELECT page_id, 'meta' AS grp, 'charset' AS key, regexp_extract(html, '<meta charset="([^"]*)"', 1) AS value
FROM pages WHERE html LIKE '%<meta charset=%'
UNION ALL
SELECT page_id, 'page', 'title', {_TITLE} FROM pages WHERE {_TITLE} <> ''
""",
    "page_stats": _PAGE_STATS,
    "page_job": """
SELECT CASE WHEN page_id = 0 THEN 'g_p-0' ELSE CAST(page_id AS VARCHAR) END AS article_id,
       CASE WHEN url LIKE '%cheap-pills%' THEN 0
            ELSE len(regexp_extract_all(html, '<a href="([^"]*)"', 1)) END AS n_links,
       CASE WHEN url NOT LIKE '%cheap-pills%'
            THEN regexp_extract(html, '<meta charset="([^"]*)"', 1) END AS charset
FROM pages
""",
    "date_range_prune": """
SELECT event_id, event_type, strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month,
       strftime(ts, '%Y%m%d') AS ymd
FROM events WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-20'
""",
    "partition_dates": "SELECT DISTINCT strftime(ts, '%Y%m%d') AS ymd FROM events",
    "roundtrip_tsv": f"WITH {_DOCUMENT_STATS} SELECT * FROM document_stats",
    "roundtrip_feed": f"WITH {_RECORDS} SELECT * FROM entities",
    "roundtrip_events": """
SELECT event_id AS GLOBALEVENTID, CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS SQLDATE,
       event_type AS EventCode, value AS AvgTone, 'http://' || event_type || '.example/' || user_id AS SOURCEURL
FROM events
""",
    "roundtrip_zip": """
SELECT strftime(ts, '%Y%m%d') || '000000' AS batch, event_id AS GLOBALEVENTID, event_type AS EventCode,
       'http://' || event_type || '.example/' || user_id AS SOURCEURL
FROM events
""",
    "roundtrip_json": f"""
WITH {_LINKS}, {_DOMAIN_COUNTS}
SELECT p.url, regexp_extract(p.url, '^(https?://[^/?#]*)', 1) || '/' AS basedomain, domain, n_links
FROM pages p LEFT JOIN counted c ON p.page_id = c.page_id
""",
    "roundtrip_text": f"WITH {_MANIFEST} SELECT url FROM manifest",
    "roundtrip_csv": f"""
WITH {_EVENT_FLAGS}, {_RECORDS}
SELECT f.eventid, nullif(f.gkgid, '') AS gkgid, e.Persons, e.Locations, e.year AS gkg_year,
       e.month AS gkg_month, e.day AS gkg_day
FROM event_flags f LEFT JOIN entities e ON f.gkgid = e.gkgid
""",
    "roundtrip_bulk": f"""
SELECT 'articles' AS index, CASE WHEN eventid > 0 THEN CAST(eventid AS VARCHAR) ELSE 'g_' || gkgid END AS doc_key, d.*
FROM ({_SEARCH_DOCS}) d
""",
    "stream_dedup": "SELECT DISTINCT strftime(ts, '%Y%m%d') AS ymd, user_id FROM events",
    "stream_dedup_state": "SELECT DISTINCT strftime(ts, '%Y%m%d') AS ymd, user_id FROM events",
    "sketched_duplicates": """
SELECT event_type, count(*) AS n_rows, count(DISTINCT user_id) AS n_distinct,
       count(*) - count(DISTINCT user_id) AS n_duplicates, count(*) AS kept_rows, true AS within
FROM events GROUP BY event_type
""",
    "stream_dedup_watermark": "SELECT DISTINCT strftime(ts, '%Y%m%d') AS ymd, user_id FROM events",
    "stream_pages": _PAGE_STATS,
    "stream_window_counts": """
SELECT time_bucket(INTERVAL 15 MINUTE, ts) AS slot_start, event_type, count(*) AS n
FROM events GROUP BY ALL
""",
    "slot_counts": """
SELECT time_bucket(INTERVAL 15 MINUTE, ts) AS slot_start, event_type, count(*) AS n
FROM events GROUP BY ALL
""",
    "stream_ingest": """
WITH e AS (
  SELECT *, 'http://' || event_type || '.example/' || user_id AS url, strftime(ts, '%Y%m%d') AS ymd,
         strftime(ts, '%Y%m%d') || '000000' AS batch FROM events),
last_event AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY url, ymd ORDER BY batch DESC, event_id DESC) AS rn
                 FROM e) x WHERE rn = 1)
SELECT url, event_id AS eventid,
       CASE WHEN event_type IN ('view', 'click') THEN batch || '-' || event_id ELSE '' END AS gkgid, batch,
       CASE WHEN event_id > 0 THEN CAST(event_id AS VARCHAR) ELSE 'g_' END AS article_id, ymd
FROM last_event
""",
    "stream_ingest_deltas": """
SELECT url, event_id AS eventid, batch || '-' || event_id AS gkgid, batch,
       CASE WHEN event_id > 0 THEN CAST(event_id AS VARCHAR) ELSE 'g_' || batch || '-0' END AS article_id, ymd
FROM (SELECT *, row_number() OVER (PARTITION BY url, ymd ORDER BY event_id DESC) AS rn
      FROM (SELECT event_id, 'http://' || event_type || '.example/' || user_id AS url,
                   strftime(ts, '%Y%m%d') AS ymd, strftime(ts, '%Y%m%d') || '000000' AS batch FROM events) e) x
WHERE rn = 1
""",
}

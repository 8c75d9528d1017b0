"""SQL forms of the corpus queries that SQL can express."""

WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"

# Shingle sets, equal sets once, overlaps of sets by a join on shingles, and all that is reachable over links.
NGRAM_JACCARD = rf"""WITH RECURSIVE w AS (SELECT doc_id, {WORDS} AS ws FROM documents),
 g AS (SELECT DISTINCT doc_id, array_to_string(ws[k:k + 3], ' ') AS g FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 1) + 1)) AS k FROM w WHERE len(ws) > 0)),
 d AS (SELECT doc_id, count(*) AS n, md5(string_agg(g, chr(10) ORDER BY g)) AS cls FROM g GROUP BY doc_id),
 c AS (SELECT cls, min(doc_id) AS low, any_value(n) AS n FROM d GROUP BY cls),
 s AS (SELECT low AS a, n, g FROM c JOIN g ON g.doc_id = c.low),
 p AS (SELECT x.a AS a, y.a AS b FROM s x JOIN s y ON x.g = y.g AND x.a <> y.a GROUP BY ALL HAVING 185 * count(*) >= 85 * (any_value(x.n) + any_value(y.n))),
 r(a, b) AS (SELECT low, low FROM c UNION SELECT r.a, p.b FROM r JOIN p ON r.b = p.a),
 m AS (SELECT a AS low, min(b) AS head FROM r GROUP BY a)
 SELECT w.doc_id, coalesce(d.n, 0) AS n_shingles, coalesce(m.head, w.doc_id) AS component_id
 FROM w LEFT JOIN d ON d.doc_id = w.doc_id LEFT JOIN c ON c.cls = d.cls LEFT JOIN m ON m.low = c.low"""

_BARE = r"regexp_replace(regexp_replace(trim(url), '(?s)#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '')"
_HOST = rf"regexp_replace(lower(regexp_extract({_BARE}, '^[^/?]*', 0)), '^www\.|:(80|443)$', '', 'g')"
_PATH = rf"regexp_replace(regexp_extract({_BARE}, '^[^/?]*([^?]*)', 1), '/+$', '')"
_KEPT = rf"list_sort(list_filter(string_split(regexp_extract({_BARE}, '(?s)\?(.*)$', 1), '&'), lambda p: p <> '' AND NOT regexp_matches(lower(p), '^(utm_[a-z]+|fbclid|gclid|ref)=')))"

# The records that op8's query makes of pages, and the latest response at or before each revisit.
WARC_REVISITS = rf"""WITH b AS (SELECT page_id, concat({_HOST}, {_PATH}, CASE WHEN len({_KEPT}) > 0 THEN '?' || array_to_string({_KEPT}, '&') ELSE '' END) AS url_key,
  TIMESTAMP '2020-09-13 12:26:40' + to_days(CAST(page_id % 1000 AS INTEGER)) AS day, '"' || substr(md5(coalesce(html, '')), 1, 16) || '"' AS tag, sha1(coalesce(html, '')) AS sum, length(html) AS size FROM pages),
 v AS (SELECT *, unnest([0, 1, 2]) AS visit FROM b),
 r AS (SELECT page_id * 3 + visit AS record_id, url_key, day + to_days(visit * 3) AS ts, visit, visit = 2 AND page_id % 7 = 0 AS changed,
  CASE WHEN page_id % 13 <> 0 AND page_id % 11 <> 0 THEN CASE WHEN visit = 2 AND page_id % 7 = 0 THEN '"new"' ELSE tag END END AS etag,
  CASE WHEN page_id % 13 <> 0 THEN CASE WHEN visit = 2 AND page_id % 7 = 0 THEN day + to_days(4) ELSE day END END AS last_modified,
  CASE WHEN visit = 2 AND page_id % 7 = 0 THEN 'changed' ELSE sum END AS digest, size FROM v),
 x AS (SELECT q.record_id, q.url_key, q.ts, f.record_id AS f_id, f.ts AS f_ts, f.size, q.visit,
  CASE WHEN q.etag IS NOT NULL AND f.etag IS NOT NULL THEN CASE WHEN q.etag = f.etag THEN 'etag' END
   WHEN q.last_modified IS NOT NULL AND f.last_modified IS NOT NULL THEN CASE WHEN q.last_modified = f.last_modified THEN 'last-modified' END
   WHEN q.digest = f.digest THEN 'digest' END AS matched_by
  FROM r q LEFT JOIN r f ON f.visit = 0 AND f.url_key = q.url_key AND f.ts <= q.ts WHERE q.visit > 0
  QUALIFY row_number() OVER (PARTITION BY q.record_id ORDER BY f.ts DESC, f.record_id DESC) = 1)
 SELECT record_id, url_key, CAST(epoch(ts) AS BIGINT) AS ts, CASE WHEN f_id IS NULL THEN 'orphan' WHEN matched_by IS NOT NULL THEN 'resolved' ELSE 'mismatch' END AS status,
  CASE WHEN matched_by IS NOT NULL THEN f_id END AS response_id, CASE WHEN matched_by IS NOT NULL THEN CAST(epoch(f_ts) AS BIGINT) END AS response_ts, matched_by,
  CASE WHEN matched_by IS NOT NULL THEN concat('Content-Length=', size, ';Content-Type=text/html;cache-control=max-age=', visit * 600) END AS headers FROM x"""

_DRAW = "CAST(concat('0x', substr(h, {}, 8)) AS BIGINT)"

# Cuts by code points; nothing is scanned in chunks here.
FILL_IN_MIDDLE = rf"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256(concat('1:', coalesce(CAST(doc_id AS VARCHAR), ''))) AS h FROM documents),
 n AS (SELECT *, length(t) AS n, {_DRAW.format(1)} AS h1, {_DRAW.format(9)} AS h2, {_DRAW.format(17)} AS h3, {_DRAW.format(25)} AS h4 FROM d),
 c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
  CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM n),
 o AS (SELECT *, CASE form WHEN 'plain' THEN t WHEN 'psm' THEN concat('<P>', left(t, a), '<S>', substr(t, b + 1), '<M>', substr(t, a + 1, b - a))
  ELSE concat('<S>', substr(t, b + 1), '<P>', left(t, a), '<M>', substr(t, a + 1, b - a)) END AS out FROM c)
 SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars, sha256(out) AS output_sha256, sha256(t) AS restored_sha256 FROM o"""

_ITEM_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

# All windows of all sizes that items have, joined as strings.
DECONTAMINATION = rf"""WITH i AS (SELECT CAST(item_id AS VARCHAR) AS item, {_ITEM_WORDS} AS ws FROM benchmark), l AS (SELECT item, ws, least(len(ws), 10) AS n FROM i WHERE len(ws) > 0),
 w AS (SELECT DISTINCT item, n, array_to_string(ws[k:k + n - 1], ' ') AS w FROM (SELECT item, ws, n, unnest(range(1, len(ws) - n + 2)) AS k FROM l)), z AS (SELECT DISTINCT n FROM w),
 d AS (SELECT row_number() OVER () AS r, doc_id, {_ITEM_WORDS} AS ws FROM documents),
 v AS (SELECT r, n, k, array_to_string(ws[k:k + n - 1], ' ') AS w FROM (SELECT r, ws, n, unnest(range(1, len(ws) - n + 2)) AS k FROM d, z WHERE len(ws) >= n)),
 h AS (SELECT r, v.n, k, item FROM v JOIN w USING (w)),
 c AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(k, k + n)) AS p FROM h) GROUP BY r),
 s AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM h WHERE item IS NOT NULL) GROUP BY r)
 SELECT doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
 FROM d LEFT JOIN c USING (r) LEFT JOIN s USING (r)"""

# Documents with equal failures count together; every order and step is summed by itself.
FILTER_AUDIT = r"""WITH t AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents), w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM t),
 g AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id), m AS (SELECT t, min(doc_id) AS low FROM t GROUP BY t),
 b AS (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, concat(CASE WHEN len(ws) < 200 THEN 'A' ELSE '' END, CASE WHEN 100 * len(list_distinct(ws)) < 50 * len(ws) THEN 'B' ELSE '' END,
  CASE WHEN 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 3 * length(t) THEN 'C' ELSE '' END, CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END, CASE WHEN doc_id > low THEN 'E' ELSE '' END) AS fails
  FROM w JOIN m USING (t) LEFT JOIN g USING (doc_id)),
 k AS (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM b GROUP BY ALL),
 l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x), o AS (SELECT concat(a.x, b.x, c.x, d.x, e.x) AS filter_order FROM l a, l b, l c, l d, l e WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
 s AS (SELECT filter_order, CAST(step AS INTEGER) AS step, left(filter_order, step - 1) AS before, filter_order[step] AS f FROM (SELECT filter_order, unnest([1, 2, 3, 4, 5]) AS step FROM o)),
 j AS (SELECT part, filter_order, step, f, n, good, toxic, contains(fails, f) AS hit, fails = f AS alone, before <> '' AND regexp_matches(fails, concat('[', before, '~]')) AS gone FROM k, s),
 r AS (SELECT part, filter_order, step, f, CAST(sum(CASE WHEN NOT hit AND NOT gone THEN n ELSE 0 END) AS BIGINT) AS kept, CAST(sum(CASE WHEN hit AND NOT gone THEN n ELSE 0 END) AS BIGINT) AS removed,
  CAST(sum(CASE WHEN hit AND gone THEN n ELSE 0 END) AS BIGINT) AS redundant, CAST(sum(CASE WHEN alone THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
  CAST(sum(CASE WHEN hit AND NOT gone THEN good ELSE 0 END) AS BIGINT) AS good_lost, CAST(sum(CASE WHEN hit AND NOT gone THEN toxic ELSE 0 END) AS BIGINT) AS toxic_lost FROM j GROUP BY ALL)
 SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley FROM r"""

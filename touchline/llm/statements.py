"""DuckDB statements of those queries that SQL can express."""

LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORD = r"'[^\x20\x09-\x0D]+'"
ALNUM = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"

SUBSTRINGS = f"""
WITH w AS (SELECT doc_id, COALESCE(regexp_extract_all(text, {WORD}), []) AS ws FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(ws[i:i + 34], ' ') AS win
  FROM (SELECT doc_id, ws, UNNEST(range(1, len(ws) - 33)) AS i FROM w WHERE len(ws) >= 35)),
repeated AS (SELECT win FROM windows GROUP BY win HAVING COUNT(*) > 1),
gone AS (
  SELECT DISTINCT doc_id, i + k AS place
  FROM windows JOIN repeated USING (win), (SELECT UNNEST(range(0, 35)) AS k)),
places AS (SELECT doc_id, UNNEST(ws) AS word, UNNEST(range(1, len(ws) + 1)) AS place FROM w),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY place) AS text, COUNT(*) AS n
  FROM places ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id)
SELECT w.doc_id, len(ws) AS n_words, len(ws) - COALESCE(n, 0) AS n_removed, sha256(COALESCE(text, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)"""

JACCARD = f"""
WITH RECURSIVE w AS (SELECT doc_id, COALESCE(regexp_extract_all({LOWER}, {WORD}), []) AS ws FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS shingle
  FROM (SELECT doc_id, ws, UNNEST(range(1, greatest(len(ws) - 3, 2))) AS i FROM w WHERE len(ws) > 0)),
sizes AS (SELECT doc_id, COUNT(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, COUNT(*) AS n
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM common c JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * c.n >= 75 * (x.n + y.n - c.n)),
reached(a, b) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.a, l.b FROM reached r JOIN links l ON l.a = r.b),
lowest AS (SELECT a AS doc_id, MIN(b) AS component_id FROM reached GROUP BY a)
SELECT doc_id, COALESCE(n, 0) AS n_shingles, component_id FROM lowest LEFT JOIN sizes USING (doc_id)"""

CONTAMINATION = f"""
WITH items AS (
  SELECT item_id, COALESCE(regexp_extract_all({LOWER}, {ALNUM}), []) AS ws FROM benchmark),
wanted AS (
  SELECT DISTINCT item_id, least(13, len(ws)) AS size, array_to_string(ws[i:i + 12], ' ') AS win
  FROM (SELECT item_id, ws, UNNEST(range(1, greatest(len(ws) - 11, 2))) AS i FROM items WHERE len(ws) > 0)),
w AS (SELECT doc_id, COALESCE(regexp_extract_all({LOWER}, {ALNUM}), []) AS ws FROM documents),
windows AS (
  SELECT doc_id, i, size, array_to_string(ws[i:i + size - 1], ' ') AS win
  FROM (SELECT doc_id, ws, size, UNNEST(range(1, len(ws) - size + 2)) AS i
        FROM w, (SELECT DISTINCT size FROM wanted) WHERE len(ws) >= size)),
found AS (SELECT doc_id, i, size, item_id FROM windows JOIN wanted USING (size, win)),
hit AS (
  SELECT doc_id, COUNT(DISTINCT place) AS n
  FROM (SELECT doc_id, UNNEST(range(i, i + size)) AS place FROM (SELECT DISTINCT doc_id, i, size FROM found)) GROUP BY doc_id),
names AS (
  SELECT doc_id, COUNT(*) AS n, string_agg(name, ',' ORDER BY name) AS listed
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS name FROM found) GROUP BY doc_id)
SELECT doc_id, len(ws) AS n_words, COALESCE(hit.n, 0) AS n_hit, COALESCE(names.n, 0) AS n_items,
       sha256(COALESCE(listed, '')) AS items_sha256, COALESCE(hit.n, 0) > 0 AND 20 * COALESCE(hit.n, 0) >= len(ws) AS contaminated
FROM w LEFT JOIN hit USING (doc_id) LEFT JOIN names USING (doc_id)"""

# op13: parts, rules, and the list of canonical URLs as a plain set.
URLS = r"""
with parts as (
    select page_id, url,
        translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
        coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') as path,
        coalesce(regexp_extract(url, '(?s)^.*?://[^?#]*\?([^#]*)', 1), '') as query
    from pages
),
named as (
    select *, case when contains(url, '://') then
        regexp_replace(host, ':(80|443)?$', '') || regexp_replace(path, '/+$', '') ||
        coalesce('?' || nullif(array_to_string(list_sort(list_filter(string_split(query, '&'), lambda p:
            p <> '' and not regexp_matches(
                translate(p, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '(?s)^(utm_[a-z]+|ref|fbclid|gclid|sid|sessionid|phpsessid)(=.*)?$'
            ))), '&'), ''), '')
    end as canon
    from parts
),
listed as (
    select distinct canon from named
    where canon is not null
      and regexp_matches(translate(url, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[?&]utm_[a-z]+=')
),
rules(verdict, host, path) as (
    values ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
           ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
),
ruled as (
    select n.*,
        (select max({'size': length(r.host || r.path), 'host': length(r.host), 'verdict': r.verdict, 'rule': r.host || r.path})
         from rules r
         where (n.host = r.host or ends_with(n.host, '.' || r.host)) and starts_with(n.path, r.path)) as fit
    from named n
)
select page_id, host, path, fit.rule as rule,
    coalesce(fit.verdict, case when canon in (select canon from listed) then 'block' else 'allow' end) as verdict
from ruled
"""

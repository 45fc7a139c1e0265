"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

# ASCII white space, and A-Z to a-z.
_STRIP = "trim({}, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP1 = f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), line AS (
  SELECT r, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM docs
), keyed AS (
  SELECT *, {_LOWER.format(_STRIP.format('line'))} AS k FROM line
), repeated AS (
  SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 40
  GROUP BY k HAVING count(DISTINCT r) >= 5
), marked AS (
  SELECT r, doc_id, i, line, keeper IS NOT NULL AND doc_id IS DISTINCT FROM keeper AS gone
  FROM keyed LEFT JOIN repeated USING (k)
)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY r
"""

OP3 = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS d FROM pages
), f AS (
  SELECT body, min(page_id) AS first FROM p GROUP BY body
)
SELECT page_id, strlen(body) AS payload_bytes,
  array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + (((('0x' || substr(d, 1 + 5 * (j // 4)::INT, 5))::INT >> (15 - 5 * (j % 4))::INT) & 31))::INT, 1) FOR j IN range(32)], '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM p JOIN f USING (body)
"""

OP4 = f"""
WITH parts AS (
  SELECT page_id,
    {_LOWER.format("regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1)")} AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages
), rules(h, p, v) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), fits AS (
  SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY length(h || p) DESC NULLS LAST) AS k
  FROM parts LEFT JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
)
SELECT page_id, host, path, h || p AS rule, coalesce(v, 'allow') AS verdict FROM fits WHERE k = 1
"""

# Turns as JSON text stand for themselves: a node's key is the list of its first turns.
OP11 = """
WITH base AS (
  SELECT conv_id, list({'r': coalesce(role, ''), 't': coalesce(text, '')} ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), lent AS (
  SELECT b.conv_id, b.turns AS own, d.turns AS donor, 0 AS n FROM base b LEFT JOIN base d ON d.conv_id = b.conv_id - b.conv_id % 100
), crc AS (
  -- the unsigned crc32 of the decimal id, byte by byte
  WITH RECURSIVE c(conv_id, i, v) AS (
    SELECT conv_id, 1, 4294967295::BIGINT FROM base
    UNION ALL
    SELECT conv_id, i + 1, list_reduce([xor(v, ascii(substr(conv_id::VARCHAR, i, 1))::BIGINT)] || [0::BIGINT FOR k IN range(8)],
      lambda x, y: xor(x >> 1, (x & 1) * 3988292384::BIGINT))
    FROM c WHERE i <= length(conv_id::VARCHAR)
  ) SELECT conv_id, xor(v, 4294967295::BIGINT) % 6 AS h FROM c WHERE i = length(conv_id::VARCHAR) + 1
), rebuilt AS (
  SELECT conv_id, coalesce(donor[1:h], []) || own[h + 1:] AS turns FROM lent JOIN crc USING (conv_id)
), prefix AS (
  SELECT conv_id, d AS depth, len(turns) AS n, turns[1:d] AS p FROM rebuilt, LATERAL (SELECT unnest(range(len(turns) + 1)) AS d)
), node AS (
  SELECT p, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE n = depth), '')) AS ends_sha256
  FROM prefix GROUP BY p, depth
), linked AS (
  SELECT c.*, u.conv_id AS parent_conv_id, CASE WHEN c.depth > 0 THEN (c.n_convs - 1) * length(c.p[c.depth].t) ELSE 0 END AS saved
  FROM node c LEFT JOIN node u ON c.depth > 0 AND u.depth = c.depth - 1 AND u.p = c.p[1:c.depth - 1]
), fan AS (
  SELECT parent_conv_id AS conv_id, depth - 1 AS depth, count(*) AS n_children FROM linked WHERE depth > 0 GROUP BY 1, 2
), counted AS (
  SELECT l.*, coalesce(n_children, 0) AS n_children FROM linked l LEFT JOIN fan USING (conv_id, depth)
), up AS (
  SELECT a.conv_id, a.depth, sum(CASE WHEN b.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum(b.saved) AS saved_tokens
  FROM (SELECT *, unnest(range(depth + 1)) AS d FROM counted) b JOIN counted a ON a.depth = b.d AND a.p = b.p[1:b.d] GROUP BY 1, 2
)
SELECT conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, ends_sha256
FROM counted JOIN up USING (conv_id, depth)
"""

OP12 = """
WITH body AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS body,
    regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents
), first AS (
  SELECT body, min(doc_id) AS first FROM body GROUP BY body
), mark AS (
  SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id
), fails AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
    {'A': len(words) < 100, 'B': 100 * len(list_distinct(words)) < 80 * len(words),
     'C': 100 * len(regexp_extract_all(body, '[A-Z]')) > 10 * length(body), 'D': regexp_matches(body, '[#$%&*|]'),
     'E': coalesce(doc_id > first, false)} AS f
  FROM body JOIN first USING (body) LEFT JOIN mark USING (doc_id)
), letter AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x
), orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM letter a, letter b, letter c, letter d, letter e
  WHERE a.x NOT IN (b.x, c.x, d.x, e.x) AND b.x NOT IN (c.x, d.x, e.x) AND c.x NOT IN (d.x, e.x) AND d.x <> e.x
), failed AS (
  SELECT part, good, toxic, (CASE WHEN f.A THEN 'A' ELSE '' END) || (CASE WHEN f.B THEN 'B' ELSE '' END) || (CASE WHEN f.C THEN 'C' ELSE '' END)
    || (CASE WHEN f.D THEN 'D' ELSE '' END) || (CASE WHEN f.E THEN 'E' ELSE '' END) AS fs, count(*) AS n
  FROM fails GROUP BY ALL
), run AS (
  SELECT part, filter_order, step, substr(filter_order, step, 1) AS x, n, good, toxic, fs,
    contains(fs, substr(filter_order, step, 1)) AS hit,
    translate(fs, substr(filter_order, 1, step - 1), '') <> fs AS before
  FROM failed, orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)
), steps AS (
  SELECT part, filter_order, step, any_value(x) AS x,
    coalesce(sum(n) FILTER (WHERE NOT hit AND NOT before), 0)::BIGINT AS kept,
    coalesce(sum(n) FILTER (WHERE hit AND NOT before), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (WHERE hit AND before), 0)::BIGINT AS redundant,
    coalesce(sum(n) FILTER (WHERE fs = x), 0)::BIGINT AS unique_fails,
    coalesce(sum(n) FILTER (WHERE hit AND NOT before AND good), 0)::BIGINT AS good_lost,
    coalesce(sum(n) FILTER (WHERE hit AND NOT before AND toxic), 0)::BIGINT AS toxic_lost
  FROM run GROUP BY part, filter_order, step
)
SELECT * EXCLUDE (x), (sum(removed) OVER (PARTITION BY part, x))::BIGINT AS shapley FROM steps
"""

ORACLE = {
    "op11_prefix_trie": OP11,
    "op12_filter_audit": OP12,
    "op3_warc": OP3,
    "op4_url_filter": OP4,
    "op1_line_dedup": OP1,
}

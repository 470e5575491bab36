"""DuckDB SQL for the corpus queries that SQL can express; it runs over the same whole tables and whole texts."""

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PLAIN = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
FOLDED = rf"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+')"
ALNUM = rf"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

SUBSTRINGS = f"""
WITH docs AS (SELECT doc_id, row_number() OVER () AS r, {PLAIN} AS w FROM documents),
words AS (SELECT r, i, w[i] AS word, CASE WHEN i + 34 <= len(w) THEN sha256(array_to_string(w[i:i + 34], ' ')) END AS k FROM docs, unnest(range(1, len(w) + 1)) AS t(i)),
seen AS (SELECT r, i, word, CASE WHEN k IS NOT NULL AND count(*) OVER (PARTITION BY k) > 1 THEN 1 ELSE 0 END AS again FROM words),
cut AS (SELECT r, i, word, max(again) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) AS gone FROM seen),
sums AS (SELECT r, sum(gone)::BIGINT AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (gone = 0) AS kept FROM cut GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM docs LEFT JOIN sums USING (r)
"""

NEAR = f"""
WITH RECURSIVE docs AS (SELECT doc_id, {FOLDED} AS w FROM documents),
sets AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s FROM docs, unnest(range(1, greatest(len(w) - 3, CASE WHEN len(w) > 0 THEN 2 ELSE 1 END))) AS t(i)),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY 1),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * k >= 85 * (x.n + y.n - k)),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(m, doc_id)) AS component_id, doc_id <= coalesce(m, doc_id) AS kept
FROM docs LEFT JOIN sizes USING (doc_id) LEFT JOIN (SELECT a AS doc_id, min(b) AS m FROM reach GROUP BY 1) USING (doc_id)
"""

WARC = """
SELECT page_id, size AS payload_bytes, sha AS payload_digest, CASE WHEN size >= 1000 AND last <> page_id THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN size >= 1000 AND last <> page_id THEN last END AS refers_to
FROM (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS size, sha1(coalesce(html, '')) AS sha, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS last FROM pages)
"""

LEAKS = f"""
WITH items AS (SELECT item_id, {ALNUM} AS w FROM benchmark),
windows AS (SELECT item_id, least(len(w), 13) AS n, array_to_string(w[i:i + 12], ' ') AS s FROM items, unnest(range(1, greatest(len(w) - 11, CASE WHEN len(w) > 0 THEN 2 ELSE 1 END))) AS t(i)),
docs AS (SELECT doc_id, row_number() OVER () AS r, {ALNUM} AS w FROM documents),
lengths AS (SELECT DISTINCT n FROM windows),
starts AS (SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS s FROM docs, lengths, unnest(range(1, greatest(len(w) - n + 2, 1))) AS t(i)),
hits AS (SELECT r, i, starts.n, item_id FROM starts JOIN windows ON starts.n = windows.n AND starts.s = windows.s),
covered AS (SELECT r, count(DISTINCT j) AS n_hit FROM (SELECT DISTINCT r, i, n FROM hits), unnest(range(i, i + n)) AS t(j) GROUP BY r),
found AS (SELECT r, list_sort(list(DISTINCT item_id::VARCHAR)) AS ids FROM hits GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(len(ids), 0)::BIGINT AS n_items, sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256, coalesce(n_hit > 0 AND 20 * n_hit >= len(w), false) AS contaminated
FROM docs LEFT JOIN covered USING (r) LEFT JOIN found USING (r)
"""

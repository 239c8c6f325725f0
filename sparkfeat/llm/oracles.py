"""DuckDB SQL of the operators' queries that SQL can express."""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_SPACE = r"[^\x20\x09-\x0D]+"

ORACLES = {
    "op2_suffix": """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
c AS (SELECT doc_id, length(h) // 2 AS n, k, substr(h, 512 * k + 1, 610) AS piece FROM (SELECT doc_id, h, unnest(range((length(h) + 511) // 512)) AS k FROM d)),
b AS (SELECT doc_id, 256 * k + i AS p, substr(piece, 2 * i + 1, 2) AS x, CASE WHEN 256 * k + i + 50 <= n THEN substr(piece, 2 * i + 1, 100) END AS s
      FROM (SELECT *, unnest(range(least(256, n - 256 * k))) AS i FROM c)),
w AS (SELECT doc_id, p, min(doc_id) OVER (PARTITION BY s) < doc_id AS late FROM b WHERE s IS NOT NULL),
g AS (SELECT b.doc_id, b.p, b.x,
             coalesce(max(CASE WHEN w.late THEN 1 ELSE 0 END) OVER (PARTITION BY b.doc_id ORDER BY b.p ROWS BETWEEN 49 PRECEDING AND CURRENT ROW), 0) AS gone
      FROM b LEFT JOIN w ON b.doc_id = w.doc_id AND b.p = w.p),
r AS (SELECT *, coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY p), 0) AS before FROM g),
s AS (SELECT doc_id, count(*) AS n, sum(gone) AS removed, sum(CASE WHEN gone = 1 AND before = 0 THEN 1 ELSE 0 END) AS spans,
             coalesce(string_agg(x, '' ORDER BY p) FILTER (WHERE gone = 0), '') AS kept FROM r GROUP BY doc_id)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_bytes, coalesce(removed, 0)::BIGINT AS n_removed, coalesce(spans, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM d LEFT JOIN s ON d.doc_id = s.doc_id
""",
    "op4_decontaminate": f"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_ALNUM}') AS ws FROM documents),
i AS (SELECT item_id, regexp_extract_all({_LOWER}, '{_ALNUM}') AS ws FROM benchmark),
iw AS (SELECT DISTINCT item_id, least(13, len(ws)) AS m, array_to_string(ws[a:a + least(13, len(ws)) - 1], ' ') AS s
       FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 12, 1) + 1)) AS a FROM i WHERE len(ws) > 0)),
m AS (SELECT DISTINCT m FROM iw),
dw AS (SELECT doc_id, m, a, array_to_string(ws[a:a + m - 1], ' ') AS s
       FROM (SELECT doc_id, ws, m, unnest(range(1, len(ws) - m + 2)) AS a FROM d, m WHERE len(ws) >= m)),
f AS (SELECT DISTINCT dw.doc_id, dw.a, dw.m, iw.item_id FROM dw JOIN iw ON dw.s = iw.s AND dw.m = iw.m),
h AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(a, a + m)) AS p FROM f) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS names
      FROM (SELECT DISTINCT doc_id, item_id FROM f) GROUP BY doc_id)
SELECT d.doc_id, len(ws)::BIGINT AS n_words, coalesce(h.n, 0)::BIGINT AS n_hit, coalesce(t.n, 0)::BIGINT AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(h.n, 0) > 0 AND 20 * coalesce(h.n, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN h ON d.doc_id = h.doc_id LEFT JOIN t ON d.doc_id = t.doc_id
""",
    "op10_relative_lz": f"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_SPACE}') AS ws FROM documents),
w AS (SELECT doc_id, p, ws[p] AS word, CASE WHEN p + 19 <= len(ws) THEN array_to_string(ws[p:p + 19], ' ') END AS s
      FROM (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS p FROM d)),
r AS (SELECT doc_id, p, word, CASE WHEN s IS NOT NULL AND row_number() OVER (PARTITION BY s ORDER BY doc_id, p) > 1 THEN 1 ELSE 0 END AS late FROM w),
g AS (SELECT doc_id, p, word, max(late) OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS gone FROM r),
s AS (SELECT doc_id, count(*) AS n, sum(gone) AS removed, coalesce(string_agg(word, ' ' ORDER BY p) FILTER (WHERE gone = 0), '') AS kept
      FROM g GROUP BY doc_id)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_words, coalesce(removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN s ON d.doc_id = s.doc_id
""",
    "op7_warc": """
WITH p AS (
  SELECT page_id, url, coalesce(encode(html), ''::BLOB) AS payload FROM pages
), d AS (
  SELECT page_id, url, octet_length(payload) AS n, sha1(payload) AS digest,
         max(page_id) OVER (PARTITION BY payload) AS first_id
  FROM p
)
SELECT page_id, n::BIGINT AS payload_bytes, digest AS payload_digest,
       CASE WHEN n >= 1000 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND page_id <> first_id THEN first_id END AS refers_to,
       coalesce(url, '-') AS url
FROM d
""",
    "op11_resampling": f"""
WITH t AS (SELECT list_transform(range(256), lambda i: list_reduce([i] || range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc),
d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_ALNUM}') AS ws FROM documents),
dw AS (SELECT doc_id, w, count(*) AS n FROM (SELECT doc_id, unnest(ws) AS w FROM d) GROUP BY ALL),
bw AS (SELECT w, count(*) AS n FROM (SELECT unnest(regexp_extract_all({_LOWER}, '{_ALNUM}')) AS w FROM benchmark) GROUP BY w),
x AS (SELECT w, hex(encode(w)) AS h FROM (SELECT w FROM dw UNION SELECT w FROM bw)),
y AS (SELECT w, list_transform(range(length(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT) AS bytes FROM x),
z AS (SELECT w, xor(list_reduce([4294967295::BIGINT] || bytes, lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS b FROM y, t),
s AS (SELECT b, sum(n) AS n FROM dw JOIN z USING (w) GROUP BY b),
u AS (SELECT b, sum(n) AS n FROM bw JOIN z USING (w) GROUP BY b),
g AS (SELECT range AS b, floor(1000 * ln((coalesce(u.n, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM s) + 10000)::DOUBLE
             / ((coalesce(s.n, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM u) + 10000)::DOUBLE)))::BIGINT AS gain
      FROM range(10000) LEFT JOIN s ON s.b = range LEFT JOIN u ON u.b = range),
f AS (SELECT doc_id, sum(n) AS n, sum(n * gain) AS weight FROM dw JOIN z USING (w) JOIN g USING (b) GROUP BY doc_id),
r AS (SELECT d.doc_id, len(ws) AS n_words, coalesce(f.n, 0)::BIGINT AS n_features, coalesce(f.weight, 0)::BIGINT AS weight,
             floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || d.doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS noise
      FROM d LEFT JOIN f ON d.doc_id = f.doc_id),
k AS (SELECT *, CASE WHEN n_words >= 20 THEN row_number() OVER (PARTITION BY n_words >= 20 ORDER BY weight + noise DESC, doc_id) END AS place,
             10 * (count(*) FILTER (WHERE n_words >= 20) OVER ()) // 100 AS drawn FROM r)
SELECT doc_id, n_features, weight, weight + noise AS score, CASE WHEN place <= drawn THEN place END AS rank FROM k
""",
}

"""DuckDB SQL for the operators' queries that SQL can express."""

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
SHINGLE_WORDS = rf"regexp_extract_all({LOWER}, '[^\x20\x09-\x0D]+')"
PLAIN_WORDS = rf"regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP1 = rf"""
WITH w AS (
  SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS text, {WORDS} AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
g AS (
  SELECT rid, i, words[i] || chr(10) || words[i + 1] || chr(10) || words[i + 2] AS gram
  FROM (SELECT rid, words, unnest(range(1, len(words) - 1)) AS i FROM w WHERE len(words) >= 3)),
r AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, gram) AS n FROM g) WHERE n > 1),
c AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM r) GROUP BY rid),
b AS (
  SELECT doc_id, source, CAST(len(words) AS BIGINT) AS n_words,
         CAST(coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         CAST(length(text) - length(translate(text, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words
  FROM w LEFT JOIN c USING (rid)),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM b),
h AS (SELECT source, count(*) AS n, sum(CAST(base_failed AS BIGINT)) AS k FROM f WHERE source IS NOT NULL GROUP BY source),
p AS (SELECT count(*) AS h, CAST(sum(n) AS DOUBLE) AS n, CAST(sum(k) AS DOUBLE) AS k,
             round(sum(CAST(k * k AS DOUBLE) / n), 6) AS q FROM h),
m AS (SELECT k / n AS mean, (k / n) * (1 - k / n) AS spread,
             (q - k * k / n) / n - (k / n) * (1 - k / n) * (h - 1) / n AS excess FROM p),
s AS (SELECT mean, round(least(greatest(CASE WHEN excess > 0 THEN spread / excess - 1 ELSE 1000 END, 1), 1000), 3) AS strength FROM m),
v AS (SELECT source, (k + mean * strength) / (n + strength) >= 0.5 AS host_rejected FROM h, s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT coalesce(host_rejected, false) AS kept, coalesce(host_rejected, false) AS host_rejected
FROM f LEFT JOIN v ON f.source = v.source
"""

OP2 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes FROM pages),
f AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY html) ELSE page_id END AS first FROM p)
SELECT page_id, payload_bytes, sha256(html) AS payload_digest,
       CASE WHEN first IS NOT DISTINCT FROM page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first IS DISTINCT FROM page_id THEN first END AS refers_to
FROM f
"""

OP3 = f"""
WITH w AS (SELECT row_number() OVER () AS rid, doc_id, {WORDS} AS words FROM documents),
k AS (
  SELECT rid, i, md5(array_to_string(words[i:i + 34], ' ')) AS k
  FROM (SELECT rid, words, unnest(range(1, len(words) - 33)) AS i FROM w WHERE len(words) >= 35)),
r AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY k) AS n FROM k) WHERE n > 1),
gone AS (SELECT DISTINCT rid, unnest(range(i, i + 35)) AS i FROM r),
l AS (SELECT rid, i, words[i] AS word FROM (SELECT rid, words, unnest(range(1, len(words) + 1)) AS i FROM w)),
s AS (SELECT rid, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS text FROM l ANTI JOIN gone USING (rid, i) GROUP BY rid)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(s.text, '')) AS kept_sha256
FROM w LEFT JOIN s USING (rid)
"""

OP4 = """
WITH t AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations),
c AS (SELECT conv_id, list({'role': role, 'text': text} ORDER BY turn NULLS FIRST) AS said, count(*) AS n FROM t GROUP BY conv_id),
k AS (SELECT a.conv_id FROM c a WHERE NOT EXISTS (
  SELECT 1 FROM c b WHERE b.said[1:a.n] = a.said AND (b.n > a.n OR b.n = a.n AND b.conv_id < a.conv_id))),
p AS (SELECT conv_id, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS pos,
             count(*) OVER (PARTITION BY conv_id) AS n FROM t SEMI JOIN k USING (conv_id))
SELECT conv_id, n AS n_turns, CAST((pos - 1) // 64 AS BIGINT) AS part,
       string_agg('<|' || coalesce(role, '') || '|>' || chr(10) || coalesce(text, '') || '<|end|>' || chr(10), '' ORDER BY pos) AS rendered
FROM p GROUP BY 1, 2, 3
"""

OP5 = f"""
WITH b AS (SELECT CAST(item_id AS VARCHAR) AS item, {PLAIN_WORDS} AS words FROM benchmark),
q AS (SELECT DISTINCT item, array_to_string(words[i:i + 12], ' ') AS k, least(13, len(words)) AS n
      FROM (SELECT item, words, unnest(range(1, greatest(2, len(words) - 11))) AS i FROM b WHERE len(words) > 0)),
d AS (SELECT row_number() OVER () AS rid, doc_id, {PLAIN_WORDS} AS words FROM documents),
g AS (SELECT rid, i, n, array_to_string(words[i:i + n - 1], ' ') AS k
      FROM (SELECT rid, words, n, unnest(range(1, len(words) - n + 2)) AS i
            FROM d, (SELECT DISTINCT n FROM q) WHERE len(words) >= n)),
m AS (SELECT rid, i, q.n, item FROM g JOIN q ON g.k = q.k AND g.n = q.n),
h AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM m) GROUP BY rid),
o AS (SELECT rid, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM m GROUP BY rid)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM d LEFT JOIN h USING (rid) LEFT JOIN o USING (rid)
"""

OP7 = r"""
WITH u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
s AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
v AS (SELECT *, CASE
    WHEN ('.' || host) LIKE '%.www.example.com' AND starts_with(path, '/en/') THEN 'www.example.com/en/'
    WHEN ('.' || host) LIKE '%.example.com' AND starts_with(path, '/en/') THEN 'example.com/en/'
    WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/fr/') THEN 'net/fr/'
    WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN ('.' || host) LIKE '%.com' AND starts_with(path, '/') THEN 'com/' END AS rule FROM s)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.com/en/', 'net/fr/', 'net/es/') THEN 'block'
            WHEN rule IS NOT NULL THEN 'allow'
            WHEN regexp_matches('.' || host, '\.(spam-farm|adserver)\.') OR starts_with(path, '/wp-login.php') THEN 'block'
            ELSE 'allow' END AS verdict
FROM v
"""

OP8 = """
WITH d AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id, text) AS rid, hex(encode(coalesce(text, ''))) AS h FROM documents),
k AS (SELECT rid, i, md5(substr(h, 2 * i + 1, 200)) AS k
      FROM (SELECT rid, h, unnest(range(0, length(h) // 2 - 99)) AS i FROM d WHERE length(h) >= 200)),
r AS (SELECT rid, i FROM (SELECT rid, i, row_number() OVER (PARTITION BY k ORDER BY rid, i) AS n FROM k) WHERE n > 1),
j AS (SELECT rid, i, coalesce(i - lag(i) OVER (PARTITION BY rid ORDER BY i) > 100, true) AS fresh FROM r),
e AS (SELECT rid, i, sum(CAST(fresh AS INT)) OVER (PARTITION BY rid ORDER BY i) AS g FROM j),
s AS (SELECT rid, min(i) AS a, max(i) + 100 AS z FROM e GROUP BY rid, g),
b AS (SELECT rid, a, z, coalesce(lag(z) OVER (PARTITION BY rid ORDER BY a), 0) AS before FROM s),
t AS (SELECT rid, sum(z - a) AS n, count(*) AS spans, max(z) AS upto,
             string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS front
      FROM b JOIN d USING (rid) GROUP BY rid)
SELECT doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(front, '') || substr(h, 2 * coalesce(upto, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN t USING (rid)
"""

OP9 = f"""
WITH RECURSIVE w AS (SELECT doc_id, {SHINGLE_WORDS} AS words FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(words[i:i + 3], ' ') AS k
      FROM (SELECT doc_id, words, unnest(range(1, greatest(2, len(words) - 2))) AS i FROM w WHERE len(words) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b ON a.k = b.k AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * common >= 80 * (x.n + y.n - common)),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
m AS (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept FROM m LEFT JOIN n USING (doc_id)
"""

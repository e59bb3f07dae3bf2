"""DuckDB statements for the queries that SQL can express, written apart from the operators."""

LINES = r"""
WITH l AS (
  SELECT doc_id, text, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
o AS (SELECT key, max(doc_id) AS holder FROM k WHERE length(key) >= 40
      GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
m AS (SELECT k.*, o.key IS NOT NULL AND k.doc_id <> o.holder AS gone FROM k LEFT JOIN o ON k.key = o.key)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id"""

URLS = r"""
WITH rules(action, host, path) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'),
  ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
r AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
      FROM pages),
h AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM r),
p AS (SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM h),
b AS (SELECT p.page_id, p.host, p.path, rules.host || rules.path AS rule, rules.action AS verdict,
             row_number() OVER (PARTITION BY p.page_id ORDER BY length(rules.host || rules.path) DESC) AS n
      FROM p LEFT JOIN rules ON (p.host = rules.host OR ends_with(p.host, '.' || rules.host))
                            AND starts_with(p.path, rules.path))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM b WHERE n = 1"""

DECONTAMINATION = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[s:s + 9], ' ') AS g
        FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS s FROM i WHERE len(w) > 0)),
ns AS (SELECT DISTINCT n FROM win),
occ AS (SELECT doc_id, n, s, array_to_string(w[s:s + n - 1], ' ') AS g
        FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS s FROM d, ns WHERE len(w) >= n)),
hit AS (SELECT occ.doc_id, occ.s, occ.n, win.item_id FROM occ JOIN win USING (n, g)),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit
        FROM (SELECT doc_id, unnest(generate_series(s, s + n - 1)) AS p FROM hit) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
        FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos ON d.doc_id = pos.doc_id LEFT JOIN its ON d.doc_id = its.doc_id"""

MIXING = r"""
WITH rows AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
                ('0x' || substr(md5('7|' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT AS place FROM documents),
src AS (SELECT source, sum(size)::DOUBLE AS s,
               [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS w
        FROM rows GROUP BY source),
seq AS (SELECT *, sum(s) OVER () AS total, row_number() OVER o AS i,
               coalesce(sum(3 * s) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used,
               sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open
        FROM src WINDOW o AS (ORDER BY 3 * s / w, source)),
lev AS (SELECT (total - used) / open AS level FROM seq WHERE (total - used) / open * w < 3 * s ORDER BY i LIMIT 1),
tgt AS (SELECT source, s, least(3 * s, coalesce((SELECT level * w FROM lev), 3 * s)) AS target FROM src),
run AS (SELECT rows.*, s, target, CASE WHEN s > 0 THEN target / s ELSE 0 END AS e,
               sum(size) OVER (PARTITION BY rows.source ORDER BY place, doc_id, size
                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
        FROM rows JOIN tgt ON rows.source IS NOT DISTINCT FROM tgt.source),
f AS (SELECT *, floor(e + 1e-9) AS whole, greatest((e - floor(e + 1e-9)) * s, 0) AS extra FROM run)
SELECT doc_id, size, s::BIGINT AS source_size, target,
       (size * (whole + CASE WHEN extra > 0 AND upto - size / 2 <= extra THEN 1 ELSE 0 END))::BIGINT AS taken
FROM f"""

COLLOCATIONS = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang,
                  unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                               '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
i AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM w),
g AS (SELECT lang, len(k.g) AS m, array_to_string(k.g, ' ') AS phrase, k.g AS g, count(*) AS f
      FROM (SELECT lang, unnest([{'g': w[i:i]}, {'g': CASE WHEN i + 1 <= len(w) THEN w[i:i+1] END},
                                 {'g': CASE WHEN i + 2 <= len(w) THEN w[i:i+2] END}]) AS k FROM i)
      WHERE k.g IS NOT NULL GROUP BY ALL),
n AS (SELECT lang, sum(f) AS n FROM g WHERE m = 1 GROUP BY lang),
c AS (SELECT lang, phrase, g, f AS a, unnest(range(1, m)) AS k FROM g WHERE m > 1 AND f >= 10),
s AS (SELECT c.lang, c.phrase, c.a, k, l.f AS l, r.f AS r,
             (1000000::HUGEINT * c.a * c.a) // (l.f::HUGEINT * r.f) AS score
      FROM c JOIN g l ON l.lang = c.lang AND l.phrase = array_to_string(c.g[1:k], ' ')
             JOIN g r ON r.lang = c.lang AND r.phrase = array_to_string(c.g[k+1:len(c.g)], ' ')),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
h AS (SELECT lang, phrase, max(f) AS f FROM (SELECT lang, f, unnest([array_to_string(g[1:2], ' '), array_to_string(g[2:3], ' ')]) AS phrase
                                            FROM g WHERE m = 3 AND f >= 10) GROUP BY ALL),
t AS (SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank
      FROM b LEFT JOIN h ON h.lang = b.lang AND h.phrase = b.phrase WHERE coalesce(100 * h.f < 50 * b.a, true))
SELECT t.lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n.n::BIGINT AS n, score::BIGINT AS score
FROM t JOIN n ON n.lang = t.lang WHERE rank <= 2000"""

ORACLES = {"op1_line_dedup": LINES, "op3_url_filters": URLS, "op4_decontamination": DECONTAMINATION,
           "op10_mixing": MIXING, "op12_collocations": COLLOCATIONS}

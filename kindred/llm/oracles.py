"""The queries that SQL can express, as DuckDB SQL; rules and constants are written out again here."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

ORACLES["op3_url_filter"] = r"""
WITH parts AS (
  SELECT page_id,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path
  FROM pages),
rules(rule, h, p, says) AS (VALUES
  ('com/', 'com', '/', 'allow'), ('example.com/en/', 'example.com', '/en/', 'block'),
  ('www.example.com/en/', 'www.example.com', '/en/', 'allow'),
  ('net/es/', 'net', '/es/', 'block'), ('net/fr/', 'net', '/fr/', 'block')),
best AS (
  SELECT page_id, host, path, max(struct_pack(n := length(rule), rule := rule, says := says)) AS b
  FROM (SELECT DISTINCT * FROM parts) JOIN rules
    ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
  GROUP BY ALL),
judged AS (
  SELECT parts.*, b.rule AS rule, b.says AS says,
    CASE WHEN starts_with(path, '/wp-admin') THEN '*/wp-admin*'
         WHEN regexp_matches(path, '(?s)^/.*login') THEN '*/*login*'
         WHEN starts_with(path, '/cart') THEN '*/cart*'
         WHEN starts_with(host, 'ads.') AND starts_with(path, '/') THEN 'ads.*/*'
         WHEN regexp_matches(path, '(?s)^/.*\.xml$') THEN '*/*.xml'
         WHEN starts_with(host, 'm.') AND regexp_matches(path, '(?s)^/.*/9..$') THEN 'm.*/*/9??' END AS "glob"
  FROM parts LEFT JOIN best USING (page_id, host, path))
SELECT page_id, host, path, rule, "glob", coalesce(says, CASE WHEN "glob" IS NULL THEN 'allow' ELSE 'block' END) AS verdict
FROM judged
"""

ORACLES["op6_mixing"] = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))), 1, 13))::BIGINT AS key
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    [3.0, 1.0, 2.0][1 + ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3)::INT]::DOUBLE AS weight
  FROM d GROUP BY source),
filled AS (
  SELECT *, 2 * source_size / weight AS ratio,
    sum(source_size) OVER (ORDER BY 2 * source_size / weight, source NULLS LAST
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS full_size,
    sum(weight) OVER (ORDER BY 2 * source_size / weight, source NULLS LAST
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weight_left
  FROM s),
multiple AS (
  SELECT min_by(m, ratio) AS m FROM (
    SELECT ratio, weight, source_size,
      (1.5::DOUBLE * (SELECT sum(source_size) FROM s)::DOUBLE - 2.0::DOUBLE * coalesce(full_size, 0)::DOUBLE) / weight_left AS m
    FROM filled) WHERE m * weight < 2 * source_size),
t AS (
  SELECT source, source_size, least(2.0::DOUBLE * source_size, (SELECT m FROM multiple) * weight)::DOUBLE AS target FROM s),
placed AS (
  SELECT d.*, source_size, target, round(target)::BIGINT AS whole,
    sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id NULLS FIRST, size ROWS UNBOUNDED PRECEDING) - size AS first
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  (CASE WHEN source_size > 0
     THEN (whole // source_size) * size + greatest(0, least(size, whole % source_size - first)) ELSE 0 END)::BIGINT AS taken
FROM placed
"""

ORACLES["op4_license_scan"] = r"""
WITH templates(t, label, exact, words) AS (VALUES
  (0, 'mit', true, 'mit license'), (1, 'apache', true, 'apache license'), (2, 'gpl', true, 'general public license'),
  (3, 'mit', false, 'released under the mit license'),
  (4, 'mit', false, 'permission is hereby granted free of charge to any person obtaining a copy of this software'),
  (5, 'apache', false, 'licensed under the apache license version 2 0'),
  (6, 'gpl', false, 'this work is licensed under the gnu general public license version 3'),
  (7, 'gpl', false, 'you can redistribute it and or modify it under the terms of the gnu general public license'),
  (8, 'mpl', false, 'subject to the terms of the mozilla public license v 2 0'),
  (9, 'bsd', false, 'redistribution and use in source and binary forms with or without modification are permitted'),
  (10, 'cc-by-nc', false, 'licensed under cc by nc 4 0'), (11, 'cc-by-sa', false, 'licensed under cc by sa 4 0'),
  (12, 'cc-by', false, 'licensed under a creative commons attribution 4 0 international license')),
cut AS (SELECT *, string_split(words, ' ') AS ws FROM templates),
runs AS (
  SELECT t, label, exact, len(ws) - 1 AS n_runs, unnest(range(len(ws) - 1)) AS place,
    unnest(ws[1:len(ws) - 1]) AS a, unnest(ws[2:len(ws)]) AS b
  FROM cut),
docs AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM documents),
pairs AS (
  SELECT row, unnest(range(len(ws) - 1)) AS pos, unnest(ws[1:len(ws) - 1]) AS a, unnest(ws[2:len(ws)]) AS b
  FROM docs WHERE len(ws) > 1),
diagonals AS (
  SELECT row, t, label, exact, n_runs, pos - place AS d, min(pos) AS low, max(pos) AS high, list(DISTINCT place) AS met
  FROM pairs JOIN runs USING (a, b) GROUP BY ALL),
marked AS (
  SELECT *, CASE WHEN exact OR lag(d) OVER w IS NULL OR d - lag(d) OVER w > 2
      OR greatest(low, lag(low) OVER w) - least(high, lag(high) OVER w) > n_runs + 2 THEN 1 ELSE 0 END AS apart
  FROM diagonals WINDOW w AS (PARTITION BY row, t ORDER BY d)),
clustered AS (SELECT *, sum(apart) OVER (PARTITION BY row, t ORDER BY d) AS c FROM marked),
merged AS (
  SELECT row, t, label, exact, n_runs, c, min(low) AS s, max(high) + 2 AS e, len(list_distinct(flatten(list(met)))) AS m
  FROM clustered GROUP BY ALL),
-- Of a chain that is too long: what lies on one diagonal, and on all from it on that fit into the longest span.
chained AS (
  SELECT clustered.*, (n_runs + 1) // 2 + 2 AS drift FROM clustered JOIN merged USING (row, t, label, exact, n_runs, c)
  WHERE NOT exact AND e - s > (n_runs + 1) * 1.5 + 2),
several AS (
  SELECT x.row, x.t, x.label, x.exact, x.n_runs, x.c, x.d, x.drift, len(x.met) AS own, x.low, x.high,
    min(y.low) AS s, max(y.high) + 2 AS e, len(list_distinct(flatten(list(y.met)))) AS m
  FROM chained x JOIN chained y ON x.row = y.row AND x.t = y.t AND x.c = y.c AND y.d BETWEEN x.d AND x.d + x.drift
  GROUP BY ALL),
tried AS (
  SELECT row, t, label, exact, n_runs, c, d, drift, m, CASE WHEN own = m THEN 1 ELSE 0 END AS alone,
    CASE WHEN own = m THEN low ELSE s END AS s, CASE WHEN own = m THEN high + 2 ELSE e END AS e FROM several),
chosen AS (
  SELECT * FROM tried x WHERE NOT EXISTS (
    SELECT 1 FROM tried y WHERE x.row = y.row AND x.t = y.t AND x.c = y.c AND abs(x.d - y.d) <= x.drift
      AND (y.m > x.m OR (y.m = x.m AND (y.alone > x.alone OR (y.alone = x.alone AND y.d < x.d)))))),
spans AS (
  SELECT row, label, exact, s, e, m / n_runs AS share FROM merged
  WHERE CASE WHEN exact THEN m = n_runs ELSE m / n_runs >= 0.75 AND e - s <= (n_runs + 1) * 1.5 + 2 END
  UNION ALL SELECT row, label, exact, s, e, m / n_runs FROM chosen WHERE m / n_runs >= 0.75)
SELECT doc_id, len(ws)::BIGINT AS n_words, count(*) FILTER (exact) AS n_base,
  min(s) FILTER (exact)::BIGINT AS first_word, max(s) FILTER (exact)::BIGINT AS last_word,
  coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (exact), '') AS base_labels,
  coalesce(string_agg(DISTINCT label, ',' ORDER BY label), '') AS labels, coalesce(max(share), 0.0)::DOUBLE AS score
FROM docs LEFT JOIN spans USING (row) GROUP BY row, doc_id, ws
"""

ORACLES["op11_spelling"] = r"""
WITH RECURSIVE
-- crc32 is linear: every byte adds a value of its place from the end, to that of so many zeros.
bits(b, v, k) AS (
  SELECT range, range, 0 FROM range(256)
  UNION ALL SELECT b, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, k + 1 FROM bits WHERE k < 8),
t AS MATERIALIZED (SELECT b, v FROM bits WHERE k = 8),
runs AS MATERIALIZED (
  SELECT doc_id, run, count(*) AS c, encode(coalesce(doc_id::VARCHAR, '') || ':' || run) AS said, row_number() OVER () AS r
  FROM (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]{7,}')),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents)
  GROUP BY doc_id, run),
most AS MATERIALIZED (SELECT coalesce(max(octet_length(said)), 0) AS n FROM runs),
places(k, b, v) AS (
  SELECT 0, b, v FROM t
  UNION ALL SELECT k + 1, p.b, xor(p.v >> 8, t.v) FROM places p JOIN t ON t.b = p.v & 255 WHERE k < (SELECT n FROM most)),
zeros(k, v) AS (
  SELECT 0, 4294967295
  UNION ALL SELECT k + 1, xor(z.v >> 8, t.v) FROM zeros z JOIN t ON t.b = z.v & 255 WHERE k < (SELECT n FROM most)),
bytes AS (
  SELECT r, octet_length(said) - i AS k, ('0x' || substr(hex(said), 2 * i - 1, 2))::BIGINT AS b
  FROM (SELECT r, said, unnest(generate_series(1, octet_length(said))) AS i FROM runs)),
crc AS (SELECT r, bit_xor(v) AS v FROM bytes JOIN places USING (k, b) GROUP BY r),
met AS (
  SELECT run, c, xor(xor(crc.v, zeros.v), 4294967295) AS h
  FROM runs JOIN crc USING (r) JOIN zeros ON zeros.k = octet_length(said)),
words AS MATERIALIZED (
  SELECT word, sum(c)::BIGINT AS n FROM (
    SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2)
      ELSE run END AS word, c FROM met)
  WHERE length(word) >= 7 GROUP BY word HAVING sum(c) >= 2),
-- Two words of a length differ in one place if they agree without it; a longer one must give the other.
short AS MATERIALIZED (
  SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, unnest(generate_series(1, length(word))) AS i FROM words)),
near AS MATERIALIZED (
  SELECT DISTINCT x.word AS a, y.word AS b FROM short x JOIN short y ON x.rest = y.rest AND x.i = y.i AND x.word <> y.word
  UNION SELECT DISTINCT short.word, words.word FROM short JOIN words ON short.rest = words.word
  UNION SELECT DISTINCT words.word, short.word FROM short JOIN words ON short.rest = words.word),
best AS (
  SELECT a, count(*) AS n_near, min(struct_pack(less := -n, form := b)) AS f
  FROM near JOIN words ON words.word = near.b GROUP BY a),
formed AS MATERIALIZED (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN -f.less >= 10 * n THEN f.form END AS form,
    CASE WHEN -f.less >= 10 * n THEN -f.less END AS form_n
  FROM words LEFT JOIN best ON a = word),
ways(word, root) AS (
  SELECT word, word FROM formed
  UNION ALL SELECT ways.word, formed.form FROM ways JOIN formed ON formed.word = root WHERE formed.form IS NOT NULL),
roots AS (SELECT ways.word, root FROM ways JOIN formed ON formed.word = root WHERE form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN roots USING (word)
"""

ORACLES["op12_fill_in_middle"] = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n,
    sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h
  FROM documents),
numbers AS (
  SELECT *, ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2,
    ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4 FROM d),
cut AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90
      THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM numbers),
parts AS (SELECT *, substr(text, 1, a) AS p, substr(text, a + 1, b - a) AS m, substr(text, b + 1) AS s FROM cut)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
    ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM parts
"""

"""DuckDB SQL for the registered queries that SQL can express."""

from __future__ import annotations

_OP1 = r"""
WITH RECURSIVE sizes AS (
  SELECT source AS s, count(*) AS n, sqrt(count(*)) AS w FROM documents GROUP BY source),
part AS MATERIALIZED (
  SELECT s, n, row_number() OVER (ORDER BY s) AS i, greatest(1, round(w / sum(w) OVER () * 1073741824)::BIGINT) AS p FROM sizes),
lists AS MATERIALIZED (SELECT list(p ORDER BY i) AS ps, sum(p)::BIGINT AS total FROM part),
cuts AS MATERIALIZED (
  SELECT unnest(range(1, (SELECT max((((n + 15) // 16) * total + p - 1) // p + 1023) // 1024 FROM part, lists) + 1)) * 1024 AS cut),
behind(cut, slot, rest) AS (
  SELECT cut, greatest(cut - 1026, 0), list_sort(list_filter(list_transform(ps, lambda p, i: {
      'dl': (((p * cut) // total + 1) * total + p - 1) // p, 'i': i, 'rl': (((p * cut) // total) * total) // p, 'over': (p * cut) % total <> 0}),
      lambda x: x.over)) FROM cuts, lists
  UNION ALL
  SELECT cut, slot + 1, CASE WHEN len(ready) > list_sum(list_transform(ps, lambda p: (p * (slot + 1) + total - 1) // total)) - (slot + 1)
    THEN list_filter(rest, lambda x: x.i <> ready[1].i) ELSE rest END
  FROM (SELECT cut, slot, rest, ps, total, list_filter(rest, lambda x: x.rl < slot + 1) AS ready FROM behind, lists WHERE slot < cut)),
ends AS MATERIALIZED (
  SELECT cut, list_transform(ps, lambda p, i: (p * cut) // total + CASE WHEN (p * cut) % total <> 0
    AND NOT list_contains(list_transform(rest, lambda x: x.i), i) THEN 1 ELSE 0 END) AS es FROM behind, lists WHERE slot = cut),
run(t, done, picked) AS (
  SELECT 0::BIGINT, list_transform(ps, lambda x: 0::BIGINT), 0::BIGINT FROM lists
  UNION ALL
  SELECT t + 1, list_transform(done, lambda d, i: d + CASE WHEN i = best.i THEN 1 ELSE 0 END), best.i
  FROM (SELECT t, done, list_min(list_filter(list_transform(ps, lambda p, i:
      {'dl': ((done[i] + 1) * total + p - 1) // p, 'i': i, 'ready': done[i] < es[i] AND (done[i] * total) // p <= t}),
      lambda x: x.ready)) AS best FROM run, lists, ends WHERE cut = (t // 1024 + 1) * 1024)),
slots AS (SELECT picked AS i, t - 1 AS slot, done[picked] - 1 AS block FROM run WHERE t > 0),
numbered AS (
  SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY md5('mix-1:' || doc_id::VARCHAR), doc_id) - 1 AS n FROM documents),
b AS (SELECT doc_id, source, numbered.n % 16 AS place, numbered.n // 16 AS block, p, i FROM numbered JOIN part ON source = s)
SELECT doc_id, source, block AS mix_block, place AS mix_place, (block * total) // p AS mix_release,
  ((block + 1) * total + p - 1) // p AS mix_deadline, slot AS mix_slot
FROM b JOIN slots USING (i, block), lists
"""

_OP2 = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
w AS (SELECT r, unnest(ws) AS word, generate_subscripts(ws, 1) - 1 AS i FROM d),
phrases(label, ps) AS (VALUES ('mit', ['under', 'the', 'mit', 'license']),
  ('apache-2', ['apache', 'license', 'version', '2']), ('cc-by-nc', ['cc', 'by', 'nc'])),
places AS (
  SELECT r, i, label FROM w JOIN phrases ON word = ps[1] JOIN d USING (r)
  WHERE list_slice(ws, i + 1, i + len(ps)) = ps),
base AS (
  SELECT r, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM places GROUP BY r),
templates(t, label, body) AS (VALUES
  (0, 'mit', 'released under the mit license'),
  (1, 'mit', 'permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files'),
  (2, 'apache-2', 'licensed under the apache license version 2 0'),
  (3, 'cc-by-nc', 'licensed under cc by nc 4 0'),
  (4, 'gpl-3', 'this work is licensed under the gnu general public license version 3'),
  (5, 'gpl-3', 'this program is free software you can redistribute it and or modify it under the terms of the gnu general public license'),
  (6, 'bsd', 'redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met'),
  (7, 'mpl-2', 'this source code form is subject to the terms of the mozilla public license v 2 0')),
tt AS (SELECT t, label, len(string_split(body, ' ')) AS step, len(list_distinct(string_split(body, ' '))) AS size FROM templates),
tw AS (SELECT DISTINCT t, unnest(string_split(body, ' ')) AS word FROM templates),
hits AS (SELECT w.r, t, word, unnest(CASE WHEN i // step > 0 THEN [i // step, i // step - 1] ELSE [0] END) AS k
  FROM w JOIN tw USING (word) JOIN tt USING (t)),
met AS (
  SELECT r, t, k, count(DISTINCT word) AS shared FROM hits GROUP BY r, t, k),
best AS (
  SELECT r, max(shared::DOUBLE / size) AS score, list(DISTINCT label) AS ls
  FROM met JOIN tt USING (t) WHERE 5 * shared >= 4 * size GROUP BY r)
SELECT doc_id, len(ws) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
  coalesce(base_labels, '') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(coalesce(ls, []), CASE WHEN n_base > 0 THEN string_split(base_labels, ',') ELSE [] END))), ',') AS labels,
  CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(score, 0.0) END::DOUBLE AS score
FROM d LEFT JOIN base USING (r) LEFT JOIN best USING (r)
"""

_OP4 = r"""
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_inner_product(q.x, c.x)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id AND len(q.x) = len(c.x))
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
FROM s QUALIFY rank <= 10
"""

_OP5 = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^ \t\n\v\f\r]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS g FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
r(node, root) AS (SELECT doc_id, doc_id FROM documents UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.node),
m AS (SELECT node, min(root) AS component_id FROM r GROUP BY node)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.component_id, d.doc_id = m.component_id AS kept
FROM d LEFT JOIN n USING (doc_id) JOIN m ON m.node = d.doc_id
"""

_OP6 = r"""
WITH u AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
p AS (
  SELECT page_id,
    translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM u)
SELECT page_id, host, path,
  CASE WHEN host = '' THEN NULL
       WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
       WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
       WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
       WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule,
  CASE WHEN rule IN ('example.com/de/', 'net/') THEN 'block' ELSE 'allow' END AS verdict
FROM p
"""

_OP7 = r"""
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
q AS (
  SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS payload_digest,
    max(page_id) OVER (PARTITION BY payload) AS keeper FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id < keeper THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id < keeper THEN keeper END AS refers_to
FROM q
"""

_OP9 = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT r, unnest(ws) AS word, generate_subscripts(ws, 1) AS i
  FROM (SELECT r, regexp_extract_all(text, '[^ \t\n\v\f\r]+') AS ws FROM d)),
win AS (
  SELECT r, i, n, CASE n WHEN 5 THEN g5 WHEN 7 THEN g7 ELSE g10 END AS g FROM (
    SELECT r, i,
      string_agg(word, ' ') OVER (PARTITION BY r ORDER BY i ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING) AS g5,
      string_agg(word, ' ') OVER (PARTITION BY r ORDER BY i ROWS BETWEEN CURRENT ROW AND 6 FOLLOWING) AS g7,
      string_agg(word, ' ') OVER (PARTITION BY r ORDER BY i ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING) AS g10,
      count(*) OVER (PARTITION BY r) AS total FROM w), (VALUES (5), (7), (10)) v(n)
  WHERE i + n - 1 <= total),
dup AS (SELECT r, i, n FROM win QUALIFY count(*) OVER (PARTITION BY r, n, g) > 1),
cov AS (SELECT DISTINCT r, n, unnest(range(i, i + n)) AS i FROM dup),
shares AS (
  SELECT r, count(*) FILTER (n = 5) AS n_repeat_words,
    sum(length(word)) FILTER (n = 5) AS c5, sum(length(word)) FILTER (n = 7) AS c7, sum(length(word)) FILTER (n = 10) AS c10
  FROM cov JOIN w USING (r, i) GROUP BY r),
size AS (SELECT r, count(*) AS n_words, sum(length(word)) AS word_chars FROM w GROUP BY r),
linen AS (SELECT r, unnest(ls) AS line, generate_subscripts(ls, 1) AS i FROM (SELECT r, string_split(text, chr(10)) AS ls FROM d)),
repeats AS (
  SELECT r, count(*) AS n_dup_lines, sum(length(regexp_replace(line, '[ \t\n\v\f\r]', '', 'g'))) AS chars FROM (
    SELECT r, line, row_number() OVER (PARTITION BY r, line ORDER BY i) AS k FROM linen
    WHERE regexp_matches(line, '[^ \t\n\v\f\r]')) WHERE k > 1 GROUP BY r),
m AS (
  SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
    coalesce(c5, 0) AS c5, coalesce(c7, 0) AS c7, coalesce(c10, 0) AS c10, coalesce(chars, 0) AS lc
  FROM d LEFT JOIN size USING (r) LEFT JOIN shares USING (r) LEFT JOIN repeats USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words)
    AND c5::DOUBLE / greatest(word_chars, 1) <= 0.20 AND c7::DOUBLE / greatest(word_chars, 1) <= 0.18
    AND c10::DOUBLE / greatest(word_chars, 1) <= 0.15 AND lc::DOUBLE / greatest(word_chars, 1) <= 0.20 AS kept
FROM m
"""

_OP13 = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce('=' || lang, '') AS tree,
    concat(coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'),
      coalesce(strlen(lang) || ':' || lang, '-'), coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-')) AS head, text,
    list_reduce([4294967295::BIGINT] || list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT),
      lambda acc, byte: list_reduce([xor(acc, byte)] || range(8)::BIGINT[],
        lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS register
  FROM documents),
leaf AS (
  SELECT r, doc_id, tree, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS h,
    CASE WHEN xor(register, 4294967295) % 3 = 0 THEN sha256(head || coalesce(strlen(text) || ':' ||
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-')) END AS changed FROM d),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, h) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n
  FROM leaf),
t AS (
  SELECT tree, 0 AS lvl, pos, n, h FROM numbered
  UNION ALL
  SELECT tree, lvl + 1, pos // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY pos)) FROM t WHERE n > 1
  GROUP BY tree, lvl, pos // 8, n),
subroots AS (
  SELECT tree, lvl AS height, h, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n FROM t WHERE n = 1),
top AS (
  SELECT 0 AS lvl, pos, n, h FROM subroots
  UNION ALL
  SELECT lvl + 1, pos // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY pos)) FROM top WHERE n > 1 GROUP BY lvl, pos // 8, n),
sides AS (
  SELECT r, t.lvl AS step, string_agg(t.h, '' ORDER BY t.pos) FILTER (t.pos < own) AS a,
    string_agg(t.h, '' ORDER BY t.pos) FILTER (t.pos > own) AS b
  FROM (SELECT r, tree, unnest(range(height)) AS lvl, pos // (8 ** lvl)::BIGINT AS own FROM
          (SELECT r, numbered.tree, numbered.pos, height FROM numbered JOIN subroots USING (tree))) x
    JOIN t ON t.tree = x.tree AND t.lvl = x.lvl AND t.pos // 8 = own // 8 GROUP BY r, t.lvl
  UNION ALL
  SELECT r, height + top.lvl, string_agg(top.h, '' ORDER BY top.pos) FILTER (top.pos < own),
    string_agg(top.h, '' ORDER BY top.pos) FILTER (top.pos > own)
  FROM (SELECT r, height, unnest(range((SELECT max(lvl) FROM top))) AS lvl, pos // (8 ** lvl)::BIGINT AS own FROM
          (SELECT r, height, subroots.pos FROM numbered JOIN subroots USING (tree))) x
    JOIN top ON top.lvl = x.lvl AND top.pos // 8 = own // 8 GROUP BY r, height, top.lvl),
climb AS (
  SELECT r, 0 AS step, coalesce(changed, h) AS h FROM numbered
  UNION ALL
  SELECT r, climb.step + 1, sha256(coalesce(a, '') || h || coalesce(b, '')) FROM climb JOIN sides USING (r, step)),
folded AS (SELECT r, max_by(h, step) AS folded_root FROM climb GROUP BY r),
proof AS (SELECT r, sha256(string_agg(coalesce(a, '') || coalesce(b, ''), '' ORDER BY step)) AS proof FROM sides GROUP BY r),
root AS (SELECT h AS root FROM top WHERE n = 1)
SELECT doc_id, numbered.h AS leaf, subroots.h AS subroot, root, coalesce(proof, sha256('')) AS proof_sha256,
  folded_root, folded_root = root AS verified
FROM numbered JOIN subroots USING (tree) JOIN folded USING (r) LEFT JOIN proof USING (r), root
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_mixing": _OP1, "op2_license_scan": _OP2, "op4_top_k": _OP4, "op5_near_duplicates": _OP5, "op7_warc": _OP7, "op6_url_filter": _OP6, "op9_repetition": _OP9,
            "op13_merkle": _OP13}

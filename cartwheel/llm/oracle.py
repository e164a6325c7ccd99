"""DuckDB SQL for the operators' queries that SQL can express, written the
plain way: whole windows as strings, pairs by joins, components by recursion.

No SQL: packing and SentencePiece (token ids), language ID (compression),
fingerprints (piecewise hashes) and quality rules (isolation forest); the tests
hold those against brute-force versions, round trips or held-out accuracy.
"""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORD = r"[^\x20\x09-\x0D]+"
_LICENSE_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# the licence scan's notices, phrases and thresholds, spelled out once more
_NOTICES = """
    ('mit', 0, 'permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction'),
    ('apache', 1, 'licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license'),
    ('gpl', 2, 'this work is licensed under the gnu general public license version 3'),
    ('lgpl', 3, 'licensed under the gnu lesser general public license'),
    ('bsd', 4, 'redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met'),
    ('mpl', 5, 'this source code form is subject to the terms of the mozilla public license'),
    ('cc-by-nc', 6, 'licensed under cc by nc 4 0'),
    ('cc-by-sa', 7, 'licensed under cc by sa 4 0'),
    ('cc-by', 8, 'licensed under a creative commons attribution 4 0 international license')
"""

OP3 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER}, '{_LICENSE_WORD}') AS w FROM documents),
p AS (SELECT r, unnest(w) AS a, generate_subscripts(w, 1) - 1 AS pos FROM d),
g AS (SELECT r, pos, a, lead(a) OVER (PARTITION BY r ORDER BY pos) AS b, lead(a, 2) OVER (PARTITION BY r ORDER BY pos) AS c FROM p),
base AS (
    SELECT r, pos, CASE WHEN a = 'mit' THEN 'mit' WHEN a = 'apache' THEN 'apache' ELSE 'gpl' END AS label FROM g
    WHERE (a IN ('mit', 'apache') AND b = 'license') OR (a = 'general' AND b = 'public' AND c = 'license')),
t AS (SELECT label, tid, string_split(body, ' ') AS w FROM (VALUES {_NOTICES}) AS n(label, tid, body)),
tw AS (SELECT label, tid, len(w) - 2 AS windows, i - 1 AS place, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c
       FROM t, unnest(generate_series(1, len(w) - 2)) AS s(i)),
votes AS (SELECT r, tid, label, windows, pos - place AS diagonal, list(DISTINCT place) AS places
          FROM g JOIN tw USING (a, b, c) GROUP BY ALL),
runs AS (SELECT *, sum(jump) OVER (PARTITION BY r, tid ORDER BY diagonal) AS run FROM (
    SELECT *, CASE WHEN diagonal - lag(diagonal) OVER (PARTITION BY r, tid ORDER BY diagonal) <= 3 THEN 0 ELSE 1 END AS jump FROM votes)),
found AS (SELECT r, label, CAST(len(list_distinct(flatten(list(places)))) AS DOUBLE) / windows AS coverage
          FROM runs GROUP BY r, tid, label, windows, run HAVING coverage >= 0.6),
b AS (SELECT r, count(*) AS n, min(pos) AS lo, max(pos) AS hi, list(DISTINCT label) AS labels FROM base GROUP BY r),
f AS (SELECT r, max(coverage) AS best, list(DISTINCT label) AS labels FROM found GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_base, CAST(lo AS BIGINT) AS first_word, CAST(hi AS BIGINT) AS last_word,
       coalesce(array_to_string(list_sort(b.labels), ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(b.labels, []), coalesce(f.labels, [])))), ','), '') AS labels,
       CASE WHEN n > 0 THEN 1.0 ELSE coalesce(best, 0.0) END::DOUBLE AS score
FROM d LEFT JOIN b USING (r) LEFT JOIN f USING (r)
"""

OP4 = f"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER}, '{_WORD}') AS w FROM documents),
s AS (
    SELECT DISTINCT r, array_to_string(w[i:i + 4], ' ') AS x FROM d, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS g(i) WHERE len(w) > 0),
n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
links AS (
    SELECT a.r AS a, b.r AS b FROM s a JOIN s b ON a.x = b.x AND a.r <> b.r JOIN n na ON na.r = a.r JOIN n nb ON nb.r = b.r
    GROUP BY a.r, b.r, na.n, nb.n HAVING 100 * count(*) >= 80 * (na.n + nb.n - count(*))),
reach AS (SELECT r AS a, r AS b FROM d UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT d.doc_id, coalesce(max(n.n), 0) AS n_shingles, min(o.doc_id) AS component_id
FROM d LEFT JOIN n USING (r) JOIN reach ON reach.a = d.r JOIN d o ON o.r = reach.b
GROUP BY d.r, d.doc_id
"""

# the template's control strings, as a regular expression
_CONTROL = r"<</?SYS>>|\[/?INST\]|</?s>|<\|[^|<>\[\]]*\|>"

OP5 = rf"""
WITH c AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
e AS (SELECT *, regexp_replace(regexp_replace(text, '(\\*)({_CONTROL})', '\1\1\\\2', 'g'), '(\\+)\z', '\1\1') AS body,
             CASE role WHEN 'system' THEN 15 WHEN 'user' THEN 13 WHEN 'assistant' THEN 7 ELSE length(role) + 11 END AS marks FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length(body) + marks) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""

OP7 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents),
win AS (SELECT r, i, array_to_string(w[i:i + 34], ' ') AS x FROM d, unnest(generate_series(1, len(w) - 34)) AS g(i) WHERE len(w) >= 35),
twice AS (SELECT x FROM win GROUP BY x HAVING count(*) > 1),
gone AS (SELECT DISTINCT r, j FROM win JOIN twice USING (x), unnest(generate_series(i, i + 34)) AS g(j)),
p AS (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS j FROM d),
k AS (SELECT r, count(gone.j) AS n, string_agg(word, ' ' ORDER BY j) FILTER (gone.j IS NULL) AS kept FROM p LEFT JOIN gone USING (r, j) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (r)
"""

OP8 = r"""
WITH u AS (
    SELECT row_number() OVER () AS r, page_id,
           translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
    FROM pages),
rules(h, p, v) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
fit AS (
    SELECT r, h || p AS rule, v, row_number() OVER (PARTITION BY r ORDER BY length(h) + length(p) DESC) AS k
    FROM u JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p))
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM u LEFT JOIN (SELECT * FROM fit WHERE k = 1) USING (r)
"""

OP11 = """
WITH v AS (
    SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS x FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(CAST(q.x AS DOUBLE[]), CAST(c.x AS DOUBLE[])) AS BIGINT) AS score
      FROM v AS q JOIN v AS c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

OP12 = r"""
WITH d AS (
    SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS t,
           sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
x AS (SELECT *, len(t) AS n, [CAST('0x' || substr(h, 8 * i + 1, 8) AS BIGINT) for i in range(4)] AS r FROM d),
c AS (
    SELECT *, least(r[1] % (n + 1), r[2] % (n + 1)) AS a, greatest(r[1] % (n + 1), r[2] % (n + 1)) AS b,
           CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR r[3] % 100 >= 50 THEN 'plain'
                WHEN r[4] % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM x),
p AS (SELECT doc_id, text, n, form, array_to_string(t[1:a], '') AS prefix, array_to_string(t[a + 1:b], '') AS middle,
             array_to_string(t[b + 1:], '') AS suffix FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM p
"""

# CRC-32 of an id's digits, byte by byte and bit by bit
_CRC = """xor(4294967295::UBIGINT, list_reduce(list_prepend(4294967295::UBIGINT, [ascii(x)::UBIGINT for x in string_split(CAST(conv_id AS VARCHAR), '')]),
    lambda a, b: list_reduce(list_prepend(xor(a, b), [0::UBIGINT, 0, 0, 0, 0, 0, 0, 0]),
        lambda v, z: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384::UBIGINT) ELSE v // 2 END)))"""

OP13 = rf"""
WITH t AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) AS words,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
                              md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) - 1 AS place
    FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, CAST({_CRC} % 4 AS BIGINT) AS h FROM (SELECT DISTINCT conv_id FROM t)),
r AS (SELECT c.conv_id, 0 AS part, t.place, t.role, t.text, t.words FROM c JOIN t ON t.conv_id = c.conv_id - c.conv_id % 20 AND t.place < c.h
      UNION ALL SELECT t.conv_id, 1, t.place, t.role, t.text, t.words FROM t JOIN c USING (conv_id) WHERE t.place >= c.h),
s AS (SELECT conv_id, list([role, text] ORDER BY part, place) AS turns, list(words ORDER BY part, place) AS words FROM r GROUP BY conv_id),
a AS (SELECT conv_id, coalesce(turns, []) AS turns, words FROM c LEFT JOIN s USING (conv_id)),
p AS (SELECT conv_id, depth, len(turns) = depth AS ends, CASE WHEN depth > 0 THEN words[depth] ELSE 0 END AS words,
             md5(CAST(to_json(turns[1:depth]) AS VARCHAR)) AS node,
             CASE WHEN depth > 0 THEN md5(CAST(to_json(turns[1:depth - 1]) AS VARCHAR)) END AS parent
      FROM a, unnest(generate_series(0, len(turns))) AS g(depth)),
n AS (SELECT depth, node, any_value(parent) AS parent, any_value(words) AS words, min(conv_id) AS conv_id, count(*) AS n_convs,
             sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
      FROM p GROUP BY depth, node),
k AS (SELECT depth - 1 AS depth, parent AS node, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY ALL),
u AS (SELECT p.depth, p.node, sum((n.n_convs - 1) * n.words) AS saved_tokens, count(*) FILTER (WHERE k.n_children IS NULL) AS n_leaves
      FROM n JOIN p ON p.conv_id = n.conv_id AND p.depth <= n.depth LEFT JOIN k ON k.depth = n.depth AND k.node = n.node GROUP BY ALL)
SELECT n.conv_id, n.depth, up.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n_children, 0) AS n_children, u.n_leaves,
       CAST(u.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM n JOIN u USING (depth, node) LEFT JOIN k USING (depth, node) LEFT JOIN n AS up ON up.depth = n.depth - 1 AND up.node = n.parent
"""

ORACLES: dict[str, str] = {
    "op3_license_scan": OP3,
    "op4_jaccard_join": OP4,
    "op5_chat_format": OP5,
    "op7_substring_dedup": OP7,
    "op8_url_filter": OP8,
    "op11_top_k": OP11,
    "op12_fill_in_middle": OP12,
    "op13_prefix_trie": OP13,
}

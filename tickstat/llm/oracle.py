"""DuckDB SQL of the operators that SQL can express.

The others rest on hashes, draws, vectors or merges that SQL has no form for
(XXH64, BLAKE2b, seeded permutations, BPE ranks, language models); their tests
compare them with brute-force versions, an exact round trip, a library, or
held-out accuracy.
"""

from __future__ import annotations

WORD_CLASS = r"[^\x20\x09-\x0D]+"

# fixed values: phrases and notices looked for, stated again
TEMPLATES = [
    ("gnu general public license", "gpl", True),
    ("apache license", "apache", True),
    ("cc by", "cc-by", True),
    ("mit license", "mit", True),
    ("this work is licensed under the gnu general public license version 3", "gpl-3.0", False),
    ("this program is free software you can redistribute it and or modify it under the terms of "
     "the gnu general public license as published by the free software foundation", "gpl-notice", False),
    ("licensed under the apache license version 2 0", "apache-2.0", False),
    ("licensed under cc by nc 4 0", "cc-by-nc-4.0", False),
    ("this work is licensed under a creative commons attribution 4 0 international license", "cc-by-4.0", False),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software "
     "and associated documentation files", "mit-notice", False),
    ("released under the mit license", "mit-reference", False),
    ("redistribution and use in source and binary forms with or without modification are permitted "
     "provided that the following conditions are met", "bsd-notice", False),
    ("all rights reserved", "all-rights-reserved", False),
]


def _template_rows() -> str:
    rows = []
    for n, (text, label, base) in enumerate(TEMPLATES):
        words = text.split()
        k = min(4, len(words))
        rows += [f"({n}, '{label}', {base}, {k}, {len(words) - k + 1}, {at}, '{' '.join(words[at:at + k])}')"
                 for at in range(len(words) - k + 1)]
    return ", ".join(rows)


LICENSES = rf"""
WITH grams(template, label, base, k, grams, spot, gram) AS (VALUES {_template_rows()}),
docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
),
placed AS (SELECT r, unnest(w) AS word, unnest(range(len(w))) AS pos FROM docs),
rolled AS (
  SELECT r, pos, word AS a, lead(word, 1) OVER o AS b, lead(word, 2) OVER o AS c, lead(word, 3) OVER o AS d
  FROM placed WINDOW o AS (PARTITION BY r ORDER BY pos)
),
sized AS (
  SELECT r, pos, a || ' ' || b AS gram FROM rolled
  UNION ALL SELECT r, pos, a || ' ' || b || ' ' || c FROM rolled
  UNION ALL SELECT r, pos, a || ' ' || b || ' ' || c || ' ' || d FROM rolled
),
hits AS (SELECT *, pos - spot AS diagonal FROM sized JOIN grams USING (gram)),
lines AS (
  SELECT r, template, label, base, k, grams, diagonal, list(spot) AS ats, min(pos) AS start
  FROM hits GROUP BY ALL
),
clusters AS (
  SELECT *, sum(fresh) OVER (PARTITION BY r, template ORDER BY diagonal) AS cluster
  FROM (SELECT *, CASE WHEN NOT base AND diagonal - lag(diagonal) OVER (PARTITION BY r, template ORDER BY diagonal) <= 3
               THEN 0 ELSE 1 END AS fresh FROM lines)
),
spans AS (
  SELECT r, label, base, min(start) AS start, len(list_distinct(flatten(list(ats)))) / any_value(grams) AS share
  FROM clusters GROUP BY r, template, label, base, cluster
),
found AS (
  SELECT r, count_if(base AND share = 1) AS n_base, min(start) FILTER (base AND share = 1) AS first_word,
    max(start) FILTER (base AND share = 1) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base AND share = 1) AS base_labels,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (CASE WHEN base THEN share = 1 ELSE share >= 0.8 END) AS labels,
    max(share) AS score
  FROM spans GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base,
  CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0) AS score
FROM docs LEFT JOIN found USING (r)"""

SECRETS = r"""
WITH patterns(kind, name, pattern, value, least) AS (VALUES
  (0, 'assign', '(?i)(password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2, 8),
  (1, 'access', 'AKIA[A-Z0-9]+', 0, 16), (2, 'hex', '[0-9a-f]+', 0, 32)),
docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(source, '') AS owner,
  coalesce(CAST(doc_id AS VARCHAR), '') AS repository, coalesce(text, '') AS text FROM documents),
matches AS (
  SELECT r, owner, repository, kind, name, least,
    unnest(regexp_extract_all(text, pattern)) AS m,
    unnest(CASE WHEN value = 2 THEN regexp_extract_all(text, pattern, 2) ELSE regexp_extract_all(text, pattern) END) AS v,
    unnest(string_split_regex(text, pattern)[:len(regexp_extract_all(text, pattern))]) AS gap,
    unnest(range(len(regexp_extract_all(text, pattern)))) AS i
  FROM docs, patterns
),
spans AS (
  SELECT * EXCLUDE (m, gap, i), stop - length(m) AS start
  FROM (SELECT *, sum(length(gap) + length(m)) OVER (PARTITION BY r, kind ORDER BY i) AS stop FROM matches)
  WHERE length(v) >= least
),
owned AS (
  SELECT v, count(DISTINCT owner) AS owners, count(DISTINCT owner) >= 3 OR count(DISTINCT repository) >= 10 AS copied
  FROM spans GROUP BY v
),
every AS (
  SELECT r, start, kind, name, stop, copied FROM spans JOIN owned USING (v)
  UNION ALL
  SELECT r, stop - length(v), 3, 'live', stop, FALSE FROM spans JOIN owned USING (v)
  WHERE NOT copied AND owners = 1 AND length(v) >= 16 AND regexp_matches(v, '[0-9]') AND regexp_matches(v, '[A-Za-z]')
    AND len(list_distinct(string_split(v, ''))) >= 8
),
listed AS (
  SELECT r, string_agg(format('{}:{}:{}', name, start, stop), ',' ORDER BY start, kind, stop) AS spans,
    string_agg(format('{}:{}:{}', name, start, stop), ',' ORDER BY start, kind, stop) FILTER (kind < 3) AS base,
    count_if(kind = 0) AS a, count_if(kind = 1) AS b, count_if(kind = 2) AS c, count_if(kind = 3) AS d,
    count_if(copied) AS e
  FROM every GROUP BY r
)
SELECT doc_id, CAST(coalesce(a, 0) AS BIGINT) AS n_assign, CAST(coalesce(b, 0) AS BIGINT) AS n_access,
  CAST(coalesce(c, 0) AS BIGINT) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
  CAST(coalesce(d, 0) AS BIGINT) AS n_live, CAST(coalesce(e, 0) AS BIGINT) AS n_example
FROM docs LEFT JOIN listed USING (r)"""

LINE_DEDUP = rf"""
WITH raw AS (
  SELECT doc_id, i, line, trim(line, chr(32) || chr(9) || chr(11) || chr(12) || chr(13)) AS stripped
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
          unnest(range(len(string_split(text, chr(10))))) AS i FROM documents)
),
lines AS (
  SELECT doc_id, i, stripped, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS n,
    len(regexp_extract_all(stripped, '{WORD_CLASS}')) AS words
  FROM raw WHERE stripped <> ''
),
sums AS (SELECT *, sum(words) OVER (PARTITION BY doc_id ORDER BY n) AS upto FROM lines),
-- the shortest stretch of at least 20 words from each line on
-- and up to each line
long AS (
  SELECT s.doc_id, s.n AS n, e.n AS last FROM sums s JOIN sums e
    ON e.doc_id = s.doc_id AND e.n >= s.n AND e.upto - s.upto + s.words >= 20
),
ends AS (
  SELECT doc_id, n, min(last) AS last FROM long GROUP BY doc_id, n
  UNION
  SELECT doc_id, max(n), last FROM long GROUP BY doc_id, last
),
runs AS (
  SELECT d.doc_id, d.n, d.last, string_agg(l.stripped, chr(10) ORDER BY l.n) AS run
  FROM ends d JOIN lines l ON l.doc_id = d.doc_id AND l.n BETWEEN d.n AND d.last
  GROUP BY ALL
),
first AS (SELECT run, min(doc_id) AS first_id FROM runs GROUP BY run),
shared AS (SELECT * FROM runs JOIN first USING (run) WHERE first_id < doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(n, last + 1)) AS n FROM shared),
kept AS (
  SELECT r.doc_id, string_agg(r.line, chr(10) ORDER BY r.i) FILTER (g.n IS NULL) AS text,
    count(l.n) AS n_lines, count(g.n) AS n_removed
  FROM raw r LEFT JOIN lines l ON l.doc_id = r.doc_id AND l.i = r.i
  LEFT JOIN gone g ON g.doc_id = l.doc_id AND g.n = l.n
  GROUP BY r.doc_id
),
partners AS (
  SELECT doc_id, array_to_string(list_sort(list_distinct(list(first_id))), ',') AS partners FROM shared GROUP BY doc_id
)
SELECT d.doc_id, CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  p.partners, CASE WHEN d.text IS NOT NULL THEN coalesce(k.text, '') END AS text
FROM documents d LEFT JOIN kept k USING (doc_id) LEFT JOIN partners p USING (doc_id)"""


UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _digest_of(text: str) -> str:
    fields = " || ".join(f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"
                         for c in ("doc_id", "source", "lang", "n_chars", text))
    return f"sha256({fields})"


# CRC-32 of the digits, bit by bit
_CRC = """xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
  lambda x: CAST(ascii(x) AS BIGINT))), lambda c, d: list_reduce(list_prepend(xor(c, d), [0, 0, 0, 0, 0, 0, 0, 0]),
  lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)"""

# nodes level by level, in the groups (k = 0) and over them (k = 1); a
# document's path are the others of its runs; folded level by level
MANIFEST = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, coalesce('=' || lang, '') AS g, {_digest_of('text')} AS leaf,
    CASE WHEN {_CRC} % 3 = 0 THEN {_digest_of(f"translate(text, '{UPPER}', '{UPPER.lower()}')")} END AS changed
  FROM documents
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id) - 1 AS pos, count(*) OVER (PARTITION BY g) AS n FROM leaves
),
inside(g, level, pos, n, node) AS (
  SELECT g, 0, pos, n, leaf FROM placed
  UNION ALL
  SELECT g, level + 1, pos // 8, (n + 7) // 8, sha256(string_agg(node, '' ORDER BY pos))
  FROM inside WHERE n > 1 GROUP BY g, level, pos // 8, n
),
groups AS (
  SELECT g, node AS subroot, level AS height, row_number() OVER (ORDER BY g) - 1 AS pos, count(*) OVER () AS n
  FROM inside WHERE n = 1
),
over_(level, pos, n, node) AS (
  SELECT 0, pos, n, subroot FROM groups
  UNION ALL
  SELECT level + 1, pos // 8, (n + 7) // 8, sha256(string_agg(node, '' ORDER BY pos))
  FROM over_ WHERE n > 1 GROUP BY level, pos // 8, n
),
nodes AS (
  SELECT g, level, pos, node FROM inside WHERE n > 1
  UNION ALL
  SELECT g.g, g.height + o.level, o.pos, o.node FROM groups g, over_ o WHERE o.n > 1
),
steps AS (
  SELECT p.doc_id, p.g, level, CASE WHEN level < g.height THEN p.pos >> (3 * level)
    ELSE g.pos >> (3 * (level - g.height)) END AS own
  FROM placed p JOIN groups g USING (g), (SELECT unnest(range(21)) AS level)
),
path AS (
  SELECT s.doc_id, s.level, coalesce(string_agg(n.node, '' ORDER BY n.pos) FILTER (n.pos < s.own), '') AS before,
    coalesce(string_agg(n.node, '' ORDER BY n.pos) FILTER (n.pos > s.own), '') AS after
  FROM steps s JOIN nodes n ON n.g = s.g AND n.level = s.level AND n.pos // 8 = s.own // 8
  GROUP BY s.doc_id, s.level
),
proofs AS (SELECT doc_id, sha256(string_agg(before || after, '' ORDER BY level)) AS proof FROM path GROUP BY doc_id),
folded(doc_id, level, node) AS (
  SELECT doc_id, 0, coalesce(changed, leaf) FROM placed
  UNION ALL
  SELECT f.doc_id, f.level + 1, sha256(p.before || f.node || p.after)
  FROM folded f JOIN path p ON p.doc_id = f.doc_id AND p.level = f.level
),
ends AS (SELECT doc_id, arg_max(node, level) AS node FROM folded GROUP BY doc_id)
SELECT p.doc_id, p.leaf, g.subroot, r.node AS root, coalesce(proof, sha256('')) AS proof_sha256,
  e.node AS folded_root, e.node = r.node AS verified
FROM placed p JOIN groups g USING (g) JOIN ends e USING (doc_id) LEFT JOIN proofs USING (doc_id),
  (SELECT node FROM over_ WHERE n = 1) AS r"""

JACCARD = rf"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '{WORD_CLASS}') AS w
  FROM documents
),
sets AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS shingle
  FROM docs
),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared
  FROM sets a JOIN sets b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id
),
links AS (
  SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * shared >= 80 * (x.n + y.n - shared)
),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM docs
  UNION
  SELECT r.doc_id, e.b FROM reach r JOIN edges e ON e.a = r.other
)
SELECT doc_id, CAST(coalesce(any_value(n), 0) AS BIGINT) AS n_shingles, min(other) AS component_id
FROM reach LEFT JOIN sizes USING (doc_id) GROUP BY doc_id"""


def oracle_sql() -> dict[str, str]:
    return {"op1_license_scan": LICENSES, "op4_secret_scan": SECRETS, "op5_line_dedup": LINE_DEDUP,
            "op11_manifest": MANIFEST, "op13_jaccard_join": JACCARD}

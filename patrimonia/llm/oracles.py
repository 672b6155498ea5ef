"""DuckDB SQL for the queries that SQL can express over whole tables."""

from __future__ import annotations

#: Words of letters, digits and non-ASCII characters, A-Z lower-cased; runs of five; shares of items' sets.
_OP1 = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents WHERE text IS NOT NULL),
b AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL),
bs AS (
  SELECT DISTINCT item_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT item_id, w, unnest(range(1, len(w) - 3)) AS i FROM b WHERE len(w) >= 5)),
n AS (SELECT item_id, count(*) AS n_item_shingles FROM bs GROUP BY item_id),
ds AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)),
hit AS (SELECT doc_id, item_id, count(*) AS n_shared FROM ds JOIN bs USING (s) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, n_item_shingles, n_shared, n_shared / n_item_shingles AS containment
FROM hit JOIN n USING (item_id) WHERE n_shared >= 0.8 * n_item_shingles - 1e-9
"""

_OP5 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (
  SELECT q.vec_id AS query_id, v.vec_id,
         CAST(list_sum(list_transform(list_zip(q.v, v.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v AS q JOIN v ON q.vec_id % 100 = 0 AND v.vec_id <> q.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10
"""


#: Full shingle sets, all pairs that share a shingle, and the smallest document that links reach.
_OP4 = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT d.doc_id, count(s.s) AS n FROM d LEFT JOIN s USING (doc_id) GROUP BY d.doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (
  SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id, doc_id AS reached FROM d UNION SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.reached)
SELECT doc_id, n.n AS n_shingles, min(reached) AS component_id, min(reached) = doc_id AS kept FROM r JOIN n USING (doc_id) GROUP BY doc_id, n.n
"""


#: Distinct word sets of lines, pairs that share one of their rarest words, exact Jaccard, and lines with an earlier one alike.
_OP8 = r"""
WITH x AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL),
y AS (SELECT doc_id, unnest(range(1, len(ls) + 1)) AS i, ls FROM x),
o AS (
  SELECT doc_id, i - 1 AS line_no, list_sort(list_distinct(regexp_extract_all(translate(ls[i], 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'))) AS w FROM y),
p AS (SELECT DISTINCT doc_id, line_no, w, array_to_string(w, ' ') AS cid FROM o WHERE len(w) > 0),
k AS (SELECT cid, any_value(w) AS w, any_value(len(w)) AS n, min((doc_id, line_no)) AS first FROM p GROUP BY cid),
t AS (SELECT cid, n, unnest(w) AS word FROM k),
f AS (SELECT word, count(*) AS f FROM t GROUP BY word),
q AS (SELECT cid, n, word FROM t JOIN f USING (word) QUALIFY row_number() OVER (PARTITION BY cid ORDER BY f, word) <= n - (80 * n + 99) // 100 + 1),
c AS (SELECT DISTINCT a.cid AS a, b.cid AS b FROM q a JOIN q b ON a.word = b.word AND a.cid < b.cid AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)),
l AS (
  SELECT a, b, u.first AS fa, v.first AS fb FROM c JOIN k u ON u.cid = a JOIN k v ON v.cid = b
  WHERE 100 * len(list_intersect(u.w, v.w)) >= 80 * (u.n + v.n - len(list_intersect(u.w, v.w)))),
e AS (SELECT a AS cid, fb < fa AS earlier FROM l UNION ALL SELECT b, fa < fb FROM l),
m AS (SELECT cid, count(*) AS links, bool_or(earlier) AS later FROM e GROUP BY cid),
g AS (
  SELECT p.doc_id, p.line_no, coalesce(m.links, 0) AS links, coalesce(m.later, FALSE) OR (p.doc_id, p.line_no) <> k.first AS gone FROM p JOIN k USING (cid) LEFT JOIN m USING (cid))
SELECT d.doc_id, count(g.line_no) AS n_lines, CAST(coalesce(sum(links), 0) AS BIGINT) AS n_links, coalesce(string_agg(CAST(line_no AS VARCHAR), ',' ORDER BY line_no) FILTER (gone), '') AS removed
FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL) d LEFT JOIN g USING (doc_id) GROUP BY d.doc_id
"""

#: Terms with their counts, weights from document frequencies, scores of all pairs that share a term, the ten best.
_OP11 = r"""
WITH t AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
d AS (SELECT r, doc_id, w, CAST(len(w) AS BIGINT) AS n FROM t WHERE len(w) > 0),
c AS (SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(n) AS BIGINT) AS length FROM d),
p AS (SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, n, unnest(w) AS term FROM d) GROUP BY ALL),
f AS (SELECT term, CAST(floor(1000 * ln((2.0 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM p, c GROUP BY term, docs),
i AS (
  SELECT item_id, term, count(*) AS times
  FROM (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark)
  GROUP BY ALL),
s AS (
  SELECT item_id, r, doc_id, CAST(sum(times * f.w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // length)))) AS BIGINT) AS score
  FROM i JOIN f USING (term) JOIN p USING (term), c GROUP BY item_id, r, doc_id),
k AS (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST, r) AS rank FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM k WHERE rank <= 10
"""

#: Texts grouped as they are, without a hash.
_OP12 = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS text FROM documents),
g AS (SELECT text, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY text)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(text) AS text_sha256 FROM t JOIN g USING (text)
"""

#: Levels of the trees by recursion, the siblings of each row from all levels, and its leaf folded level by level; crc32 bit by bit.
_OP13 = r"""
WITH RECURSIVE c AS (
  SELECT *, xor(list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ord(x) AS BIGINT)),
    lambda s, x: list_reduce(range(8), lambda v, i: xor(v >> 1, (v & 1) * 3988292384), xor(s, x)), CAST(4294967295 AS BIGINT)), 4294967295) % 3 = 0 AS chosen
  FROM documents),
f AS (
  SELECT *, concat(coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'),
    coalesce(strlen(lang) || ':' || lang, '-'), coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-')) AS head,
    CASE WHEN chosen THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS claim FROM c),
l AS (SELECT doc_id, lang, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf, sha256(head || coalesce(strlen(claim) || ':' || claim, '-')) AS claimed FROM f),
p AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n, row_number() OVER () AS r FROM l),
t AS (
  SELECT coalesce('=' || lang, '') AS tree, 0 AS level, pos, n, leaf AS h FROM p
  UNION ALL
  SELECT tree, level + 1, pos // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY pos)) FROM t WHERE n > 1 GROUP BY tree, level, pos // 8, n),
g AS (SELECT tree, h AS subroot, level AS height, row_number() OVER (ORDER BY encode(tree)) - 1 AS pos, count(*) OVER () AS n FROM t WHERE n = 1),
u AS (
  SELECT 0 AS level, pos, n, subroot AS h FROM g
  UNION ALL
  SELECT level + 1, pos // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY pos)) FROM u WHERE n > 1 GROUP BY level, pos // 8, n),
w AS (
  SELECT p.r, t.level AS step, t.pos < p.pos // CAST(8 ** t.level AS BIGINT) AS before, t.pos, t.h
  FROM p JOIN t ON t.tree = coalesce('=' || p.lang, '') AND t.n > 1 AND t.pos // 8 = p.pos // CAST(8 ** (t.level + 1) AS BIGINT) AND t.pos <> p.pos // CAST(8 ** t.level AS BIGINT)
  UNION ALL
  SELECT p.r, g.height + u.level, u.pos < g.pos // CAST(8 ** u.level AS BIGINT), u.pos, u.h
  FROM p JOIN g ON g.tree = coalesce('=' || p.lang, '') JOIN u ON u.n > 1 AND u.pos // 8 = g.pos // CAST(8 ** (u.level + 1) AS BIGINT) AND u.pos <> g.pos // CAST(8 ** u.level AS BIGINT)),
s AS (
  SELECT r, step, coalesce(string_agg(h, '' ORDER BY pos) FILTER (before), '') AS left_of, coalesce(string_agg(h, '' ORDER BY pos) FILTER (NOT before), '') AS right_of
  FROM w GROUP BY r, step),
k AS (SELECT p.r, g.subroot, g.height + (SELECT max(level) FROM u) AS height FROM p JOIN g ON g.tree = coalesce('=' || p.lang, '')),
o AS (
  SELECT r, 0 AS step, claimed AS h FROM p
  UNION ALL
  SELECT o.r, o.step + 1, sha256(coalesce(s.left_of, '') || o.h || coalesce(s.right_of, '')) FROM o JOIN k USING (r) LEFT JOIN s ON s.r = o.r AND s.step = o.step WHERE o.step < k.height),
a AS (SELECT r, sha256(string_agg(left_of || right_of, '' ORDER BY step)) AS proof FROM s GROUP BY r)
SELECT p.doc_id, p.leaf, k.subroot, z.h AS root, coalesce(a.proof, sha256('')) AS proof_sha256, o.h AS folded_root, o.h = z.h AS verified
FROM p JOIN k USING (r) JOIN o ON o.r = p.r AND o.step = k.height LEFT JOIN a ON a.r = p.r, (SELECT h FROM u WHERE n = 1) AS z
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_decontaminate": _OP1, "op4_near_duplicates": _OP4, "op5_top_k": _OP5, "op8_line_duplicates": _OP8, "op11_ranked_search": _OP11, "op12_exact_duplicates": _OP12, "op13_merkle_manifest": _OP13}

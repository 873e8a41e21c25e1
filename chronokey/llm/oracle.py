"""DuckDB SQL of the operators that SQL can express."""

from __future__ import annotations

_EXACT = r"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS len,
                  sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS h FROM documents),
r AS (SELECT *, row_number() OVER (PARTITION BY h ORDER BY len DESC, doc_id NULLS LAST) AS k,
             first_value(doc_id) OVER (PARTITION BY h ORDER BY len DESC, doc_id NULLS LAST) AS keep_id,
             count(*) OVER (PARTITION BY h) AS n FROM d)
SELECT doc_id, keep_id, n AS group_size, k = 1 AS kept, h AS text_sha256 FROM r
"""

_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

_DECONTAMINATION = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
                  regexp_extract_all(translate(coalesce(text, ''), {_AZ}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (SELECT CAST(item_id AS VARCHAR) AS item_id,
             regexp_extract_all(translate(coalesce(text, ''), {_AZ}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(len(w), 10) AS k, w[p : p + least(len(w), 10) - 1] AS ws
        FROM (SELECT *, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS p FROM i WHERE len(w) > 0)),
lens AS (SELECT DISTINCT k FROM win),
pos AS (SELECT r, p, k, w[p : p + k - 1] AS ws FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM d, lens WHERE len(w) >= k)),
hit AS (SELECT pos.r, pos.p, pos.k, win.item_id FROM pos JOIN win ON pos.ws = win.ws),
words AS (SELECT r, count(DISTINCT q) AS n FROM (SELECT r, unnest(range(p, p + k)) AS q FROM hit) GROUP BY r),
items AS (SELECT r, count(*) AS n, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT r, item_id FROM hit) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(words.n, 0) AS n_hit, coalesce(items.n, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, words.n IS NOT NULL AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)
"""

# A field of a leaf. CRC-32 runs over the digits of the id with a table of the reflected polynomial.
_FIELD = lambda c: f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"
_LEAF = lambda text: "sha256(" + " || ".join(_FIELD(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"

_MANIFEST = f"""
WITH RECURSIVE crc_step(b, k, v) AS (
  SELECT range, 0, CAST(range AS BIGINT) FROM range(256)
  UNION ALL
  SELECT b, k + 1, CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END FROM crc_step WHERE k < 8
), tab AS (SELECT list(v ORDER BY b) AS t FROM crc_step WHERE k = 8),
crc(doc_id, s, v) AS (
  SELECT DISTINCT doc_id, CAST(doc_id AS VARCHAR), CAST(4294967295 AS BIGINT) FROM documents WHERE doc_id IS NOT NULL
  UNION ALL
  SELECT doc_id, s[2:], xor(v // 256, t[xor(v % 256, ascii(s)) % 256 + 1]) FROM crc, tab WHERE s <> ''
),
hit AS (SELECT doc_id FROM crc WHERE s = '' AND xor(v, 4294967295) % 2 = 0),
leaves AS (
  SELECT doc_id, source, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS g, {_LEAF("text")} AS leaf,
         CASE WHEN doc_id IN (FROM hit) THEN {_LEAF("replace(text, chr(10), '')")} END AS changed FROM documents
),
d AS (SELECT *, row_number() OVER () AS id, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS r FROM leaves),
low(g, l, r, h, m) AS (
  SELECT g, 0, r, leaf, count(*) OVER (PARTITION BY g) FROM d
  UNION ALL
  SELECT g, l + 1, r // 3, sha256(string_agg(h, '' ORDER BY r)), (m + 2) // 3 FROM low WHERE m > 1 GROUP BY g, l, r // 3, m
),
subroots AS (SELECT g, h, l AS top FROM low WHERE m = 1),
high(l, r, h, m) AS (
  SELECT 0, g, h, count(*) OVER () FROM subroots
  UNION ALL
  SELECT l + 1, r // 3, sha256(string_agg(h, '' ORDER BY r)), (m + 2) // 3 FROM high WHERE m > 1 GROUP BY l, r // 3, m
),
-- Nodes of both trees below their roots, with one count of levels for each source.
nodes AS (
  SELECT g, l, r, h FROM low WHERE m > 1
  UNION ALL
  SELECT s.g, s.top + n.l, n.r, n.h FROM high n, subroots s WHERE n.m > 1
),
-- The places of a document's own nodes, level by level.
way AS (
  SELECT d.id, d.g, low.l, low.r FROM d JOIN low ON low.g = d.g AND low.m > 1 AND low.r = d.r // CAST(pow(3, low.l) AS BIGINT)
  UNION ALL
  SELECT d.id, d.g, s.top + n.l, n.r FROM d JOIN subroots s USING (g) JOIN high n ON n.m > 1 AND n.r = d.g // CAST(pow(3, n.l) AS BIGINT)
),
steps AS (
  SELECT w.id, w.l, string_agg(n.h, '' ORDER BY n.r) FILTER (n.r < w.r) AS a, string_agg(n.h, '' ORDER BY n.r) FILTER (n.r > w.r) AS b
  FROM way w JOIN nodes n ON n.g = w.g AND n.l = w.l AND n.r // 3 = w.r // 3 GROUP BY w.id, w.l, w.r
),
fold(id, l, h) AS (
  SELECT id, 0, coalesce(changed, leaf) FROM d
  UNION ALL
  SELECT f.id, f.l + 1, sha256(coalesce(s.a, '') || f.h || coalesce(s.b, '')) FROM fold f JOIN steps s ON s.id = f.id AND s.l = f.l
),
proof AS (SELECT id, string_agg(coalesce(a, '') || coalesce(b, ''), '' ORDER BY l) AS p FROM steps GROUP BY id)
SELECT d.doc_id, d.leaf, s.h AS subroot, t.h AS root, sha256(coalesce(p.p, '')) AS proof_sha256, f.h AS folded_root, f.h = t.h AS verified
FROM d JOIN subroots s USING (g) JOIN (SELECT h FROM high WHERE m = 1) t ON true
     JOIN (SELECT id, arg_max(h, l) AS h FROM fold GROUP BY id) f USING (id) LEFT JOIN proof p USING (id)
"""

_TERMS = rf"regexp_extract_all(translate(coalesce(text, ''), {_AZ}), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

_SEARCH = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS w FROM documents),
c AS (SELECT r, doc_id, CAST(len(w) AS BIGINT) AS n FROM d WHERE len(w) > 0),
totals AS (SELECT count(*) AS nn, CAST(sum(n) AS BIGINT) AS ll FROM c),
q AS (SELECT i, item_id, t, count(*) AS k FROM (SELECT row_number() OVER () AS i, item_id, unnest({_TERMS}) AS t FROM benchmark) GROUP BY ALL),
p AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(w) AS t FROM d) WHERE t IN (SELECT t FROM q) GROUP BY ALL),
f AS (SELECT t, count(*) AS df FROM p GROUP BY t),
wt AS (SELECT t, CAST(floor(1000 * ln(CAST(2 * nn + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w FROM f, totals),
s AS (SELECT q.i, q.item_id, c.doc_id, c.r,
             CAST(sum(q.k * wt.w * ((1000000000 * p.tf) // (1000 * p.tf + 8 * (25 + (75 * c.n * nn) // ll)))) AS BIGINT) AS score
      FROM q JOIN wt USING (t) JOIN p USING (t) JOIN c USING (r), totals GROUP BY ALL),
k AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM k WHERE rank <= 10
"""

ORACLE_SQL = {"op11_decontamination": _DECONTAMINATION, "op12_merkle_manifest": _MANIFEST, "op13_ranked_search": _SEARCH,
              "op6_exact_dedup": _EXACT}

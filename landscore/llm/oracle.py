"""DuckDB SQL for the queries that SQL can express on whole tables."""

from __future__ import annotations

from .license_scan import CONTAINED, SHINGLE, TEMPLATES
from .mixing import EPOCHS, MOST_BUCKETS, SEED, SHARE

FOLD = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS = rf"list_filter(string_split_regex({FOLD}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"

OP1 = rf"""
WITH d AS (SELECT doc_id, coalesce({WORDS}, []) AS w FROM documents),
b AS (SELECT DISTINCT item_id, {WORDS} AS w FROM benchmark WHERE len({WORDS}) > 0),
win AS (SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(w[s : s + least(13, len(w)) - 1], ' ') AS p
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS s FROM b)),
sizes AS (SELECT DISTINCT n FROM win),
dw AS (SELECT doc_id, n, s, array_to_string(w[s : s + n - 1], ' ') AS p
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, sizes WHERE len(w) >= n)),
hit AS (SELECT doc_id, item_id, s, dw.n FROM dw JOIN win ON dw.p = win.p AND dw.n = win.n),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hit) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)
"""

_T = ", ".join(f"('{k}', '{v.replace(chr(39), chr(39) * 2)}')" for k, v in TEMPLATES.items())
_SH = f"list_transform(range(1, greatest(len(w) - {SHINGLE - 1}, 1) + 1), lambda s: array_to_string(w[s : s + {SHINGLE - 1}], ' '))"
OP4 = rf"""
WITH t AS (SELECT template, list_distinct({_SH}) AS sh, CAST(pow(2, ceil(log2(len({_SH})))) AS BIGINT) AS c
  FROM (SELECT template, {WORDS} AS w FROM (VALUES {_T}) v(template, text))),
ts AS (SELECT template, c, len(sh) AS m, unnest(sh) AS h FROM t),
d AS (SELECT doc_id, {WORDS} AS w FROM documents WHERE len({WORDS}) > 0),
ds AS (SELECT doc_id, unnest({_SH}) AS h, unnest(range(0, greatest(len(w) - {SHINGLE - 1}, 1))) AS p FROM d),
hit AS (SELECT doc_id, template, m, h, p // c AS i FROM ds JOIN ts USING (h)),
per AS (SELECT doc_id, template, m, i, count(DISTINCT h) AS n
  FROM (SELECT * FROM hit UNION ALL SELECT doc_id, template, m, h, i - 1 FROM hit WHERE i > 0) GROUP BY ALL),
found AS (SELECT doc_id, string_agg(template, ',' ORDER BY template) AS templates, count(*) AS n
  FROM (SELECT DISTINCT doc_id, template FROM per WHERE n >= {CONTAINED} * m) GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_templates, coalesce(templates, '') AS templates
FROM documents LEFT JOIN found USING (doc_id)
"""

OP5 = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score FROM s
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= 20
"""

OP6 = r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, unnest(range(1, len(ls) + 1)) AS i FROM d),
k AS (SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key, min(doc_id) AS first FROM k WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) > 1),
r AS (SELECT k.*, first IS NOT NULL AND doc_id > first AS gone FROM k LEFT JOIN f USING (key))
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (gone) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM r GROUP BY doc_id
"""

OP8 = rf"""
WITH d AS (SELECT doc_id, source, CAST(len(list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS BIGINT) AS size,
  md5('{SEED}' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS key FROM documents),
t AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, CAST([3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS DOUBLE) AS w FROM t),
m AS (SELECT *, CAST({EPOCHS} * source_size AS DOUBLE) AS most, {EPOCHS} * source_size / w AS lim FROM w),
p AS (SELECT *, row_number() OVER o AS place, coalesce(sum(most) OVER b, 0) AS full_, coalesce(sum(w) OVER b, 0) AS spent,
  {SHARE} * sum(source_size) OVER () AS total, sum(w) OVER () AS all_w FROM m
  WINDOW o AS (ORDER BY lim, source NULLS LAST), b AS (ORDER BY lim, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
v AS (SELECT *, (total - full_) / (all_w - spent) AS level FROM p),
r AS (SELECT min(place) AS place, arg_min(level, place) AS level FROM v WHERE level <= lim),
g AS (SELECT v.source, v.source_size, CASE WHEN r.place IS NULL OR v.place < r.place THEN v.most ELSE r.level * v.w END AS target FROM v, r),
x AS (SELECT d.*, g.source_size, g.target, coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source),
y AS (SELECT *, least(floor(CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END), {EPOCHS}) AS whole FROM x)
SELECT doc_id, size, source_size, target, CAST(size * (whole +
  CASE WHEN whole < {EPOCHS} AND size > 0 AND before + size / 2.0 <= target - whole * source_size THEN 1 ELSE 0 END) AS BIGINT) AS taken FROM y
"""
assert MOST_BUCKETS <= 1 << 24


def oracle_sql() -> dict[str, str]:
    return {"op1_decontamination": OP1, "op4_license_scan": OP4, "op5_exact_top_k": OP5, "op6_line_dedup": OP6, "op8_mixing": OP8}

"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"'[^\x20\x09-\x0D]+'"

OP10 = rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(coalesce({_LOWER}, ''), {_WORDS}) AS ws FROM documents),
sh AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + 3], ' ') AS s
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 1) + 1)) AS i FROM w WHERE len(ws) > 0)
),
n AS (SELECT w.doc_id, count(s) AS n FROM w LEFT JOIN sh USING (doc_id) GROUP BY 1),
common AS (
  SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2
),
link AS (
  SELECT u, v FROM common JOIN n nu ON nu.doc_id = u JOIN n nv ON nv.doc_id = v WHERE 100 * c >= 85 * (nu.n + nv.n - c)
),
step AS (SELECT u, v FROM link UNION ALL SELECT v, u FROM link),
reach(doc_id, other) AS (
  SELECT u, v FROM step UNION SELECT r.doc_id, s.v FROM reach r JOIN step s ON s.u = r.other
)
SELECT n.doc_id, n.n AS n_shingles, least(n.doc_id, coalesce(min(other), n.doc_id)) AS component_id
FROM n LEFT JOIN reach r ON r.doc_id = n.doc_id GROUP BY n.doc_id, n.n
"""

ORACLE: dict[str, str] = {"op10_jaccard_join": OP10}

# Draws and targets as in mixing.py: sources by code point, null last; the level is found by resharing until none is above
# its limit, here as the largest prefix of sources in ascending order of limit per weight that stops.
OP3 = rf"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), {_WORDS}))::BIGINT AS size,
    ('0x' || md5(concat_ws('|', 'mix-1', coalesce(doc_id::VARCHAR, '-'), coalesce(source, '-'), coalesce(text, '-')))[1:8])::BIGINT
      / 4294967296.0::DOUBLE AS drawn
  FROM documents
),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    [5.0, 2.0, 1.0][1 + ((row_number() OVER (ORDER BY source NULLS LAST)) - 1) % 3]::DOUBLE AS weight
  FROM d GROUP BY source
),
r AS (
  SELECT *, 2.0::DOUBLE * source_size AS lim, 1.5::DOUBLE * sum(source_size) OVER () AS total,
    coalesce(sum(2.0::DOUBLE * source_size) OVER (ORDER BY 2.0::DOUBLE * source_size / weight, source NULLS LAST
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS held,
    sum(weight) OVER (ORDER BY 2.0::DOUBLE * source_size / weight, source NULLS LAST
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS free
  FROM s
),
c AS (SELECT *, lim * free <= weight * (total - held) AS stops FROM r),
l AS (
  SELECT coalesce(sum(CASE WHEN stops THEN lim END), 0) AS held, sum(CASE WHEN NOT stops THEN weight END) AS free FROM c
),
t AS (
  SELECT source, source_size,
    CASE WHEN stops THEN lim ELSE least(lim, weight * (total - l.held) / coalesce(l.free, 1.0)) END AS target FROM c, l
)
SELECT doc_id, size, source_size, target,
  (floor(rate) + CASE WHEN drawn < rate - floor(rate) THEN 1 ELSE 0 END)::BIGINT AS copies,
  ((floor(rate) + CASE WHEN drawn < rate - floor(rate) THEN 1 ELSE 0 END) * size)::BIGINT AS taken
FROM (
  SELECT d.*, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS rate
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
"""

OP6 = r"""
WITH p AS (
  SELECT page_id, coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages
),
r(rhost, rpath, verdict) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
),
m AS (
  SELECT p.*, r.*, row_number() OVER (PARTITION BY page_id, host, path ORDER BY length(rhost) + length(rpath) DESC) AS k
  FROM (SELECT DISTINCT * FROM p) p JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
)
SELECT p.page_id, p.host, p.path, m.rhost || m.rpath AS rule, coalesce(m.verdict, 'allow') AS verdict
FROM p LEFT JOIN m ON m.k = 1 AND m.page_id = p.page_id AND m.host = p.host AND m.path = p.path
"""


def _op5() -> str:
    from ringlens.llm.license_scan import all_templates

    texts = [(name, text.replace("'", "''")) for name, of in all_templates().items() for text in of]
    rows = ", ".join(f"({i}, '{name}', '{text}')" for i, (name, text) in enumerate(texts))
    words = r"string_split(trim(regexp_replace(lower({}), '[^\p{{L}}\p{{N}}]+', ' ', 'g')), ' ')"
    pairs = "list_distinct(list_transform(range(1, len({0})), lambda i: {0}[i] || ' ' || {0}[i + 1]))"
    return rf"""
WITH tpl AS MATERIALIZED (
  SELECT tid, license, {pairs.format("ws")} AS own FROM (SELECT tid, license, {words.format("t")} AS ws FROM (VALUES {rows}) v(tid, license, t))
),
apart AS MATERIALIZED (
  SELECT a.tid, list_filter(a.own, lambda x: NOT list_contains(b.own, x)) AS tells FROM tpl a JOIN tpl b ON a.license <> b.license
  WHERE 2.0 * len(list_intersect(a.own, b.own)) / (len(a.own) + len(b.own)) >= 0.8
),
docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
u AS (
  SELECT doc_id, unnest(list_distinct(list_concat([text], regexp_split_to_array(text, '\n\s*\n'), string_split(text, chr(10))))) AS unit FROM docs
),
b AS (SELECT doc_id, {pairs.format("ws")} AS pairs FROM (SELECT doc_id, {words.format("unit")} AS ws FROM u) WHERE len(ws) > 1),
whole AS (SELECT doc_id, {words.format("text")} AS ws FROM docs),
bi AS MATERIALIZED (SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] AS bg FROM (SELECT doc_id, ws, unnest(range(1, len(ws))) AS i FROM whole)),
place AS MATERIALIZED (
  SELECT doc_id, tid, n, i FROM (
    SELECT doc_id, tid, n, i, count(*) OVER (PARTITION BY doc_id, tid) AS places
    FROM bi JOIN (SELECT tid, len(own) AS n, unnest(own) AS bg FROM tpl) USING (bg)
  ) WHERE places >= 0.6 * n
),
span AS (
  SELECT s.doc_id, s.tid, s.i AS first, e.i AS last FROM place s JOIN place e ON s.doc_id = e.doc_id AND s.tid = e.tid AND e.i BETWEEN s.i AND s.i + 1.5 * s.n
),
win AS (SELECT s.doc_id, s.tid, first, last, list(DISTINCT bg) AS pairs FROM span s JOIN bi ON bi.doc_id = s.doc_id AND bi.i BETWEEN first AND last GROUP BY 1, 2, 3, 4),
tried AS (
  SELECT doc_id, pairs, tid, license, own FROM b JOIN tpl ON len(pairs) <= 4 * len(own)
  UNION ALL
  SELECT doc_id, pairs, tid, license, own FROM win JOIN tpl USING (tid)
),
m AS (
  SELECT doc_id, license, max(dice) AS dice
  FROM (SELECT doc_id, tid, license, pairs, 2.0::DOUBLE * len(list_intersect(pairs, own)) / (len(pairs) + len(own)) AS dice FROM tried) t
  WHERE dice >= 0.8 AND NOT EXISTS (SELECT 1 FROM apart a WHERE a.tid = t.tid AND NOT list_has_any(a.tells, t.pairs)) GROUP BY 1, 2
),
g AS (
  SELECT doc_id, count(*) AS n, string_agg(license, ',' ORDER BY license) AS names, max(dice) AS top,
    min(license) FILTER (dice = best) AS first
  FROM (SELECT *, max(dice) OVER (PARTITION BY doc_id) AS best FROM m) GROUP BY 1
)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_licenses, coalesce(names, '') AS licenses, first AS best_license,
  coalesce(top, 0.0)::DOUBLE AS best_dice
FROM documents d LEFT JOIN g USING (doc_id)
"""


ORACLE.update({"op3_mixing": OP3, "op5_license_scan": _op5(), "op6_url_filter": OP6})

# Six unrolled rounds over (vector, part, component) rows; integer division towards minus infinity.
_PARTS11 = """
WITH kept AS (
  SELECT vec_id, label, embedding AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
x AS MATERIALIZED (
  SELECT vec_id, (i - 1) // (len(v) // 8) AS part, (i - 1) % (len(v) // 8) AS place, floor(4096 * v[i]::DOUBLE)::BIGINT AS x
  FROM (SELECT vec_id, v, unnest(range(1, len(v) + 1)) AS i FROM kept)
),
b0 AS MATERIALIZED (
  SELECT part, entry, place, x AS c FROM x JOIN (
    SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM (SELECT vec_id FROM kept ORDER BY vec_id LIMIT 16)
  ) USING (vec_id)
)
"""


def _round11(i: int) -> str:
    return f""",
d{i} AS (SELECT vec_id, part, entry, sum((x - c) * (x - c))::BIGINT AS d FROM x JOIN b{i} USING (part, place) GROUP BY ALL),
a{i} AS MATERIALIZED (
  SELECT vec_id, part, min(entry) AS entry, min(d) AS d FROM (SELECT *, min(d) OVER (PARTITION BY vec_id, part) AS least FROM d{i}) WHERE d = least GROUP BY ALL
),
m{i} AS (SELECT part, entry, place, sum(x)::BIGINT AS s, count(*) AS n FROM x JOIN a{i} USING (vec_id, part) GROUP BY ALL),
b{i + 1} AS MATERIALIZED (
  SELECT part, entry, place, coalesce((s - ((s % n) + n) % n) // n, c) AS c FROM b{i} LEFT JOIN m{i} USING (part, entry, place)
)"""


ORACLE["op11_vector_codes"] = _PARTS11 + "".join(_round11(i) for i in range(7)) + """,
coded AS (
  SELECT vec_id, label, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(d)::BIGINT AS error
  FROM a6 JOIN kept USING (vec_id) GROUP BY ALL
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
  (SELECT sha256(string_agg(c::VARCHAR, ',' ORDER BY part, entry, place)) FROM b6) AS codebooks_sha256
FROM coded
"""

ORACLE["op12_hard_negatives"] = """
WITH r AS MATERIALIZED (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
s AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_dot_product(a.v, b.v)::BIGINT AS score
  FROM r a JOIN r b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, (row_number() OVER w)::INTEGER AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= 3
"""

# Windows by prefix sums: cells of half the room for new turns, runs of 4096 turns, history of at most 128 words.
_LEN13 = r"(length({0}) + len(regexp_extract_all({0}, '<\\*(?:turn>|text>|/turn>)')))"
ORACLE["op13_chat_format"] = rf"""
WITH given AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
),
t AS (
  SELECT *, len(regexp_extract_all(text, {_WORDS})) + 2 AS size, (row_number() OVER (ORDER BY conv_id, turn) - 1) // 4096 AS run,
    {_LEN13.format("coalesce(role, '')")} + {_LEN13.format("text")} + 20 AS chars, turn = min(turn) OVER (PARTITION BY conv_id) AND role = 'system' AS sys
  FROM given
),
c AS (
  SELECT conv_id, (1024 - 128 - least(coalesce(max(size) FILTER (sys), 0), 256)) // 2 AS cell, coalesce(max(chars) FILTER (sys), 0) AS sys_chars
  FROM t GROUP BY 1
),
placed AS (
  SELECT t.*, cell, sys_chars, coalesce(sum(size) OVER (PARTITION BY t.conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS begun,
    coalesce(sum(size) OVER (PARTITION BY t.conv_id, run ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS inside
  FROM t JOIN c USING (conv_id)
),
keyed AS (SELECT *, run * 1000000000 + 2 * (inside // cell) + (size > cell)::INT AS key FROM placed),
win AS (SELECT conv_id, key, min(begun) AS begun, sum(chars) AS chars, bool_or(sys) AS has_sys, max(sys_chars) AS sys_chars FROM keyed GROUP BY 1, 2),
past AS (
  SELECT win.conv_id, win.key, sum(k.chars) AS chars FROM win JOIN keyed k
    ON k.conv_id = win.conv_id AND k.key < win.key AND win.begun - k.begun <= 128 AND NOT k.sys AND k.size <= k.cell GROUP BY 1, 2
),
formatted AS (
  SELECT conv_id, sum(win.chars + coalesce(past.chars, 0) + CASE WHEN has_sys THEN 0 ELSE sys_chars END)::BIGINT AS formatted_chars
  FROM win LEFT JOIN past USING (conv_id, key) GROUP BY 1
)
SELECT g.conv_id, count(*)::BIGINT AS n_turns, sha256(string_agg(coalesce(role, '') || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256, any_value(formatted_chars) AS formatted_chars
FROM given g JOIN formatted USING (conv_id) GROUP BY 1
"""

"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from reelmeter.llm.line_dedup import MIN_SITES
from reelmeter.llm.quality import HostRules

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _quality() -> str:
    rules = HostRules().rules
    sums = ", ".join(f"sum(CASE WHEN {rule} THEN 1 ELSE 0 END) AS k_{name}" for name, rule, _ in rules)
    moments = ", ".join(
        f"sum(k_{x}) / sum(n) AS p_{x}, avg((k_{x} / n) ** 2) AS s_{x}, avg(k_{x} / n) AS r_{x}" for x, _, _ in rules
    )
    strengths = ", ".join(
        f"greatest(2.0, least(1e4, p_{x} * (1 - p_{x}) / greatest("
        f"s_{x} - 2 * p_{x} * r_{x} + p_{x} ** 2 - p_{x} * (1 - p_{x}) * inverse, 1e-6) - 1)) AS t_{x}"
        for x, _, _ in rules
    )
    bad = " OR ".join(f"(k_{x} + p_{x} * t_{x}) / (n + t_{x}) > {limit}" for x, _, limit in rules)
    return rf"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t, {_WORDS} AS w FROM documents),
windows AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, array_to_string(w[i:i+4], ' ')) AS times
  FROM d, unnest(range(1, len(w) - 3)) AS u(i)),
repeats AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM windows, unnest(range(0, 5)) AS u(k) WHERE times > 1 GROUP BY doc_id),
lines AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
m AS (
  SELECT doc_id, source, len(w) AS n_words,
    length(array_to_string(w, '')) AS word_chars,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    coalesce(lines.n, 0) AS n_dup_lines, coalesce(repeats.n, 0) AS n_repeat_words
  FROM d LEFT JOIN repeats USING (doc_id) LEFT JOIN lines USING (doc_id)),
hosts AS (SELECT source AS host, count(*) AS n, {sums} FROM m WHERE source IS NOT NULL GROUP BY source),
moments AS (SELECT {moments}, avg(1 / n) AS inverse FROM hosts),
prior AS (SELECT *, {strengths} FROM moments),
verdicts AS (SELECT host, {bad} AS rejected FROM hosts, prior),
joined AS (
  SELECT m.*, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed, coalesce(rejected, false) AS host_rejected
  FROM m LEFT JOIN verdicts ON source = host)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
  n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed, host_rejected,
  NOT base_failed AND NOT host_rejected AS kept
FROM joined"""


_JACCARD = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(
    CASE WHEN len(w) >= 3 THEN [array_to_string(w[i:i+2], ' ') FOR i IN range(1, len(w) - 1)]
         WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS shingle FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
  FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE 100 * common >= 90 * (x.n + y.n - common)),
either AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION
  SELECT reached.doc_id, either.b FROM reached JOIN either ON reached.other = either.a)
SELECT doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, component_id
FROM (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id) LEFT JOIN n USING (doc_id)"""


_DECONTAMINATION = rf"""
WITH lettered AS (
  SELECT item_id, regexp_extract_all({_LOWER}, '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS w FROM benchmark),
patterns AS (
  SELECT DISTINCT item_id::VARCHAR AS item, array_to_string(w[i:i+12], ' ') AS p, least(len(w), 13) AS size
  FROM lettered, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS u(i) WHERE len(w) > 0),
d AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS w FROM documents),
places AS (
  SELECT doc_id, i, size, array_to_string(w[i:i+size-1], ' ') AS p
  FROM d, (SELECT DISTINCT size FROM patterns), unnest(range(1, len(w) - size + 2)) AS u(i)),
found AS (SELECT doc_id, i, places.size, item FROM places JOIN patterns USING (p)),
hits AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM found, unnest(range(0, size)) AS u(k) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id),
joined AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(hits.n, 0)::BIGINT AS n_hit,
    coalesce(items.n, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256
  FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id))
SELECT *, n_hit > 0 AND 20 * n_hit >= n_words AS contaminated FROM joined"""


_CHAT = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
g AS (
  SELECT conv_id, count(*) AS n, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn) AS turns,
    coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '') AS loss,
    sum(length('<turn >' || chr(10) || '</turn>' || chr(10)) + length(role) + length(text)
      + length(text) - length(replace(text, '\', ''))
      + (length(text) - length(replace(text, '<turn', ''))) // 5
      + (length(text) - length(replace(text, '</turn>', ''))) // 7) AS size
  FROM c GROUP BY conv_id)
SELECT conv_id, n::BIGINT AS n_turns, sha256(turns) AS turns_sha256, length(loss)::BIGINT AS loss_chars,
  sha256(loss) AS loss_sha256, size::BIGINT AS formatted_chars FROM g"""


_LINES = rf"""
WITH l AS (
  SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line,
    generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents WHERE text IS NOT NULL),
b AS (
  SELECT line FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY line
  HAVING count(DISTINCT source) >= {MIN_SITES}),
o AS (
  SELECT l.*, b.line IS NOT NULL AND row_number() OVER (PARTITION BY l.line ORDER BY doc_id, pos) > 1 AS gone
  FROM l LEFT JOIN b ON l.line = b.line),
t AS (
  SELECT doc_id, count(*) FILTER (gone) AS n_removed,
    coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS text FROM o GROUP BY doc_id)
SELECT doc_id, coalesce(n_removed, 0)::BIGINT AS n_removed, length(t.text)::BIGINT AS n_chars_left,
  sha256(t.text) AS text_sha256 FROM documents LEFT JOIN t USING (doc_id)"""


_URLS = r"""
WITH rules(host, path, verdict) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'),
  ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
cut AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT row_number() OVER () AS n, page_id,
    translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
fits AS (
  SELECT n, arg_max(r.host || r.path, length(r.host || r.path)) AS rule, arg_max(verdict, length(r.host || r.path)) AS verdict
  FROM parts p JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path) GROUP BY n)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM parts LEFT JOIN fits USING (n)"""


def _clusters(k: int = 40, rounds: int = 5) -> str:
    """Vectors and centroids as a row for every component; the rounds are written out one after the other."""
    steps = ["""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) AS n, vec_id, list_transform(embedding, lambda c: floor(256 * c::DOUBLE)::BIGINT) AS x
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
v AS MATERIALIZED (SELECT n, unnest(range(64)) AS j, unnest(x) AS x FROM kept),
chosen AS (SELECT x, row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS k FROM kept),
c0 AS MATERIALIZED (SELECT k, unnest(range(64)) AS j, unnest(x) AS x FROM chosen WHERE k < %d)""" % k]
    for i in range(rounds + 1):
        steps.append(f"""
d{i} AS (SELECT n, k, sum((v.x - c.x) * (v.x - c.x))::BIGINT AS d FROM v JOIN c{i} c USING (j) GROUP BY n, k),
a{i} AS MATERIALIZED (SELECT n, arg_min(k, d * 1000 + k) AS k, min(d) AS d FROM d{i} GROUP BY n)""")
        if i < rounds:
            steps.append(f"""
m{i} AS (SELECT k, j, floor(sum(x)::DOUBLE / count(*))::BIGINT AS x FROM a{i} JOIN v USING (n) GROUP BY k, j),
c{i + 1} AS MATERIALIZED (SELECT c.k, c.j, coalesce(m.x, c.x) AS x FROM c{i} c LEFT JOIN m{i} m ON m.k = c.k AND m.j = c.j)""")
    return ",".join(steps) + f"""
, h AS (SELECT k, sha256(string_agg(x::VARCHAR, ',' ORDER BY j)) AS h FROM c{rounds} GROUP BY k)
SELECT vec_id, k::INT AS cluster, d AS distance, sum(d) OVER (PARTITION BY k)::BIGINT AS cluster_inertia,
  sum(d) OVER ()::BIGINT AS inertia, h AS centroid_sha256 FROM a{rounds} JOIN kept USING (n) JOIN h USING (k)"""


ORACLES = {
    "op1_quality": _quality(),
    "op2_jaccard": _JACCARD,
    "op3_decontamination": _DECONTAMINATION,
    "op6_chat": _CHAT,
    "op7_line_dedup": _LINES,
    "op11_url_rules": _URLS,
    "op12_centroids": _clusters(),
}

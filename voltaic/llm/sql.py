"""DuckDB SQL of the registered queries that SQL can express, over the same tables."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(column: str, pattern: str) -> str:
    return f"coalesce(regexp_extract_all(translate({column}, '{_UPPER}', '{_LOWER}'), '{pattern}'), [])"


_TERM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_VISIBLE = r"[^\x20\x09-\x0D]+"

OP2 = f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {_words('text', _TERM)} AS w FROM documents),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, {_words('text', _TERM)} AS w FROM benchmark),
win AS MATERIALIZED (
  SELECT DISTINCT item, least(10, len(w)) AS size, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS g
  FROM b, unnest(range(1, len(w) - least(10, len(w)) + 2)) t(i) WHERE len(w) > 0),
occ AS MATERIALIZED (
  SELECT r, i, size, item
  FROM (SELECT r, i, s.size, array_to_string(w[i:i + s.size - 1], ' ') AS g
        FROM d, (SELECT DISTINCT size FROM win) s, unnest(range(1, len(w) - s.size + 2)) t(i)) JOIN win USING (size, g)),
hit AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + size)) AS p FROM occ) GROUP BY r),
own AS (SELECT r, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS digest
        FROM (SELECT DISTINCT r, item FROM occ) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(digest, sha256('')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN own USING (r)"""

OP11 = f"""
WITH RECURSIVE d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {_words('text', _VISIBLE)} AS w FROM documents),
s AS MATERIALIZED (
  SELECT DISTINCT r, array_to_string(w[i:i + least(5, len(w)) - 1], ' ') AS g
  FROM d, unnest(range(1, len(w) - least(5, len(w)) + 2)) t(i) WHERE len(w) > 0),
n AS MATERIALIZED (SELECT r, count(*) AS n FROM s GROUP BY r),
l AS MATERIALIZED (
  SELECT x.r AS a, y.r AS b
  FROM s x JOIN s y ON x.g = y.g AND x.r <> y.r JOIN n nx ON nx.r = x.r JOIN n ny ON ny.r = y.r
  GROUP BY x.r, y.r, nx.n, ny.n HAVING 100 * count(*) >= 80 * (nx.n + ny.n - count(*))),
reach(a, b) AS (SELECT r, r FROM d UNION SELECT reach.a, l.b FROM reach JOIN l ON reach.b = l.a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, min(o.doc_id) AS component_id
FROM d LEFT JOIN n USING (r) JOIN reach ON reach.a = d.r JOIN d o ON o.r = reach.b GROUP BY d.r, d.doc_id, n.n"""

OP12 = f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {_words('text', _TERM)} AS w FROM documents),
q AS MATERIALIZED (
  SELECT item_id, term, count(*) AS times
  FROM (SELECT item_id, unnest({_words('text', _TERM)}) AS term FROM (SELECT DISTINCT item_id, text FROM benchmark)) GROUP BY ALL),
size AS (SELECT count(*) AS n, CAST(sum(len(w)) AS BIGINT) AS l FROM d WHERE len(w) > 0),
tf AS MATERIALIZED (
  SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM d)
  WHERE term IN (SELECT term FROM q) GROUP BY ALL),
weight AS (
  SELECT term, CAST(floor(1000 * ln((2 * n + 2) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM tf, size GROUP BY term, n),
score AS (
  SELECT q.item_id, d.doc_id, d.r,
         CAST(sum(q.times * weight.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 12 * (75 + (25 * len(d.w) * n) // l)))) AS BIGINT) AS score
  FROM q JOIN tf USING (term) JOIN weight USING (term) JOIN d USING (r), size GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score
FROM score WHERE score > 0
QUALIFY rank <= 20"""


def _op13(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """Rounds as one CTE after the other; components are whole numbers held as doubles."""
    steps = [f"""
kept AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(4096 * CAST(x AS DOUBLE))) AS v,
         row_number() OVER (ORDER BY vec_id) AS k
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS MATERIALIZED (
  SELECT k, part, v[part * (len(v) // {parts}) + 1:(part + 1) * (len(v) // {parts})] AS x
  FROM kept, unnest(range({parts})) t(part)),
e0 AS MATERIALIZED (SELECT part, k - 1 AS entry, x FROM p WHERE k <= {entries})"""]
    for i in range(rounds + 1):
        steps.append(f"""
a{i} AS MATERIALIZED (
  SELECT p.k, p.part, any_value(p.x) AS x,
         min(CAST(list_dot_product(p.x, p.x) - 2 * list_dot_product(p.x, e.x) + list_dot_product(e.x, e.x) AS BIGINT) * {entries} + e.entry) AS best
  FROM p JOIN e{i} e ON p.part = e.part GROUP BY p.k, p.part)""")
        if i < rounds:
            steps.append(f"""
m{i} AS (
  SELECT part, entry, list(floor(s / n) ORDER BY place) AS x
  FROM (SELECT part, best % {entries} AS entry, place, sum(x[place]) AS s, count(*) AS n
        FROM a{i}, unnest(range(1, len(x) + 1)) t(place) GROUP BY ALL) GROUP BY part, entry),
e{i + 1} AS MATERIALIZED (
  SELECT e.part, e.entry, coalesce(m.x, e.x) AS x FROM e{i} e LEFT JOIN m{i} m ON m.part = e.part AND m.entry = e.entry)""")
    return f"""WITH {','.join(steps)},
coded AS (
  SELECT k, string_agg(printf('%02x', CAST(best % {entries} AS INTEGER)), '' ORDER BY part) AS code, CAST(sum(best // {entries}) AS BIGINT) AS error
  FROM a{rounds} GROUP BY k),
book AS (SELECT sha256(string_agg(CAST(CAST(c AS BIGINT) AS VARCHAR), ',' ORDER BY part, entry, place)) AS codebooks_sha256
         FROM (SELECT part, entry, place, x[place] AS c FROM e{rounds}, unnest(range(1, len(x) + 1)) t(place)))
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM coded JOIN kept USING (k), book"""


ORACLE_SQL = {
    "op2_decontamination": OP2,
    "op11_ngram_jaccard": OP11,
    "op12_lexical_search": OP12,
    "op13_vector_codes": _op13(),
}

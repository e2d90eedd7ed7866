"""DuckDB SQL of the queries that SQL can express."""

_LETTERS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def _words(column: str) -> str:
    return rf"regexp_extract_all(translate(coalesce({column}, ''), {_LETTERS}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


OP9 = f"""
WITH d AS (SELECT doc_id, {_words('text')} AS w FROM documents),
b AS (SELECT item_id, {_words('text')} AS w FROM benchmark),
needle AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS phrase
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i FROM b WHERE len(w) > 0)
),
run AS (
    SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS phrase
    FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM needle) WHERE len(w) >= n)
),
hit AS (SELECT run.doc_id, run.i, run.n, needle.item_id FROM run JOIN needle ON run.phrase = needle.phrase AND run.n = needle.n),
word AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
item AS (
    SELECT doc_id, count(*) AS n_items, string_agg(label, ',' ORDER BY label) AS items
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS label FROM hit) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(word.n_hit, 0) AS n_hit, coalesce(item.n_items, 0) AS n_items,
       sha256(coalesce(item.items, '')) AS items_sha256, coalesce(word.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN word USING (doc_id) LEFT JOIN item USING (doc_id)
"""


def _squared(a: str, b: str) -> str:
    return f"CAST(list_sum(list_transform(list_zip({a}, {b}), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT)"


_FINITE = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"
_FLOOR_MEAN = "CAST((s - ((s % c) + c) % c) // c AS BIGINT)"


def _op12(rounds: int = 5) -> str:
    steps = [
        f"""k AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings WHERE {_FINITE} AND len(embedding) = 64)""",
        "c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h) - 1 AS n, v AS c FROM (SELECT v, sha256('2:' || vec_id) AS h FROM k ORDER BY h LIMIT 40))",
    ]
    for i in range(rounds + 1):
        steps.append(f"a{i} AS MATERIALIZED (SELECT r, min({{'d': d, 'n': n}}) AS m FROM (SELECT r, n, {_squared('v', 'c')} AS d FROM k, c{i}) GROUP BY r)")
        if i < rounds:
            steps.append(f"""c{i + 1} AS MATERIALIZED (SELECT o.n, coalesce(u.c, o.c) AS c FROM c{i} o LEFT JOIN (
    SELECT n, list({_FLOOR_MEAN} ORDER BY i) AS c FROM (
      SELECT n, i, sum(x) AS s, count(*) AS c FROM (SELECT m.n AS n, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM a{i} JOIN k USING (r)) GROUP BY n, i)
    GROUP BY n) u ON o.n = u.n)""")
    return "WITH " + ",\n".join(steps) + f"""
SELECT vec_id, CAST(m.n AS INTEGER) AS cluster, m.d AS distance, CAST(sum(m.d) OVER (PARTITION BY m.n) AS BIGINT) AS cluster_inertia,
  CAST(sum(m.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{rounds} JOIN k USING (r) JOIN c{rounds} ON m.n = c{rounds}.n"""


def _op13(rounds: int = 6) -> str:
    steps = [
        f"""k AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings WHERE {_FINITE})""",
        "p AS MATERIALIZED (SELECT r, q, v[q * len(v) // 8 + 1 : (q + 1) * len(v) // 8] AS x FROM k, (SELECT unnest(range(8)) AS q))",
        """c0 AS MATERIALIZED (SELECT q, n, x AS c FROM p JOIN (SELECT r, row_number() OVER (ORDER BY vec_id, r) - 1 AS n FROM k) USING (r) WHERE n < 16)""",
    ]
    for i in range(rounds + 1):
        steps.append(f"a{i} AS MATERIALIZED (SELECT r, q, min({{'d': d, 'n': n}}) AS m FROM (SELECT r, p.q, n, {_squared('x', 'c')} AS d FROM p JOIN c{i} ON p.q = c{i}.q) GROUP BY r, q)")
        if i < rounds:
            steps.append(f"""c{i + 1} AS MATERIALIZED (SELECT o.q, o.n, coalesce(u.c, o.c) AS c FROM c{i} o LEFT JOIN (
    SELECT q, n, list({_FLOOR_MEAN} ORDER BY i) AS c FROM (
      SELECT q, n, i, sum(y) AS s, count(*) AS c FROM (SELECT q, m.n AS n, unnest(x) AS y, generate_subscripts(x, 1) AS i FROM a{i} JOIN p USING (r, q)) GROUP BY q, n, i)
    GROUP BY q, n) u ON o.q = u.q AND o.n = u.n)""")
    return "WITH " + ",\n".join(steps) + f""",
coded AS (SELECT r, string_agg(printf('%02x', m.n), '' ORDER BY q) AS code, CAST(sum(m.d) AS BIGINT) AS error FROM a{rounds} GROUP BY r),
books AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY q, n)) AS digest FROM c{rounds})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, digest AS codebooks_sha256
FROM coded JOIN k USING (r), books"""


OP11 = """
WITH d AS MATERIALIZED (SELECT row_number() OVER (ORDER BY doc_id NULLS LAST, file_row_number) AS r, doc_id, encode(coalesce(text, '')) AS b FROM documents),
w AS MATERIALIZED (SELECT r, p, b[p + 1 : p + 100] AS s FROM (SELECT r, b, unnest(range(0, greatest(octet_length(b) - 99, 0))) AS p FROM d)),
hit AS (SELECT r, p FROM (SELECT r, p, row_number() OVER (PARTITION BY s ORDER BY r, p) AS n FROM w) WHERE n > 1),
mark AS (SELECT r, p, sum(CASE WHEN p <= before + 100 THEN 0 ELSE 1 END) OVER (PARTITION BY r ORDER BY p) AS g
    FROM (SELECT r, p, lag(p) OVER (PARTITION BY r ORDER BY p) AS before FROM hit)),
span AS (SELECT r, min(p) AS a, max(p) + 100 AS z FROM mark GROUP BY r, g),
gap AS (SELECT r, a AS stop, coalesce(lag(z) OVER (PARTITION BY r ORDER BY a), 0) AS start FROM span
    UNION ALL SELECT r, NULL, max(z) FROM span GROUP BY r),
kept AS (SELECT r, string_agg(hex(b[start + 1 : coalesce(stop, octet_length(b))]), '' ORDER BY start) AS h FROM gap JOIN d USING (r) GROUP BY r),
gone AS (SELECT r, CAST(sum(z - a) AS BIGINT) AS n_removed, count(*) AS n_spans FROM span GROUP BY r)
SELECT doc_id, CAST(octet_length(b) AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(coalesce(unhex(h), b)) AS kept_sha256
FROM d LEFT JOIN kept USING (r) LEFT JOIN gone USING (r)
"""

ORACLES = {"op9_contamination": OP9, "op11_previous_factors": OP11.replace(", file_row_number", ""), "op12_orchard_clusters": _op12(), "op13_gnat_codes": _op13()}

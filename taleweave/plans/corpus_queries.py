"""Queries over `documents`: vocabularies, tokens, speeches, examples, n-grams."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from taleweave.functions import lexicon as X
from taleweave.operators import corpus as C
from taleweave.operators import evaluate as E
from taleweave.operators import ngram as N
from taleweave.operators import ordering
from taleweave.operators import relational as R
from taleweave.operators import speeches as S
from taleweave.operators import subword
from taleweave.plans.base import documents, query, sql_digest, sql_list, sql_uniform, table
from taleweave.plans.subword_sql import encoded_sql, learned_sql
from taleweave.session import working_dir
from taleweave.sources import readers, writers

SEED = 7

# --- vocabulary and tokens ---------------------------------------------------

SQL_CHARS = """
chars AS (SELECT DISTINCT unnest(string_split(text, '')) AS token FROM documents),
vocab AS (SELECT token, CAST(row_number() OVER (ORDER BY token) - 1 AS INTEGER) AS id FROM chars WHERE token <> '')
"""


@query("char_vocab", f"WITH {SQL_CHARS} SELECT token, id FROM vocab")
def char_vocab(spark, sf):
    return C.char_vocab(documents(spark, sf))


@query("corpus_stats", """
SELECT count(*) AS documents, CAST(sum(length(text)) AS BIGINT) AS characters,
       (SELECT count(DISTINCT c) FROM (SELECT unnest(string_split(text, '')) AS c FROM documents) WHERE c <> '') AS vocabulary
FROM documents""")
def corpus_stats(spark, sf):
    return C.corpus_stats(documents(spark, sf))


@query("extend_vocab", """
WITH base AS (
  SELECT token, row_number() OVER (ORDER BY token) - 1 AS id FROM (
    SELECT DISTINCT unnest(string_split(text, '')) AS token FROM documents WHERE lang = 'en') WHERE token <> ''),
fresh AS (
  SELECT token FROM (SELECT DISTINCT unnest(string_split(text, '')) AS token FROM documents) WHERE token <> ''
  EXCEPT SELECT token FROM base)
SELECT token, CAST(id AS INTEGER) AS id FROM base
UNION ALL
SELECT token, CAST((SELECT count(*) FROM base) + row_number() OVER (ORDER BY token) - 1 AS INTEGER) FROM fresh""")
def extend_vocab(spark, sf):
    docs = documents(spark, sf)
    base = C.char_vocab(docs.where("lang = 'en'"))
    return C.extend_vocab(base, C.char_set(docs))


@query("new_tokens", """
SELECT token FROM (SELECT DISTINCT unnest(string_split(text, '')) AS token FROM documents) WHERE token <> ''
EXCEPT
SELECT token FROM (SELECT DISTINCT unnest(string_split(text, '')) AS token FROM documents WHERE lang = 'en')""")
def new_tokens(spark, sf):
    docs = documents(spark, sf)
    return C.new_tokens(C.char_set(docs), C.char_set(docs.where("lang = 'en'")))


SQL_SPLIT = """
placed AS (
  SELECT doc_id, text, length(text) AS n,
         sum(length(text)) OVER (ORDER BY doc_id) - length(text) AS pos,
         CAST(floor(sum(length(text)) OVER () * 0.9::DOUBLE) AS BIGINT) AS cut
  FROM documents),
parts AS (
  SELECT doc_id, 'train' AS split, 0 AS start, substr(text, 1, CAST(least(n, cut - pos) AS BIGINT)) AS part FROM placed WHERE pos < cut AND n > 0
  UNION ALL
  SELECT doc_id, 'val', greatest(0, cut - pos), substr(text, CAST(greatest(0, cut - pos) AS BIGINT) + 1) FROM placed WHERE pos + n > cut)
"""
SQL_IDS = """
ids AS (SELECT doc_id, split, start, list_transform(list_filter(string_split(part, ''), lambda c: c <> ''), lambda c: m[c]) AS ids
        FROM parts, (SELECT map(list(token), list(id)) AS m FROM vocab))
"""


@query("encode_split", f"""
WITH {SQL_CHARS}, {SQL_SPLIT}, {SQL_IDS}
SELECT doc_id, split, CAST(start AS BIGINT) AS start, CAST(len(ids) AS BIGINT) AS tokens,
       CAST(list_sum(ids) AS BIGINT) AS id_sum, CAST(ids[1] AS INTEGER) AS first_id, CAST(ids[-1] AS INTEGER) AS last_id
FROM ids""")
def encode_split(spark, sf):
    docs = documents(spark, sf)
    tokens = C.encode_split(docs, C.char_vocab(docs))
    total = F.aggregate("ids", F.lit(0).cast("long"), lambda a, x: a + x)
    return tokens.select(
        "doc_id", "split", "start", F.size("ids").cast("long").alias("tokens"), total.alias("id_sum"),
        F.get("ids", F.lit(0)).alias("first_id"), F.try_element_at("ids", F.lit(-1)).alias("last_id"))


SQL_PLACED = """
flat AS (SELECT split, doc_id, start, unnest(ids) AS id, unnest(range(0, len(ids))) AS n FROM ids),
tokens AS (SELECT split, id, row_number() OVER (PARTITION BY split ORDER BY doc_id, start, n) - 1 AS p FROM flat)
"""


@query("token_blocks", f"""
WITH {SQL_CHARS}, {SQL_SPLIT}, {SQL_IDS}, {SQL_PLACED},
x AS (SELECT split, p // 64 AS block, CAST(sum(id) AS BIGINT) AS x_sum, CAST(sum(id * (p % 64 + 1)) AS BIGINT) AS x_order, count(*) AS n FROM tokens GROUP BY 1, 2)
SELECT x.split, block, x_sum, x_order, t.id AS y_last FROM x JOIN tokens t ON t.split = x.split AND t.p = block * 64 + 64 WHERE n = 64""")
def token_blocks(spark, sf):
    docs = documents(spark, sf)
    blocks = C.make_blocks(C.encode_split(docs, C.char_vocab(docs)), 64, ["doc_id", "start"], "split")
    ordered = F.transform("x", lambda v, i: v.cast("long") * (i + 1))
    total = lambda c: F.aggregate(c, F.lit(0).cast("long"), lambda a, v: a + v)
    return blocks.select("split", "block", total("x").alias("x_sum"), total(ordered).alias("x_order"),
                         F.get("y", F.lit(63)).alias("y_last"))


@query("drawn_blocks", f"""
WITH {SQL_CHARS}, {SQL_SPLIT}, {SQL_IDS}, {SQL_PLACED},
room AS (SELECT split, count(*) AS n FROM tokens GROUP BY split HAVING count(*) > 32),
drawn AS (SELECT split, n, unnest(range(0, 500)) AS draw FROM room),
where_at AS (SELECT split, CAST(draw AS INTEGER) AS draw, CAST(floor({sql_uniform(SEED, 'block', 'split', 'draw')} * (n - 32)) AS BIGINT) AS start FROM drawn),
q AS (SELECT split, draw, start, unnest(range(0, 33)) AS k FROM where_at)
SELECT q.split, draw, start, CAST(sum(id * (k + 1)) FILTER (WHERE k < 32) AS BIGINT) AS x_order, CAST(sum(id * k) FILTER (WHERE k > 0) AS BIGINT) AS y_order
FROM q JOIN tokens t ON t.split = q.split AND t.p = start + k GROUP BY 1, 2, 3""")
def drawn_blocks(spark, sf):
    docs = documents(spark, sf)
    blocks = C.draw_blocks(C.encode_split(docs, C.char_vocab(docs)), 32, 500, SEED, ["doc_id", "start"], "split")
    ordered = lambda c: F.aggregate(
        F.transform(c, lambda v, i: v.cast("long") * (i + 1)), F.lit(0).cast("long"), lambda a, v: a + v)
    return blocks.select("split", "draw", "start", ordered("x").alias("x_order"), ordered("y").alias("y_order"))


@query("prefix_fractions", """
WITH placed AS (
  SELECT doc_id, length(text) AS n, sum(length(text)) OVER (ORDER BY doc_id) - length(text) AS pos,
         floor(sum(length(text)) OVER () * 0.9::DOUBLE) AS train FROM documents),
f AS (SELECT unnest([0.1, 0.25, 0.5, 1.0]::DOUBLE[]) AS fraction),
cut AS (SELECT doc_id, n, pos, fraction, greatest(1, CAST(floor(train * fraction) AS BIGINT)) AS c FROM placed, f)
SELECT fraction, count(*) AS documents, CAST(sum(least(n, c - pos)) AS BIGINT) AS tokens, max(doc_id) AS last_doc
FROM cut WHERE pos < c AND n > 0 GROUP BY fraction""")
def prefix_fractions(spark, sf):
    docs = documents(spark, sf)
    length = F.length("text").cast("long")
    fractions = [f for _, f in X.FRACTIONS]
    # rows of equal id and length stand as one with their count: a cut may fall between them
    folder = working_dir(spark, "lengths")
    docs.groupBy("doc_id", length.alias("n")).agg(F.count("*").alias("copies")).write.parquet(folder)
    narrow = spark.read.parquet(folder)
    weight = F.col("n") * F.col("copies")
    tree = ordering.SumTree(narrow, "doc_id", weight)
    ends = C.prefix_lengths(math.floor(tree.total * 0.9), fractions)
    pieces = ordering.pieces(narrow, "doc_id", weight, tree.cuts(ends))
    size = F.col("piece_to") - F.col("piece_from")
    # band i counts toward every fraction from i on
    bands = pieces.where(F.col("piece") < len(ends)).withColumn("fraction", F.explode(F.slice(
        F.array(*[F.lit(f) for f in fractions]), F.col("piece") + 1, F.lit(len(ends)))))
    # the part of equal rows before the cut begins so many of them
    begun = F.expr("(taken + n - 1) div n")
    return bands.groupBy("fraction", "doc_id", "n").agg(F.sum(size).alias("taken")).groupBy("fraction").agg(
        F.sum(begun).alias("documents"), F.sum("taken").alias("tokens"), F.max("doc_id").alias("last_doc"))


@query("token_dataset", f"""
WITH {SQL_CHARS}, {SQL_SPLIT}, {SQL_IDS}
SELECT split, count(*) AS pieces, CAST(sum(len(ids)) AS BIGINT) AS tokens, CAST(sum(list_sum(ids)) AS BIGINT) AS id_sum,
       (SELECT count(*) FROM vocab) AS vocabulary FROM ids GROUP BY split""")
def token_dataset(spark, sf):
    """Write the token dataset and its vocabulary, read both back by split."""
    docs = documents(spark, sf)
    vocab = C.char_vocab(docs)
    folder = working_dir(spark, "tokens")
    writers.write_vocab(vocab, folder + "/vocab")
    stored = readers.read_vocab(spark, folder + "/vocab")
    writers.write_tokens(C.encode_split(docs, stored), folder + "/ids")
    tokens = writers.retag_dataset(spark.read.parquet(folder + "/ids"), vocab, stored)
    return tokens.groupBy("split").agg(
        F.count("*").alias("pieces"), F.sum(F.size("ids")).alias("tokens"),
        F.sum(F.aggregate("ids", F.lit(0).cast("long"), lambda a, x: a + x)).alias("id_sum"),
    ).join(stored.agg(F.count("*").alias("vocabulary")))  # one-row side


@query("decode_roundtrip", """
SELECT doc_id, md5(text) AS digest, CAST(length(text) AS INTEGER) AS chars FROM documents""")
def decode_roundtrip(spark, sf):
    docs = documents(spark, sf)
    vocab = C.char_vocab(docs)
    decoded = docs.select("doc_id", C.encode("text", vocab).alias("ids")).select("doc_id", C.decode("ids", vocab).alias("t"))
    return decoded.select("doc_id", F.md5("t").alias("digest"), F.length("t").alias("chars"))


@query("merged_corpus", """
WITH m AS (
  SELECT 0 AS source_no, doc_id AS id, text FROM documents UNION ALL
  SELECT 1, item_id, text FROM benchmark UNION ALL SELECT 2, page_id, html FROM pages),
p AS (SELECT source_no, id, text || CASE WHEN source_no < 2 AND id = max(id) OVER (PARTITION BY source_no) THEN chr(10) || chr(10) ELSE '' END AS text FROM m),
o AS (SELECT source_no, length(text) AS n, sum(length(text)) OVER (ORDER BY source_no, id) - length(text) AS start FROM p)
SELECT source_no, count(*) AS documents, CAST(sum(n) AS BIGINT) AS characters, CAST(min(start) AS BIGINT) AS first_start, CAST(max(start) AS BIGINT) AS last_start
FROM o GROUP BY source_no""")
def merged_corpus(spark, sf):
    merged = C.merge_corpora(
        documents(spark, sf).select(F.col("doc_id").alias("id"), "text"),
        table(spark, sf, "benchmark").select(F.col("item_id").alias("id"), "text"),
        table(spark, sf, "pages").select(F.col("page_id").alias("id"), F.col("html").alias("text")), order="id")
    narrow = merged.select("source_no", "id", F.length("text").cast("long").alias("n"))
    placed = ordering.running_total(narrow, ["source_no", "id"], F.col("n"))
    return placed.groupBy("source_no").agg(
        F.count("*").alias("documents"), F.sum("n").alias("characters"),
        F.min("start").alias("first_start"), F.max("start").alias("last_start"))


# --- speeches ----------------------------------------------------------------

SQL_SPEECHES = r"""
lines AS (
  SELECT doc_id, unnest(l) AS raw, unnest(range(1, len(l) + 1)) AS n
  FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)),
stripped AS (SELECT doc_id, n, regexp_replace(raw, '^\s+|\s+$', '', 'g') AS line FROM lines),
flagged AS (
  SELECT doc_id, n, line,
    upper(regexp_replace(regexp_replace(line, '[:.]$', ''), '\s+', ' ', 'g')) AS name,
    regexp_full_match(line, '[A-Za-z][A-Za-z ''\-]{0,40}[.:]?')
      AND line <> lower(line) AND len(regexp_split_to_array(line, ' +')) <= 4
      AND upper(regexp_replace(regexp_replace(line, '[:.]$', ''), '\s+', ' ', 'g')) NOT IN ('ACT', 'SCENE', 'EPILOGUE', 'PROLOGUE')
      AND ((NOT regexp_matches(line, '(^|[^A-Za-z])[a-z]') AND NOT regexp_matches(line, '[A-Za-z][A-Z]'))
           OR length(regexp_replace(line, '[^A-Z]', '', 'g'))::DOUBLE / nullif(length(regexp_replace(line, '[^A-Za-z]', '', 'g')), 0) > 0.8) AS header
  FROM stripped),
islands AS (
  SELECT *, sum(CASE WHEN header OR line = '' THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY n) AS island FROM flagged),
heads AS (SELECT doc_id, island, name AS speaker FROM islands WHERE header),
body AS (
  SELECT doc_id, island, n, trim(regexp_replace(line, '\s+', ' ', 'g')) AS line FROM islands
  WHERE NOT header AND line <> '' AND NOT regexp_matches(line, '^[\[(]')),
speeches AS (
  SELECT b.doc_id, CAST(b.island AS INTEGER) AS speech_no, h.speaker, list(b.line ORDER BY b.n) AS lines,
         string_agg(b.line, chr(10) ORDER BY b.n) AS speech_text, CAST(count(*) AS INTEGER) AS num_lines
  FROM body b JOIN heads h ON b.doc_id = h.doc_id AND b.island = h.island
  GROUP BY b.doc_id, b.island, h.speaker
  HAVING length(trim(replace(string_agg(b.line, chr(10) ORDER BY b.n), chr(10), ' '))) >= 40)
"""
SQL_TOP = """
top AS (SELECT speaker, count(*) AS n, min((doc_id, speech_no)) AS first FROM speeches GROUP BY speaker
        ORDER BY n DESC, first LIMIT 10)
"""


def _speeches(spark, sf):
    return S.parse_speeches(documents(spark, sf))


@query("speeches", f"WITH {SQL_SPEECHES} SELECT doc_id, speech_no, speaker, num_lines, speech_text FROM speeches")
def speeches(spark, sf):
    return _speeches(spark, sf).select("doc_id", "speech_no", "speaker", "num_lines", "speech_text")


@query("speaker_top10", f"WITH {SQL_SPEECHES}, {SQL_TOP} SELECT speaker, n FROM top")
def speaker_top10(spark, sf):
    return S.top_n_frequent(_speeches(spark, sf), "speaker", ["doc_id", "speech_no"]).select("speaker", "n")


SQL_TASK_A = f"""
task_a AS (
  SELECT s.*, '[SPEAKER] ' || speech_text || ' [ANSWER] ' || speaker || ' [END]' AS text FROM (
    SELECT *, row_number() OVER (PARTITION BY speaker ORDER BY {sql_digest(SEED, 'speaker', 'doc_id', 'speech_no')}, doc_id, speech_no) AS rn
    FROM speeches WHERE speaker IN (SELECT speaker FROM top)) s
  WHERE rn <= 3)
"""


def _task_a(spark, sf, per_speaker=3):
    speeches = _speeches(spark, sf)
    top = S.top_n_frequent(speeches, "speaker", ["doc_id", "speech_no"])
    return S.speaker_examples(speeches, top, per_speaker, SEED)


@query("task_a_examples", f"""
WITH {SQL_SPEECHES}, {SQL_TOP}, {SQL_TASK_A}
SELECT 'A' AS task, speaker AS label, text, num_lines, doc_id, speech_no FROM task_a""")
def task_a_examples(spark, sf):
    return _task_a(spark, sf).select("task", "label", "text", "num_lines", "doc_id", "speech_no")


@query("task_a_split", f"""
WITH {SQL_SPEECHES}, {SQL_TOP}, {SQL_TASK_A},
placed AS (SELECT *, row_number() OVER (ORDER BY {sql_digest(SEED, 'split', 'doc_id', 'speech_no')}, doc_id, speech_no) AS position FROM task_a)
SELECT CAST(position AS INTEGER) AS position, CASE WHEN position <= 12 THEN 'train' ELSE 'test' END AS split, speaker AS label, text
FROM placed WHERE position <= 18""")
def task_a_split(spark, sf):
    return S.split_fixed(_task_a(spark, sf), 12, 6, SEED).select("position", "split", "label", "text")


SQL_TASK_B = r"""
measured AS (
  SELECT *, list_transform(lines, lambda l: length(l)) AS lens,
    list_transform(lines, lambda l: list_sum(list_transform(regexp_split_to_array(lower(l), ' '), lambda w:
      CASE WHEN regexp_replace(w, '[^a-z]', '', 'g') = '' THEN 0 ELSE greatest(1,
        len(regexp_extract_all(regexp_replace(w, '[^a-z]', '', 'g'), '[aeiouy]+'))
        - CASE WHEN regexp_replace(w, '[^a-z]', '', 'g') LIKE '%e'
                AND len(regexp_extract_all(regexp_replace(w, '[^a-z]', '', 'g'), '[aeiouy]+')) > 1 THEN 1 ELSE 0 END) END))) AS sylls,
    list_transform(lines, lambda l: CASE WHEN regexp_matches(l, '^\p{Ll}') THEN 1 ELSE 0 END) AS lows
  FROM speeches),
judged AS (
  SELECT *, CASE
    WHEN num_lines BETWEEN 3 AND 8
      AND len(list_filter(lens, lambda x: x BETWEEN 18 AND 65)) >= num_lines - 1
      AND len(list_filter(sylls, lambda x: x BETWEEN 8 AND 12)) >= greatest(2, num_lines - 1)
      AND list_sum(lows) <= 1 THEN 'VERSE'
    WHEN num_lines >= 3 AND len(list_filter(lens, lambda x: x >= 38)) >= num_lines - 1
      AND (len(list_filter(sylls, lambda x: x >= 12)) >= num_lines - 1
           OR coalesce(list_sum(lows[2:]), 0) >= greatest(1, num_lines // 2)) THEN 'PROSE' END AS label
  FROM measured),
texts AS (
  SELECT *, '[CLASSIFY] ' || CASE WHEN label = 'VERSE' THEN speech_text ELSE array_to_string(lines, ' ') END
            || ' [ANSWER] ' || label || ' [END]' AS text FROM judged WHERE label IS NOT NULL),
uniq AS (SELECT *, row_number() OVER (PARTITION BY label, text ORDER BY doc_id, speech_no) AS rn FROM texts),
task_b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY doc_id, speech_no) AS k FROM uniq WHERE rn = 1) WHERE k <= 350)
"""


@query("task_b_examples", f"""
WITH {SQL_SPEECHES}, {SQL_TASK_B}
SELECT 'B' AS task, label, text, speaker, doc_id, speech_no FROM task_b""")
def task_b_examples(spark, sf):
    return S.verse_prose_examples(_speeches(spark, sf)).select("task", "label", "text", "speaker", "doc_id", "speech_no")


@query("example_union", f"""
WITH {SQL_SPEECHES}, {SQL_TOP}, {SQL_TASK_A}, {SQL_TASK_B},
pool AS (
  SELECT 'A' AS task, speaker AS label, text, doc_id, speech_no, CAST(NULL AS VARCHAR) AS speaker FROM task_a
  UNION ALL SELECT 'B', label, text, doc_id, speech_no, speaker FROM task_b)
SELECT CAST(row_number() OVER (ORDER BY {sql_digest(SEED, 'shuffle', 'task', 'doc_id', 'speech_no')}, task, doc_id, speech_no) AS BIGINT) AS ordinal,
       task, label, speaker, md5(text) AS digest FROM pool""")
def example_union(spark, sf):
    from taleweave.functions.draws import shuffle_key

    both = S.union_examples(_task_a(spark, sf), S.verse_prose_examples(_speeches(spark, sf)))
    drawn = both.withColumn("draw", shuffle_key(SEED, "shuffle", "task", "doc_id", "speech_no"))
    return ordering.ordinal(drawn, ["draw", "task", "doc_id", "speech_no"]).select(
        "ordinal", "task", "label", "speaker", F.md5("text").alias("digest"))


@query("examples_roundtrip", f"""
WITH {SQL_SPEECHES}, {SQL_TOP}, {SQL_TASK_A}, {SQL_TASK_B},
pool AS (SELECT 'A' AS task, speaker AS label, text, num_lines FROM task_a UNION ALL SELECT 'B', label, text, num_lines FROM task_b)
SELECT task, label, count(*) AS examples, CAST(sum(length(text)) AS BIGINT) AS characters FROM pool GROUP BY task, label""")
def examples_roundtrip(spark, sf):
    """Write examples as text records, read them back by their end mark."""
    both = S.union_examples(_task_a(spark, sf), S.verse_prose_examples(_speeches(spark, sf)))
    folder = working_dir(spark, "examples")
    both.select("text").write.text(folder)
    stored = readers.read_examples(spark, folder)
    return stored.groupBy("task", "label").agg(
        F.count("*").alias("examples"), F.sum(F.length("text")).alias("characters"))


SQL_FILE_TEXT = "rtrim(ltrim(replace(text, chr(13), ' '), chr(10)), chr(10))"


@query("corpus_files", f"""
WITH t AS (SELECT {SQL_FILE_TEXT} AS text FROM documents),
blocks AS (SELECT unnest(string_split(text, chr(10) || chr(10))) AS block FROM t)
SELECT md5(block) AS digest, count(*) AS n, max(length(block)) AS chars FROM blocks GROUP BY block""")
def corpus_files(spark, sf):
    """Write the documents into a few large files, read them as blocks between
    blank lines, each file by many tasks."""
    folder = working_dir(spark, "corpus")
    text = F.trim(F.translate("text", "\r", " "), F.lit("\n"))
    documents(spark, sf).select(text.alias("value")).write.option("lineSep", "\n\n").text(folder)
    blocks = readers.read_corpus_blocks(spark, folder)
    return blocks.groupBy(F.md5("text").alias("digest")).agg(
        F.count("*").alias("n"), F.max(F.length("text")).cast("long").alias("chars"))


@query("extended_task_vocab", f"""
WITH {SQL_CHARS}, {SQL_SPEECHES}, {SQL_TOP}, {SQL_TASK_A}, {SQL_TASK_B},
wanted AS (SELECT DISTINCT unnest(string_split(t, '')) AS token FROM (
  SELECT text AS t FROM task_a UNION ALL SELECT text FROM task_b UNION ALL SELECT '{X.MARKER_TEXT}')),
fresh AS (SELECT token FROM wanted WHERE token <> '' EXCEPT SELECT token FROM vocab)
SELECT token, id FROM vocab UNION ALL
SELECT token, CAST((SELECT count(*) FROM vocab) + row_number() OVER (ORDER BY token) - 1 AS INTEGER) FROM fresh""")
def extended_task_vocab(spark, sf):
    both = S.union_examples(_task_a(spark, sf), S.verse_prose_examples(_speeches(spark, sf)))
    wanted = C.char_set(both, "text", X.MARKER_TEXT)
    return C.extend_vocab(C.char_vocab(documents(spark, sf)), wanted)


# --- n-grams -----------------------------------------------------------------

SQL_GRAMS = """
placed AS (
  SELECT doc_id, text, length(text) AS n, sum(length(text)) OVER (ORDER BY doc_id) - length(text) AS pos,
         floor(sum(length(text)) OVER () * 0.9::DOUBLE) AS train FROM documents),
runs AS (
  SELECT k AS ngram, substr(text, CAST(i AS BIGINT), k) AS gram, pos + i - 1 AS first, pos + i + k - 2 AS last, train
  FROM (SELECT *, unnest(range(1, n - k + 2)) AS i FROM placed, (SELECT unnest([1, 2, 3]) AS k) WHERE n >= k)),
"""


SQL_LOSSES = f"""
WITH {SQL_GRAMS}
f AS (SELECT unnest([0.1, 0.25, 0.5, 1.0]::DOUBLE[]) AS fraction),
model AS (
  SELECT fraction, ngram, gram, count(*) AS c FROM runs, f WHERE last < greatest(1, floor(train * fraction)) GROUP BY ALL),
contexts AS (SELECT fraction, ngram, substr(gram, 1, ngram - 1) AS ctx, sum(c) AS c FROM model GROUP BY ALL),
held AS (SELECT ngram, gram, count(*) AS h FROM runs WHERE first >= train GROUP BY ALL),
v AS (SELECT count(DISTINCT gram) AS v FROM runs WHERE ngram = 1 AND last < train)
SELECT h.ngram, CAST(sum(h) AS BIGINT) AS tokens, f.fraction,
       round(sum(-ln((coalesce(m.c, 0) + 1.0::DOUBLE) / (coalesce(x.c, 0) + 1.0::DOUBLE * v)) * h) / sum(h), 6) AS loss
FROM held h CROSS JOIN f CROSS JOIN v
LEFT JOIN model m ON m.fraction = f.fraction AND m.ngram = h.ngram AND m.gram = h.gram
LEFT JOIN contexts x ON x.fraction = f.fraction AND x.ngram = h.ngram AND x.ctx = substr(h.gram, 1, h.ngram - 1)
GROUP BY h.ngram, f.fraction"""


@query("ngram_loss", SQL_LOSSES)
def ngram_loss(spark, sf):
    losses = N.ngram_loss(documents(spark, sf), "doc_id", [1, 2, 3], [f for _, f in X.FRACTIONS])
    return losses.withColumn("loss", F.round("loss", 6))


@query("next_token_topk", """
WITH runs AS (SELECT unnest(list_transform(range(1, length(text) - 1), lambda i: substr(text, i, 3))) AS gram FROM documents WHERE length(text) >= 3),
counted AS (SELECT substr(gram, 1, 2) AS context, substr(gram, 3, 1) AS next, count(*) AS n FROM runs GROUP BY ALL),
ranked AS (SELECT *, rank() OVER (PARTITION BY context ORDER BY n DESC) AS r FROM counted),
kept AS (SELECT *, pow(n, 1.0::DOUBLE / 0.8::DOUBLE) AS w FROM ranked WHERE r <= 5)
SELECT context, next, n, round(w / sum(w) OVER (PARTITION BY context), 6) AS p FROM kept""")
def next_token_topk(spark, sf):
    counts = N.ngram_counts(documents(spark, sf), 3)
    return N.next_token_dist(counts, 5, 0.8).withColumn("p", F.round("p", 6))


@query("split_cross_entropy", """
WITH runs AS (SELECT source, unnest(list_transform(range(1, length(text)), lambda i: substr(text, i, 2))) AS gram FROM documents WHERE length(text) >= 2),
model AS (SELECT gram, count(*) AS n FROM runs GROUP BY ALL),
ctx AS (SELECT substr(gram, 1, 1) AS c, sum(n) AS total FROM model GROUP BY ALL),
held AS (SELECT source, gram, count(*) AS h FROM runs GROUP BY ALL)
SELECT source, CAST(sum(h) AS BIGINT) AS tokens,
       round(sum(-ln((n + 0.5::DOUBLE) / (total + 128.0::DOUBLE)) * h) / sum(h), 6) AS loss
FROM held JOIN model USING (gram) JOIN ctx ON ctx.c = substr(held.gram, 1, 1) GROUP BY source""")
def split_cross_entropy(spark, sf):
    docs = documents(spark, sf)
    by_source = R.settle(N.ngram_counts(docs, 2, "source"))
    model = by_source.groupBy("context", "next").agg(F.sum("n").alias("n"))
    return N.cross_entropy(model, by_source, 256, 0.5, "source").withColumn("loss", F.round("loss", 6))


# --- sub-words ---------------------------------------------------------------

VOCAB_SIZE, MERGE_STEPS = 160, 120


@query("bpe_merges", f"""
WITH {learned_sql(VOCAB_SIZE, MERGE_STEPS)}
SELECT id, token, "left", "right", CAST(pair_count AS BIGINT) AS pair_count FROM vocab""")
def bpe_merges(spark, sf):
    return subword.learn_bpe(documents(spark, sf), VOCAB_SIZE)


@query("bpe_encode", f"""
WITH {learned_sql(VOCAB_SIZE, MERGE_STEPS)}, {encoded_sql(MERGE_STEPS)}
SELECT d.doc_id, len(string_split(ids, ' ')) AS n_ids, md5(ids) AS ids_digest,
       md5(CASE WHEN starts_with(text, ' ') THEN text ELSE ' ' || text END) AS digest
FROM documents d LEFT JOIN encoded e USING (doc_id)""")
def bpe_encode(spark, sf):
    """Encode every document and decode it again."""
    docs = documents(spark, sf)
    vocab = subword.learn_bpe(docs, VOCAB_SIZE)
    decoded = subword.bpe_encode(docs, vocab).withColumn("text", subword.bpe_decode("ids", vocab))
    return decoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_ids"),
        F.md5(F.array_join(F.col("ids").cast("array<string>"), " ")).alias("ids_digest"), F.md5("text").alias("digest"))


# --- evaluation --------------------------------------------------------------

SQL_EVAL = """
examples AS (
  SELECT d.doc_id, d.lang, CASE WHEN quality = 1 THEN 'GOOD' ELSE 'POOR' END AS gold,
         '[CLASSIFY] ' || d.text || ' [ANSWER] ' AS prompt
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
judged AS (
  SELECT doc_id, lang, gold, CASE WHEN contains(prompt, ' the ') THEN 'GOOD' WHEN contains(prompt, ' und ') THEN 'GOOD'
         WHEN contains(prompt, ' la ') THEN 'GOOD' ELSE 'POOR' END AS pred FROM examples)
"""
RULES = [(" the ", "GOOD"), (" und ", "GOOD"), (" la ", "GOOD")]


def _judged(spark, sf):
    docs, labels = documents(spark, sf), table(spark, sf, "labels")
    examples = docs.join(labels, "doc_id").select(
        "doc_id", "lang", "text", F.when(F.col("quality") == 1, "GOOD").otherwise("POOR").alias("label"))
    examples = examples.withColumn("text", S.format_example("B", "text", "label"))
    return E.evaluate(examples, E.keyword_scorer(RULES, "POOR"))


@query("eval_accuracy", f"""
WITH {SQL_EVAL} SELECT lang, count(*) AS examples, CAST(sum(CASE WHEN gold = pred THEN 1 ELSE 0 END) AS BIGINT) AS hits,
  round(avg(CASE WHEN gold = pred THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM judged GROUP BY lang""")
def eval_accuracy(spark, sf):
    return E.accuracy(_judged(spark, sf), "lang").withColumn("accuracy", F.round("accuracy", 6))


@query("eval_mistakes", f"WITH {SQL_EVAL} SELECT doc_id, gold, pred FROM judged WHERE gold <> pred")
def eval_mistakes(spark, sf):
    return E.mistakes(_judged(spark, sf)).select("doc_id", F.col("label").alias("gold"), "pred")


@query("setup_comparison", f"""
WITH {SQL_EVAL},
per AS (SELECT lang AS setup, avg(CASE WHEN gold = pred THEN 1.0 ELSE 0.0 END) AS task_a FROM judged GROUP BY lang),
loss AS (SELECT lang AS setup, avg(length(text)) / 1000.0 AS val_loss FROM documents GROUP BY lang),
rows AS (SELECT per.setup, task_a, val_loss FROM per JOIN loss USING (setup) UNION ALL SELECT 'Random baseline', 0.1, NULL)
SELECT setup, round(task_a, 4) AS task_a, round(val_loss, 4) AS val_loss,
       round(val_loss - (SELECT val_loss FROM rows WHERE setup = 'en'), 4) AS forgetting_delta FROM rows""")
def setup_comparison(spark, sf):

    acc = E.accuracy(_judged(spark, sf), "lang").select(F.col("lang").alias("setup"), F.col("accuracy").alias("task_a"))
    loss = documents(spark, sf).groupBy(F.col("lang").alias("setup")).agg(
        (F.avg(F.length("text")) / 1000.0).alias("val_loss"))
    compared = E.compare_setups(acc.join(loss, "setup"), "en")
    return R.rounded(compared, {"task_a": 4, "val_loss": 4, "forgetting_delta": 4})


@query("best_setup", f"""
WITH {SQL_EVAL}, per AS (SELECT lang AS setup, avg(CASE WHEN gold = pred THEN 1.0 ELSE 0.0 END) AS task_a FROM judged GROUP BY lang)
SELECT 'best' AS kind, setup, round(task_a, 6) AS task_a FROM (SELECT * FROM per ORDER BY task_a DESC, setup LIMIT 1)
UNION ALL SELECT 'worst', setup, round(task_a, 6) FROM (SELECT * FROM per ORDER BY task_a, setup LIMIT 1)""")
def best_setup(spark, sf):

    acc = R.settle(E.accuracy(_judged(spark, sf), "lang").select(F.col("lang").alias("setup"), F.col("accuracy").alias("task_a")))
    both = [R.arg_best(acc, "task_a", "setup", high).select(F.lit(kind).alias("kind"), "setup", F.round("task_a", 6).alias("task_a"))
            for kind, high in (("best", True), ("worst", False))]
    return both[0].unionByName(both[1])


WORDS = ["the", "and", "und", "que", "[END]", "VERSE"]


@query("marker_hits", f"""
SELECT lang, CAST(sum(list_sum(list_transform({sql_list(WORDS)}, lambda w: (length(text) - length(replace(text, w, ''))) // length(w)))) AS BIGINT) AS hits
FROM documents GROUP BY lang""")
def marker_hits(spark, sf):
    return E.marker_hits(documents(spark, sf), "lang", markers=tuple(WORDS))


@query("sample_report", """
SELECT source AS setup, CAST(sum(list_sum(list_transform(['[SPEAKER]', '[CLASSIFY]', '[ANSWER]', '[END]', 'VERSE', 'PROSE'],
         lambda w: (length(text) - length(replace(text, w, ''))) // length(w)))) AS BIGINT) AS hits,
       replace(substr(arg_min(text, doc_id), 1, 240), chr(10), ' ') AS preview,
       trim(regexp_replace(lower(source), '[^a-z0-9]+', '_', 'g'), '_') AS slug
FROM documents GROUP BY source""")
def sample_report(spark, sf):
    return E.sample_report(documents(spark, sf).withColumnRenamed("source", "setup"), "setup", "doc_id")


@query("sample_bundles", """
SELECT trim(regexp_replace(lower(source), '[^a-z0-9]+', '_', 'g'), '_') AS slug, count(*) AS samples FROM documents GROUP BY 1""")
def sample_bundles(spark, sf):
    """Write documents as text bundles per source, count the headings read back."""
    folder = working_dir(spark, "samples")
    docs = documents(spark, sf).select(F.col("source").alias("setup"), F.col("doc_id").alias("sample"), "text")
    writers.write_samples(docs, folder)
    heads = spark.read.text(folder).where(F.regexp_like("value", F.lit(r"^===== .+ / sample \d+ =====$")))
    return heads.groupBy(F.col("setup_slug").alias("slug")).agg(F.count("*").alias("samples"))


@query("longest_label", f"""WITH {SQL_EVAL} SELECT CAST(max(length(gold || ' [END]')) AS INTEGER) AS longest FROM examples""")
def longest_label(spark, sf):
    labels = table(spark, sf, "labels").join(documents(spark, sf).select("doc_id"), "doc_id")
    return E.longest_label(labels.select(F.when(F.col("quality") == 1, "GOOD").otherwise("POOR").alias("label")))

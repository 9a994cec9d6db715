"""The operators applied to whole tables, one query for each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from taleweave.llm import bpe, codebooks, decontaminate, kneser_ney, manifest, neardup, quality, tokencount, toxicity
from taleweave.llm.codebooks_sql import codes_sql
from taleweave.llm.common import settled, whole_text
from taleweave.llm.fingerprints import fingerprint_edits
from taleweave.llm.manifest_sql import manifest_sql
from taleweave.llm.mixing import count_tokens, mix_sources
from taleweave.llm.sharding import assign_shards, text_bytes, text_group
from taleweave.llm.topk import top_k

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(run):
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def vocabulary(name: str) -> str:
    """A vocabulary file of the public tokenizers, the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op1_source_mix")
def op1(spark, folder):
    docs = table(spark, folder, "documents")
    narrow = settled(docs.select("doc_id", "source", count_tokens().alias("n_tokens")), "mix")
    return mix_sources(narrow)


@query("op2_kneser_ney")
def op2(spark, folder):
    return kneser_ney.perplexity_scores(table(spark, folder, "documents"))


@query("op3_shards")
def op3(spark, folder):
    docs = table(spark, folder, "documents")
    narrow = settled(docs.select(
        "doc_id", text_bytes().alias("size"), F.crc32(whole_text()).alias("text_crc32"), text_group().alias("group")),
        "sizes")
    return assign_shards(narrow).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


@query("op4_toxicity")
def op4(spark, folder):
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    scored = toxicity.score_toxicity(docs.select("doc_id", "text"), labels)
    return scored.select("doc_id", "p_toxic", "p_toxic_prose", "p_toxic_junk", toxicity.is_toxic().alias("toxic"))


@query("op5_quality_rules")
def op5(spark, folder):
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    out = kneser_ney.held_out(parts=5)
    scored = quality.score_quality(docs.select("doc_id", "text"), labels, train=~out)
    return scored.select("doc_id", out.alias("held_out"), "score", "predicted")


@query("op6_token_counts")
def op6(spark, folder):
    return tokencount.count_tokens(table(spark, folder, "documents"), vocabulary("piece_bpe_32k.model"))


@query("op7_imatch")
def op7(spark, folder):
    return fingerprint_edits(table(spark, folder, "documents"))


@query("op8_near_duplicates")
def op8(spark, folder):
    return neardup.near_duplicates(table(spark, folder, "documents")).select("doc_id", "class_id", "stays")


def digests(encoded: DataFrame) -> DataFrame:
    """Counts and digests of ids and of the text they decode to."""
    return encoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"))


@query("op9_bpe")
def op9(spark, folder):
    path = vocabulary("word_bpe_49k.json")
    return digests(bpe.encode_decode(table(spark, folder, "documents"), path))


_TOP_K_SQL = """
WITH v AS (
    SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS w
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.w, c.w) AS BIGINT) AS score
    FROM v q JOIN v c ON c.vec_id <> q.vec_id
    WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id, score
FROM scored
QUALIFY rank <= 5"""


@query("op10_top_k", _TOP_K_SQL)
def op10(spark, folder):
    vectors = table(spark, folder, "embeddings")
    return top_k(vectors.where(F.col("vec_id") % 50 == 0), vectors, 5)


_HITS_SQL = r"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM documents),
b AS (
    SELECT item_id,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM benchmark),
starts AS (
    SELECT item_id, words, unnest(generate_series(1, greatest(len(words) - 9, 1))) AS s FROM b WHERE len(words) > 0),
windows AS (
    SELECT DISTINCT item_id, array_to_string(words[s:s + 9], ' ') AS w, least(len(words), 10) AS n FROM starts),
places AS (SELECT r, words, unnest(generate_series(1, len(words))) AS s FROM d WHERE len(words) > 0),
sizes AS (SELECT DISTINCT n FROM windows),
runs AS (
    SELECT r, s, n, array_to_string(words[s:s + n - 1], ' ') AS w FROM places, sizes WHERE s + n - 1 <= len(words)),
found AS (SELECT r, s, runs.n, item_id FROM runs JOIN windows USING (w)),
words_hit AS (
    SELECT r, count(DISTINCT pos) AS n_hit
    FROM (SELECT DISTINCT r, unnest(generate_series(s, s + n - 1)) AS pos FROM found) GROUP BY r),
items AS (
    SELECT r, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
    FROM (SELECT DISTINCT r, item_id::VARCHAR AS name FROM found WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words_hit USING (r) LEFT JOIN items USING (r)"""


@query("op11_decontaminate", _HITS_SQL)
def op11(spark, folder):
    docs, benchmark = table(spark, folder, "documents"), table(spark, folder, "benchmark")
    found = decontaminate.contaminated(docs, benchmark, keep=["doc_id"])
    return found.select(
        "row.doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


@query("op12_orchard_codes", codes_sql())
def op12(spark, folder):
    return codebooks.encode(table(spark, folder, "embeddings"))


@query("op13_manifest", manifest_sql())
def op13(spark, folder):
    return manifest.manifest(manifest.document_leaves(table(spark, folder, "documents")))

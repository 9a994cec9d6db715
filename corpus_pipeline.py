"""The corpus pipeline: five stages over `documents`.

Toxic documents go, then those of low quality, then all but one of each class
of near duplicates; sources are mixed, and the mix is encoded. A document that
is read more than once in the mix is a row for each time.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from taleweave.llm import bpe, kneser_ney, neardup, quality, toxicity
from taleweave.llm.common import settled, whole_text
from taleweave.llm.mixing import count_tokens, mix_sources
from taleweave.llm.queries import QUERIES, digests, table, vocabulary


def _wrapped(docs: DataFrame, *columns: str) -> DataFrame:
    """The whole row as one struct, beside the columns that a stage works on,
    so that no column a stage adds can clash with a given one."""
    return docs.select(F.struct(*docs.columns).alias("row"), *columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    chain = toxicity.fit(docs, toxicity.label_categories(table(spark, sf_dir, "labels")), toxicity.CATEGORIES)
    scored = toxicity.score(_wrapped(docs, "text"), chain)
    return scored.where(~toxicity.is_toxic()).select("row.*")


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    scored = quality.score_quality(_wrapped(docs, "doc_id", "text"), labels, train=~kneser_ney.held_out(parts=5))
    return scored.where("predicted = 1").select("row.*")


def drop_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    def name(node):
        return F.concat_ws("|", F.col("doc_id").cast("string"), node)

    kept = neardup.near_duplicates(docs).where("stays").select(name(F.col("node")).alias("name"))
    named = _wrapped(docs, "doc_id", "text").select("row", name(F.md5(whole_text())).alias("name"))
    kept = named.join(kept, "name", "left_semi")
    # repeated rows have one name
    once = Window.partitionBy("name").orderBy(F.lit(0))
    return kept.withColumn("n", F.row_number().over(once)).where("n = 1").select("row.*")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    counted = _wrapped(docs, "doc_id", "source", "text").withColumn("n_tokens", count_tokens()).drop("text")
    return mix_sources(counted).select("row.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    path = vocabulary("word_bpe_49k.json")
    return digests(bpe.encode_decode(docs, path))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic), ("quality", drop_poor), ("near duplicates", drop_duplicates), ("mixing", mix),
    ("bpe", encode),
]

#: Learned and hashed decisions have no SQL; the tests check the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each on what the one before has kept."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = settled(docs, name.replace(" ", "-"))
    return docs


QUERIES["pipeline"] = run

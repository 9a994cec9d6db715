"""Sinks. Every sink is a partitioned write; nothing passes through the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taleweave.functions.text import slug
from taleweave.operators.corpus import MAX_TOKEN_ID
from taleweave.sources.readers import _manifest, latest_version


def write_registry(df: DataFrame, path: str, version: int | None = None) -> int:
    """Write a whole registry as a new version folder, never in place. The
    version is visible once the manifest names it, after its last file."""
    if version is None:
        last = latest_version(df.sparkSession, path)
        version = 0 if last is None else last + 1
    df.write.mode("overwrite").parquet(f"{path.rstrip('/')}/version={version}")
    df.sparkSession.range(1).select(F.lit(version).cast("long").alias("version")).write.mode("append").json(_manifest(path))
    return version


def write_registry_json(df: DataFrame, path: str) -> None:
    """Records as JSON lines in `seq` order (a range-partitioned sort)."""
    df.orderBy("seq").drop("seq").write.mode("overwrite").json(path)


def checked_ids(ids: str = "ids") -> "F.Column":
    top = F.coalesce(F.array_max(ids), F.lit(0))
    low = F.coalesce(F.array_min(ids), F.lit(0))
    bad = (top > MAX_TOKEN_ID) | (low < 0)
    return F.when(bad, F.raise_error(F.lit("token id outside 16 bits")).cast("array<int>")).otherwise(F.col(ids))


def write_tokens(df: DataFrame, path: str) -> None:
    """Token dataset by split; fails on an id that does not fit 16 bits."""
    df.withColumn("ids", checked_ids()).write.mode("overwrite").partitionBy("split").parquet(path)


def write_vocab(vocab: DataFrame, path: str) -> None:
    vocab.select("token", "id").write.mode("overwrite").parquet(path)


def retag_dataset(tokens: DataFrame, base: DataFrame, vocab: DataFrame) -> DataFrame:
    """A token dataset under an extended vocabulary: the ids are unchanged, so
    only the claim that base ids did not move is checked."""
    moved = base.select("token", "id").join(vocab.select("token", "id"), ["token", "id"], "left_anti")
    if moved.limit(1).count():
        raise ValueError("the new vocabulary moves a base id")
    return tokens


def write_examples(df: DataFrame, path: str) -> None:
    """Labelled examples as JSON lines by split, one record per line."""
    df.write.mode("overwrite").partitionBy("split").json(path)


def write_samples(df: DataFrame, path: str, setup: str = "setup", number: str = "sample", text: str = "text") -> None:
    """Generated samples as text, one folder per setup slug, with headings."""
    heading = F.concat(F.lit("===== "), F.col(setup), F.lit(" / sample "), F.col(number).cast("string"), F.lit(" =====\n"))
    body = F.concat(heading, F.col(text), F.lit("\n"))
    df.select(F.col(number), slug(setup).alias("setup_slug"), body.alias("value")) \
        .repartition("setup_slug", F.floor(F.col(number) / 10_000)) \
        .sortWithinPartitions("setup_slug", number).drop(number) \
        .write.mode("overwrite").partitionBy("setup_slug").text(path)


def write_runs(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)

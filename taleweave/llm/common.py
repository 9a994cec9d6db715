"""Helpers that several operators share."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from taleweave.session import working_dir


#: Characters of a plan's description that the driver keeps for each write.
PLAN_CHARS = 4000


@contextmanager
def short_plans(spark: SparkSession) -> Iterator[None]:
    """Descriptions of plans are cut inside. The driver keeps them for every
    job and every change of a running plan; long ones would fill its memory."""
    name = "spark.sql.maxPlanStringLength"
    before = spark.conf.get(name)
    spark.conf.set(name, str(PLAN_CHARS))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def settled(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate table once to the shared folder and read it back,
    so that later steps do not compute it again and survive lost executors."""
    spark = df.sparkSession
    path = working_dir(spark, name)
    with short_plans(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def whole_text(text: str = "text") -> Column:
    """The text of a row; null counts as empty."""
    return F.coalesce(F.col(text), F.lit(""))


def unit_hash(*parts) -> Column:
    """Uniform value in [0, 1) that depends on the parts alone."""
    digest = F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("~")) for p in parts]))
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") / F.lit(float(16 ** 12))


def tree_search(below, cuts: Sequence, first: int = 0) -> Column:
    """Number of cuts that are not above a row's key, as a comparison tree.

    `below(cut)` says whether the row's key lies below a cut; the cuts ascend.
    """
    if not cuts:
        return F.lit(first)
    half = len(cuts) // 2
    return F.when(below(cuts[half]), tree_search(below, cuts[:half], first)).otherwise(
        tree_search(below, cuts[half + 1:], first + half + 1))


def slices(lengths, limit: int) -> Iterator[tuple[int, int]]:
    """Cut a run of rows into [start, stop) pieces of about `limit` in total
    length; a single longer row is a piece of its own."""
    start = total = 0
    for i, n in enumerate(lengths):
        if i > start and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if len(lengths) > start:
        yield start, len(lengths)

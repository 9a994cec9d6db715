"""Registry of the runnable queries and of the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query, with the SQL that must give the same rows if any."""
    def add(run):
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


#: A table in fewer files or splits than this is small (8 GB at the usual split size).
SMALL_SPLITS = 64


def spread_table(spark: SparkSession, folder: str, name: str, key: str) -> DataFrame:
    """A table that heavy per-row work reads. A small file has fewer row groups
    than there are cores; only then are its rows spread, and over at most
    SMALL_SPLITS tasks. A large table is read as it lies on any cluster."""
    df = table(spark, folder, name)
    wanted = min(spark.sparkContext.defaultParallelism, SMALL_SPLITS)
    return df if df.rdd.getNumPartitions() >= wanted else df.repartition(wanted, key)


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spread_table(spark, folder, "documents", "doc_id")


def sql_uniform(seed: int, purpose: str, *keys: str, first: int = 1) -> str:
    """SQL of the uniform draw: eight hex digits of a digest over 2^32."""
    digest = sql_digest(seed, purpose, *keys)
    return f"(('0x' || substr({digest}, {first}, 8))::BIGINT / 4294967296.0::DOUBLE)"


def sql_digest(seed: int, purpose: str, *keys: str) -> str:
    parts = ", ".join([f"'{seed}'", f"'{purpose}'", *[f"CAST({k} AS VARCHAR)" for k in keys]])
    return f"md5(concat_ws('|', {parts}))"


def sql_normal(seed: int, purpose: str, *keys: str) -> str:
    a, b = sql_uniform(seed, purpose, *keys), sql_uniform(seed, purpose, *keys, first=9)
    return f"(sqrt(-2.0::DOUBLE * ln(1.0::DOUBLE - {a})) * cos(2.0::DOUBLE * pi() * {b}))"


def sql_list(values) -> str:
    return "[" + ", ".join("'" + str(v).replace("'", "''") + "'" for v in values) + "]"


def sql_pick(values, draw: str) -> str:
    source = values if isinstance(values, str) else sql_list(values)
    return f"({source})[CAST(floor({draw} * len({source})) AS BIGINT) + 1]"

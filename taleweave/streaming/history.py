"""Bounded conversation history as a stream with keyed state."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

TURN_SCHEMA = "conv_id long, turn long, role string, text string"
OUT_SCHEMA = "conv_id long, turn long, role string, text string, version long"
STATE_SCHEMA = "turn long, role string, text string"


class BoundedHistory(StatefulProcessor):
    """Keeps the last `cap` turns of each conversation in list state.

    Every update emits the whole capped history with a growing version, so a
    sink can keep the newest version per conversation.
    """

    def __init__(self, cap: int):
        self.cap = cap

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.turns = handle.getListState("turns", STATE_SCHEMA)
        self.version = handle.getValueState("version", "version long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timer_values) -> Iterator[pd.DataFrame]:
        kept = [tuple(t) for t in self.turns.get()] if self.turns.exists() else []
        for batch in rows:  # state stays bounded while a long batch passes
            kept += list(batch[["turn", "role", "text"]].itertuples(index=False, name=None))
            kept = sorted(kept, key=lambda t: t[0])[-self.cap:]
        version = (self.version.get()[0] if self.version.exists() else 0) + 1
        self.turns.put([(int(t), r, x) for t, r, x in kept])
        self.version.update((version,))
        frame = pd.DataFrame(kept, columns=["turn", "role", "text"])
        frame.insert(0, "conv_id", key[0])
        frame["version"] = version
        yield frame

    def close(self) -> None:
        pass


def bounded_history(turns: DataFrame, cap: int = 24) -> DataFrame:
    """Capped history of a stream of turns. Needs the RocksDB state store."""
    return turns.groupBy("conv_id").transformWithStateInPandas(
        statefulProcessor=BoundedHistory(cap), outputStructType=OUT_SCHEMA,
        outputMode="Append", timeMode="None")


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


@contextmanager
def rocksdb(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB."""
    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(_PROVIDER, before)

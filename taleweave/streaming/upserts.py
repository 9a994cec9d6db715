"""Latest-wins upserts of a record stream into a partitioned registry table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from taleweave.operators.registry import conform
from taleweave.sources.partitioned import BUCKETS, PartitionedTable


def apply_batch(batch: DataFrame, epoch: int, path: str, order, stream: str = "", buckets: int = BUCKETS) -> int | None:
    """Merge one micro-batch; only the partitions of its ids are rewritten.

    A stream is known by a name, its checkpoint folder as a rule. A batch that
    is replayed after its commit changes nothing; one that failed before it is
    applied as if for the first time. Returns the version, None for a replay.
    """
    order = [order] if isinstance(order, str) else list(order)
    # the order columns need not be columns of a record
    named = {c: f"_order{i}" for i, c in enumerate(order)}
    given = batch.withColumns({n: batch[c] for c, n in named.items()})
    records = conform(given, keep=list(named.values()))
    table = PartitionedTable(batch.sparkSession, path, buckets=buckets)
    return table.upsert(records, list(named.values()), stream, epoch, drop=named.values())


def upsert_stream(stream: DataFrame, path: str, checkpoint: str, order, buckets: int = BUCKETS, **trigger) -> StreamingQuery:
    """Start the upsert query; rows of a batch apply in `order`. Restarted from
    the same checkpoint it goes on where it was, each row applied once."""
    return (
        stream.writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(lambda batch, epoch: _tell(apply_batch(batch, epoch, path, order, checkpoint, buckets)))
        .trigger(**(trigger or {"availableNow": True})).start()
    )


def _tell(_) -> None:
    """foreachBatch takes functions without a result."""

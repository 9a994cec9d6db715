"""Record updates and field edits as streams with keyed state.

The state of a record holds the last value of every field with its sequence
number, and the last few notes: the log of its changes, brought to its shortest
form. Rows may come in any order and in any micro-batches; applying the short
log to the records gives what the batch operators give for the whole one.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState

from taleweave.functions.text import strip
from taleweave.operators.extract import TRAIT
from taleweave.operators.registry import edit_reason

#: Field of a row that adds a note; every other field keeps its last value.
NOTE = "+note"
CHANGE_SCHEMA = "npc_id string, seq long, field string, value string"
LOG_SCHEMA = "npc_id string, version long, seq long, field string, value string"
UNKNOWN = "unknown id"


#: Records whose state is held together, about.
TOGETHER = 256


def last_changes(note_cap: int):
    """Step of the stateful query over (bucket, npc_id, seq, field, value): gives
    the whole short log of each record a batch changes, with a growing version.

    A state holds the records of a bucket, of which there are few, so that a
    record costs no call of its own. Traits come as a set: those of the newest
    row that has any replace all.
    """
    def step(key, rows: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = {r[0]: r[1:] for r in json.loads(state.get[0])} if state.exists else {}
        changed = set()
        for batch in rows:
            for npc, seq, field, value in zip(*[batch[c].tolist() for c in ("npc_id", "seq", "field", "value")]):
                seq = int(seq)
                if npc not in changed:
                    changed.add(npc)
                    record = held.setdefault(npc, [0, {}, []])
                    record[0] += 1
                _, fields, notes = record = held[npc]
                if field == NOTE:
                    notes.append([seq, value])
                    if len(notes) >= 4 * note_cap:  # bounded while a long batch passes
                        record[2] = sorted(notes)[-note_cap:]
                elif field.startswith(TRAIT):
                    newest = max((s for f, (s, _) in fields.items() if f.startswith(TRAIT)), default=seq)
                    if seq > newest:
                        for f in [f for f in fields if f.startswith(TRAIT)]:
                            del fields[f]
                    if seq >= newest:
                        fields[field] = [seq, value]
                elif field not in fields or seq >= fields[field][0]:
                    fields[field] = [seq, value]
        out = []
        for npc in changed:
            record = held[npc]
            record[2] = sorted(record[2])[-note_cap:]
            version, fields, notes = record
            out += [(npc, version, s, f, v) for f, (s, v) in fields.items()]
            out += [(npc, version, s, NOTE, v) for s, v in notes]
        state.update((json.dumps([[npc, *record] for npc, record in held.items()]),))
        yield pd.DataFrame(out, columns=["npc_id", "version", "seq", "field", "value"])

    return step


def checked_edits(edits: DataFrame) -> DataFrame:
    """Rows of typed edits, with the reason why one is refused."""
    return edits.select("npc_id", "seq", "field", "value", edit_reason().alias("reason"))


def update_rows(log: DataFrame, attributes: DataFrame) -> DataFrame:
    """Rows of free-text updates: what was extracted, and the texts as notes.

    `log` has (npc_id, seq, text), `attributes` (npc_id, seq, field, value).
    """
    notes = log.select("npc_id", "seq", F.lit(NOTE).alias("field"), strip("text").alias("value")).where("value <> ''")
    return attributes.select("npc_id", "seq", "field", "value").unionByName(notes)


def rows_stream(stream: DataFrame, rows_of: Callable[[DataFrame], DataFrame], path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Start a query that writes what `rows_of` makes of each micro-batch, one
    folder for each epoch; a replay writes the same folder anew."""
    def put(batch: DataFrame, epoch: int) -> None:
        rows_of(batch).write.mode("overwrite").parquet(f"{path}/epoch={epoch}")

    return stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(put) \
        .trigger(**(trigger or {"availableNow": True})).start()


def _known_ids(records: DataFrame, checkpoint: str) -> DataFrame:
    """Distinct ids of the records, as they were when the checkpoint was new."""
    spark, path = records.sparkSession, f"{checkpoint.rstrip('/')}/known-ids"
    ids = records.select(F.col("npc_id").cast("string").alias("npc_id")).distinct()
    try:
        spark.read.text(f"{path}/_SUCCESS*")  # a file that stands once all others do
    except AnalysisException:
        ids.write.mode("overwrite").parquet(path)
    return spark.read.schema(ids.schema).parquet(path)


def change_stream(changes: DataFrame, records: DataFrame, path: str, rejects: str, checkpoint: str,
                  note_cap: int = 12, **trigger) -> StreamingQuery:
    """Start the stateful query over (npc_id, seq, field, value, reason) rows.

    Short logs go to `path`, refused rows to `rejects`. `records` names the
    known ids when the query first starts; changes of others are refused, and
    no refused row reaches the state. Needs the RocksDB state store.
    """
    known = _known_ids(records, checkpoint)
    # the known ids never change, so neither does the number of buckets
    buckets = known.count() // TOGETHER + 1
    ids = known.select(F.col("npc_id").alias("_id"), F.lit(True).alias("_known"))
    reason = F.coalesce("reason", F.when(F.col("_known").isNull(), UNKNOWN))
    checked = changes.join(ids, F.col("npc_id").eqNullSafe(F.col("_id")), "left").select(
        "npc_id", "seq", "field", "value", reason.alias("reason"))
    kept = checked.where("reason IS NULL").select(
        F.pmod(F.xxhash64("npc_id"), F.lit(buckets)).alias("bucket"), "npc_id", "seq", "field", "value")
    logs = kept.groupBy("bucket").applyInPandasWithState(
        last_changes(note_cap), LOG_SCHEMA, "records string", "append", "NoTimeout")
    refused = checked.where("reason IS NOT NULL").withColumn("version", F.lit(None).cast("long"))
    logs = logs.withColumn("reason", F.lit(None).cast("string")).unionByName(refused)

    def put(batch: DataFrame, epoch: int) -> None:
        batch = batch.persist()  # two sinks, one run of the state
        try:
            batch.where("reason IS NULL").drop("reason").write.mode("overwrite").parquet(f"{path}/epoch={epoch}")
            batch.where("reason IS NOT NULL").drop("version").write.mode("overwrite").parquet(f"{rejects}/epoch={epoch}")
        finally:
            batch.unpersist()

    return logs.writeStream.option("checkpointLocation", checkpoint).foreachBatch(put) \
        .trigger(**(trigger or {"availableNow": True})).start()


def read_changes(spark: SparkSession, path: str) -> DataFrame:
    """(npc_id, seq, field, value): the newest short log of each record."""
    try:
        logs = spark.read.schema(LOG_SCHEMA).parquet(f"{path}/epoch=*")
    except AnalysisException:
        return spark.createDataFrame([], CHANGE_SCHEMA)
    newest = logs.groupBy("npc_id").agg(F.max("version").alias("version"))
    return logs.join(newest, ["npc_id", "version"]).drop("version")


def split_notes(changes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(attributes, log) of a short log, as `extract.apply_updates` takes them."""
    note = F.col("field") == NOTE
    return changes.where(~note), changes.where(note).select("npc_id", "seq", F.col("value").alias("text"))

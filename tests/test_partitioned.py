"""The partitioned registry table and the stream into it."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from taleweave.sources.partitioned import CommitConflict, PartitionedTable, bucket_of
from taleweave.streaming.upserts import apply_batch, upsert_stream

SCHEMA = "npc_id string, name string, at long"


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def rows_of(table, version=None):
    return [(r["npc_id"], r["name"], r["seq"]) for r in table.read(version).orderBy("seq").collect()]


def put(table, df, **options):
    return table.upsert(df, "at", drop=["at"], **options)


def files_of(path):
    return {str(p): p.stat().st_mtime_ns for p in Path(path).rglob("data/**/*.parquet")}


def test_upserts_rewrite_touched_partitions_only(spark, tmp_path):
    table = PartitionedTable(spark, str(tmp_path / "t"), buckets=16)
    assert put(table, frame(spark, *[(f"k{i}", f"n{i}", i) for i in range(200)])) == 0
    first, before = table.commit(), files_of(tmp_path)
    assert put(table, frame(spark, ("k7", "old", 1), ("k7", "new", 2), ("fresh", "f", 3))) == 1
    second = table.commit()
    touched = {str(r["b"]) for r in frame(spark, ("k7", "", 0), ("fresh", "", 0)).select(bucket_of("npc_id", 16).alias("b")).collect()}
    assert {b for b in second.folders if second.folders[b] != first.folders.get(b)} == touched
    after = files_of(tmp_path)
    assert before.items() <= after.items()  # nothing is written in place
    assert {p.split("bucket=")[1].split("/")[0] for p in after.keys() - before.keys()} == touched
    now = rows_of(table)
    assert len(now) == 201 and now[7] == ("k7", "new", 8) and now[-1] == ("fresh", "f", 203)
    assert rows_of(table, 0) == [(f"k{i}", f"n{i}", i + 1) for i in range(200)]  # older versions stay readable


def test_removals_empty_partitions_and_vacuum(spark, tmp_path):
    table = PartitionedTable(spark, str(tmp_path / "t"), buckets=4)
    put(table, frame(spark, *[(f"k{i}", "n", i) for i in range(40)]))
    keys = frame(spark, *[(f"k{i}", "n", i) for i in range(40)])
    gone = keys.where(bucket_of("npc_id", 4) == 2)
    assert table.remove(gone) == 1
    assert "2" not in table.commit().folders and table.read().count() == 40 - gone.count()
    assert table.remove(frame(spark, ("nobody", "", 0)).where("at < 0")) == 2  # no ids: all folders stay
    assert table.commit().folders == table.commit(1).folders
    assert table.vacuum(keep=1) == []  # too new to go
    assert table.vacuum(keep=1, older_than=-5) and table.versions() == [2]
    assert table.read().count() == 40 - gone.count()
    table.remove(keys)
    assert table.read().count() == 0 and table.commit().folders == {}
    assert put(table, frame(spark, ("k1", "again", 1))) == 4 and rows_of(table) == [("k1", "again", 41)]


def test_only_one_writer_takes_a_version(spark, tmp_path, monkeypatch):
    table = PartitionedTable(spark, str(tmp_path / "t"), buckets=4)
    put(table, frame(spark, ("a", "one", 1)))
    base = table.commit()
    other = PartitionedTable(spark, str(tmp_path / "t"))
    put(other, frame(spark, ("a", "two", 1)))
    monkeypatch.setattr(table, "commit", lambda version=None: base)  # has not seen the other's version
    with pytest.raises(CommitConflict):
        put(table, frame(spark, ("a", "three", 1)))
    assert rows_of(other) == [("a", "two", 1)] and other.versions() == [0, 1]
    with pytest.raises(ValueError):
        PartitionedTable(spark, str(tmp_path / "none")).read()


def test_epochs_apply_once(spark, tmp_path):
    table = PartitionedTable(spark, str(tmp_path / "t"), buckets=4)
    assert put(table, frame(spark, ("a", "one", 1)), stream="s", epoch=0) == 0
    assert put(table, frame(spark, ("a", "lost", 1)), stream="s", epoch=0) is None
    assert put(table, frame(spark, ("a", "two", 1)), stream="other", epoch=0) == 1
    assert table.remove(frame(spark, ("a", "", 1)), stream="s", epoch=0) is None
    assert table.commit().applied == {"s": 0, "other": 0} and rows_of(table) == [("a", "two", 1)]


def test_stream_restarts_and_replays(spark, tmp_path):
    source, path, checkpoint = (str(tmp_path / n) for n in ("in", "table", "cp"))

    def run():
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
        upsert_stream(stream, path, checkpoint, "at", buckets=8).awaitTermination()

    def add(*rows):
        frame(spark, *rows).coalesce(1).write.mode("append").parquet(source)

    table = PartitionedTable(spark, path)
    add(("a", "one", 1), ("b", "two", 2), ("a", "uno", 3))
    run()
    add(("a", "three", 3), ("c", "four", 4), (None, "id from the name", 5))
    run()
    want = rows_of(table)
    assert [r[:2] for r in want[:3]] == [("a", "three"), ("b", "two"), ("c", "four")] and len(want) == 4
    assert table.versions() == [0, 1] and table.commit().applied == {checkpoint: 1}
    # the process died after the table's commit and before the stream's
    for name in ("1", ".1.crc"):
        (Path(checkpoint) / "commits" / name).unlink(missing_ok=True)
    run()
    assert table.versions() == [0, 1] and rows_of(table) == want
    # the same files under another checkpoint are another stream
    again = spark.read.schema(SCHEMA).parquet(source).where("name = 'three'")
    assert apply_batch(again, 0, path, "at", "second") == 2 and rows_of(table) == want


def test_commits_are_plain(spark, tmp_path):
    table = PartitionedTable(spark, str(tmp_path / "t"), buckets=4)
    put(table, frame(spark, ("a", "one", 1), ("b", "x", 2)))
    names = [p.name for p in (tmp_path / "t" / "commits").iterdir() if not p.name.endswith(".crc")]
    assert names == ["0000000000.json"]  # no half-written file is left beside it
    commit = json.loads((tmp_path / "t" / "commits" / names[0]).read_text())
    assert commit["top"] == 2 and set(commit["folders"]) == {
        str(r["b"]) for r in frame(spark, ("a", "", 0), ("b", "", 0)).select(bucket_of(F.col("npc_id"), 4).alias("b")).collect()}

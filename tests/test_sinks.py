from taleweave.operators import registry as G
from taleweave.sources import readers, writers


def test_json_line_sinks(spark, tmp_path):
    rows = [("train", "A", "a\nb", "ROMEO"), ("test", "B", "c", "VERSE")]
    examples = spark.createDataFrame(rows, "split string, task string, text string, label string")
    writers.write_examples(examples, str(tmp_path / "examples"))
    back = spark.read.json(str(tmp_path / "examples"))
    assert sorted((r["split"], r["task"], r["text"], r["label"]) for r in back.collect()) == sorted(rows)

    records = G.conform(spark.createDataFrame([("b", "Two", 2), ("a", "One", 1)], "npc_id string, name string, seq long"))
    writers.write_registry_json(records, str(tmp_path / "registry"))
    assert sorted(r["npc_id"] for r in spark.read.json(str(tmp_path / "registry")).collect()) == ["a", "b"]


def test_absent_sources_are_empty(spark, tmp_path):
    assert readers.read_runs(spark, str(tmp_path / "none")).count() == 0
    assert readers.list_files(spark, [str(tmp_path / "none")]).count() == 0

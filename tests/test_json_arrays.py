"""Large JSON arrays, read in pieces."""

import json
import random

import pytest

from taleweave.sources import readers
from taleweave.sources.json_arrays import read_json_array


def record(rng, i):
    text = "".join(rng.choice(['{', '}', '"', "\\", "[", "]", ",", "é", "a", "\n"]) for _ in range(rng.randint(0, 12)))
    return {"npc_id": f"k{i % 40}", "name": text, "HP": rng.choice([None, i]), "notes": [text, "x"][: rng.randint(0, 2)],
            "extra_traits": {text or "k": "v}"} if i % 3 else {}}


@pytest.mark.parametrize("indent", [None, 2])
@pytest.mark.parametrize("envelope", [False, True])
def test_records_of_large_arrays(spark, tmp_path, indent, envelope):
    rng = random.Random(7)
    want = {}
    for f, n in enumerate((60, 1, 0)):
        rows = [record(rng, i) for i in range(n)]
        want[f"{f}.json"] = rows
        whole = {"version": {"of": 1}, "npcs": rows} if envelope else rows
        (tmp_path / f"{f}.json").write_text(json.dumps(whole, indent=indent, ensure_ascii=bool(f)) + ("\n" if f else ""))
    for name, text in (("cut", '[{"npc_id": "a"}, {"npc_id": '), ("odd", '[{"npc_id": "a"}, {"npc_id" 5}]'), ("text", "hello } there"),
                       ("empty", ""), ("after", '[{"npc_id": "a"}] and more')):
        (tmp_path / f"{name}.json").write_text(text)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "512")  # pieces of a file in many tasks
    try:
        schema = readers._shown_schema()
        rows = read_json_array(spark, str(tmp_path / "*.json"), schema).orderBy("path", "n").collect()
        stored = readers.read_registry_arrays(spark, str(tmp_path / "*.json")).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    got = {}
    for r in rows:
        own = got.setdefault(r["path"].rsplit("/", 1)[1], [])
        assert r["n"] == len(own)
        own.append(r["record"])
    assert set(got) == {n for n, r in want.items() if r}
    for name, records in got.items():
        assert [(r["npc_id"], r["name"], r["HP"], r["notes"], r["extra_traits"]) for r in records] == [
            (w["npc_id"], w["name"], w["HP"], w["notes"], w["extra_traits"]) for w in want[name]]
    one = readers.read_registry(spark, str(tmp_path / "0.json")).count()
    assert len(stored) == one == 40

"""Mixing, shards, fingerprints and exact search."""

import hashlib
import math
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from taleweave.llm import fingerprints, mixing, sharding, topk
from taleweave.llm.common import whole_text


def test_exponent_meets_its_target():
    shares = [0.6, 0.3, 0.1]
    a = mixing.solve_exponent(shares, target_entropy=0.95)
    w = mixing.temper(shares, a)
    assert mixing.entropy(w) == pytest.approx(0.95 * math.log(3), abs=1e-6)
    b = mixing.solve_exponent(shares, max_repeats=1.5)
    assert max(mixing.repeats(shares, b)) == pytest.approx(1.5, abs=1e-6)
    assert mixing.solve_exponent(shares, 0.95, 1.5) == max(a, b)  # the limit wins
    assert mixing.solve_exponent(shares) == 1.0 and mixing.solve_exponent([0.5, 0.5], 0.95) == 1.0


@pytest.mark.parametrize("block", [1, 7, 1000])
def test_mix_realises_its_budgets(make, block):
    rng = random.Random(3)
    rows = [(i, "w " * rng.randint(0, 30)) for i in range(400)]
    docs = make(rows, source=lambda i: None if i % 50 == 0 else "big" if i % 3 else f"s{i % 2}")
    counted = docs.withColumn("n_tokens", mixing.count_tokens()).withColumn("epoch", F.lit("clash"))
    plan = {p["source"]: p for p in mixing.plan_mix(counted, 0.99, 3.0)}
    mixed = mixing.mix_sources(counted, 0.99, 3.0, block_docs=block).collect()
    assert {r["doc_id"] for r in mixed if r["epoch"] == 0} == set(range(400))
    assert len({(r["doc_id"], r["epoch"]) for r in mixed}) == len(mixed)
    by_source = defaultdict(list)
    for r in mixed:
        by_source[r["source"]].append(r)
    longest = 30
    for name, p in plan.items():
        used = sum(r["n_tokens"] for r in by_source[name])
        assert p["budget"] <= used < p["budget"] + longest or (p["rest"] == 0 and used == p["budget"])
        ordered = sorted(by_source[name], key=lambda r: r["mix_position"])
        assert all(0 <= r["mix_position"] < 1 for r in ordered if p["budget"])
        epochs = [r["epoch"] for r in ordered if r["n_tokens"]]
        assert epochs == sorted(epochs)
    assert max(p["budget"] / p["tokens"] for p in plan.values() if p["tokens"]) <= 3.01


def test_mix_of_odd_tables(make, odd):
    docs = make(odd).withColumn("n_tokens", mixing.count_tokens())
    assert mixing.mix_sources(docs).count() == len(odd)  # one source: each row once
    assert mixing.mix_sources(docs.limit(0)).count() == 0
    assert mixing.mix_sources(make([(1, None), (2, "")]).withColumn("n_tokens", mixing.count_tokens())).count() == 2


def shards_of(docs):
    narrow = docs.select("doc_id", sharding.text_bytes().alias("size"), F.crc32(whole_text()).alias("crc"),
                         sharding.text_group().alias("group"))
    return sharding.assign_shards(narrow).collect()


def check_shards(rows, got, limit):
    assert sorted((str(i), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows) == sorted(
        (str(r["doc_id"]), r["size"], r["crc"]) for r in got)
    slots, sizes, groups = defaultdict(list), defaultdict(int), defaultdict(set)
    for r in got:
        slots[r["shard"]].append(r["slot"])
        sizes[r["shard"]] += r["size"]
        groups[r["crc"]].add(r["shard"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(sizes.values()) - min(sizes.get(s, 0) for s in range(8)) <= limit
    return groups


def test_shards_are_even_and_keep_groups(make):
    rng = random.Random(5)
    rows = [(i, "x" * rng.randint(0, 60) + str(i)) for i in range(3000)] + [(9000 + i, "pair") for i in range(2)]
    groups = check_shards(rows, shards_of(make(rows)), 600)
    assert all(len(g) == 1 for g in groups.values())


def test_a_heavy_group_is_split(make):
    rows = [(i, "the same words again") for i in range(1000)] + [(i, f"text {i}") for i in range(1000, 3000)]
    groups = check_shards(rows, shards_of(make(rows)), 200)
    assert len(groups[zlib.crc32(b"the same words again")]) > 1


def test_shards_of_odd_tables(make, odd):
    check_shards(odd, shards_of(make(odd)), 10 ** 6)
    assert shards_of(make([])) == []
    check_shards([(None, None)] * 40, shards_of(make([(None, None)] * 40)), 3)


def test_written_shards_hold_every_record(make, odd, tmp_path, spark):
    sharding.write_shards(make(odd), str(tmp_path / "s"))
    back = spark.read.parquet(str(tmp_path / "s"))
    assert sorted((str(r["doc_id"]), r["text"] or "") for r in back.collect()) == sorted((str(i), t or "") for i, t in odd)


def test_fingerprints_and_edits(make, monkeypatch):
    monkeypatch.setattr(fingerprints, "RANGE_ROWS", 40)
    rng = random.Random(2)
    rows = [(i * 3, " ".join(f"w{rng.randint(0, 150)}" for _ in range(rng.randint(0, 80)))) for i in range(200)]
    rows += [(7, rows[5][1]), (8, None), (10, ""), (11, "é" * 7), (13, "zz " * 5000)]
    got = {r["doc_id"]: r for r in fingerprints.fingerprint_edits(make(rows).withColumn("place", F.lit(1))).collect()}
    ordered = sorted((i, t or "") for i, t in rows)
    assert set(got) == {i for i, _ in ordered}
    for (i, text), (_, other) in zip(ordered, ordered[1:] + ordered[:1]):
        half = len(text) // 2
        edited = text[:len(text) - half] + other[:half]
        r = got[i]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        if edited == text:
            assert r["fingerprint"] == r["edited_fingerprint"] and r["near_edited"] == 1
    assert got[7]["fingerprint"] == got[15]["fingerprint"]
    mean = lambda c: sum(r[c] for r in got.values()) / len(got)
    assert mean("near_edited") > 2 * mean("near_next")


def test_fingerprints_against_brute_force(make, spark):
    rows = [(i, " ".join(f"t{(i * j) % 23}" for j in range(i % 9))) for i in range(80)]
    n = len(rows)
    df = defaultdict(int)
    for _, t in rows:
        for w in set(t.split()):
            df[w] += 1
    band = sorted(w for w, c in df.items() if fingerprints.LOW_IDF <= math.log(n / c) <= fingerprints.HIGH_IDF)
    words = spark.createDataFrame([(w,) for w in df], "w string").select("w", F.xxhash64("w").alias("code"))
    codes = {r["w"]: r["code"] for r in words.collect()}
    held = {r["code"] for r in fingerprints.lexicon(make(rows)).collect()}
    assert held == {codes[w] for w in band}
    got = {r["doc_id"]: r["fingerprint"] for r in fingerprints.fingerprint_edits(make(rows)).collect()}
    same = defaultdict(set)
    for i, t in rows:
        inside = frozenset(set(t.split()) & set(band)) or (None, frozenset(t.split()))
        same[inside].add(got[i])
    assert all(len(s) == 1 for s in same.values()) and len({next(iter(s)) for s in same.values()}) == len(same)


def test_fingerprints_of_odd_tables(make, odd):
    assert fingerprints.fingerprint_edits(make(odd)).count() == len(odd)
    assert fingerprints.fingerprint_edits(make([])).count() == 0
    one = fingerprints.fingerprint_edits(make([(4, "alone here")])).first()
    assert one["near_next"] == 1.0


def brute_top(rows, k, wanted):
    vectors = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            vectors.setdefault(i, []).append([math.floor(256 * x) for x in v])
    out = []
    for q in sorted(vectors):
        if wanted(q):
            scored = sorted((-sum(a * b for a, b in zip(x, y)), c) for x in {tuple(v) for v in vectors[q]}
                            for c, ys in vectors.items() if c != q for y in {tuple(v) for v in ys})
            out += [(q, n + 1, c, -s) for n, (s, c) in enumerate(scored[:k])]
    return out


@pytest.mark.parametrize("blocks", [(4096, 256), (16, 3)])
def test_exact_search(spark, monkeypatch, blocks):
    monkeypatch.setattr(topk, "BLOCK_ROWS", blocks[0])
    monkeypatch.setattr(topk, "QUERY_ROWS", blocks[1])
    rng = random.Random(4)
    rows = [(i, [rng.choice([0.0, 0.0, 0.25, -0.1, rng.random()]) for _ in range(6)]) for i in range(150)]
    rows += [(200 + i, list(rows[0][1])) for i in range(10)]  # ties
    rows += [(300, None), (301, [0.1, None]), (302, [float("nan")]), (303, [float("inf"), 1.0]), (None, [1.0]), (304, []),
             (305, [0.5]), (306, [0.1] * 9), rows[10]]
    df = spark.createDataFrame([(i, v, 7) for i, v in rows], "vec_id long, embedding array<double>, score int")
    got = topk.top_k(df.where("vec_id % 10 = 0"), df, 5).orderBy("query_id", "rank").collect()
    assert [tuple(r) for r in got] == brute_top(rows, 5, lambda q: q % 10 == 0)


def test_search_of_few_and_none(spark):
    df = spark.createDataFrame([(0, [1.0]), (50, [2.0]), (51, [0.0])], "vec_id long, embedding array<float>")
    got = topk.top_k(df.where("vec_id % 50 = 0"), df, 5).orderBy("query_id", "rank").collect()
    assert [tuple(r) for r in got] == [(0, 1, 50, 131072), (0, 2, 51, 0), (50, 1, 0, 131072), (50, 2, 51, 0)]
    assert topk.top_k(df.limit(0), df, 5).count() == 0 and topk.top_k(df.limit(1), df.limit(0), 5).count() == 0


@pytest.mark.parametrize("tasks", [1, 3, 256])
def test_search_copies_no_query_blocks(spark, monkeypatch, tasks):
    """Query blocks go to no broadcast, whatever the number of their files."""
    rng = random.Random(5)
    rows = [(i, [rng.choice([0.0, rng.uniform(-1, 1)]), rng.random(), 1.0]) for i in range(400)] + [(0, [0.5, 0.5, 0.5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for name, value in {"BLOCK_ROWS": 50, "QUERY_ROWS": 7, "TASKS": tasks, "TASK_BLOCKS": 2, "SCORES": 150}.items():
        monkeypatch.setattr(topk, name, value, raising=False)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so there are several files
    try:
        found = topk.top_k(df.where("vec_id % 10 = 0"), df, 5)
        got = found.orderBy("query_id", "rank").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
    assert [tuple(r) for r in got] == brute_top(rows, 5, lambda q: q % 10 == 0)


@pytest.mark.parametrize("partitions", [1, 211])
def test_search_blocks_follow_from_rows(spark, monkeypatch, partitions):
    rng = random.Random(4)
    rows = [(i, [rng.uniform(-1, 1) * 300 ** rng.randint(0, 1) for _ in range(rng.choice([3, 5]))]) for i in range(500)]
    df = spark.createDataFrame(rows * 2, "vec_id long, embedding array<double>").repartition(partitions)
    monkeypatch.setattr(topk, "BLOCK_ROWS", 100)
    monkeypatch.setattr(topk, "QUERY_ROWS", 4)
    blocks, count = topk.blocks_of(df.select(F.col("vec_id").alias("id"), topk.whole_weights("embedding", 256).alias("w")), 100)
    assert count == 5 and blocks.count() == 5
    got = topk.top_k(df.where("vec_id % 50 = 0"), df, 5).orderBy("query_id", "rank").collect()
    assert [tuple(r) for r in got] == brute_top(rows, 5, lambda q: q % 50 == 0)

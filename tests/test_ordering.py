import random

import pytest
from pyspark.sql import functions as F

from taleweave.operators import corpus as C
from taleweave.operators import experiments as P
from taleweave.operators import ordering as O


@pytest.fixture(scope="module")
def skewed(spark):
    """One key holds most rows; order values repeat within the tie column."""
    rng = random.Random(1)
    rows = [(rng.choice([0, 0, 0, 0, 1, 2, 3]), rng.randint(0, 4000), i, rng.randint(0, 9)) for i in range(6000)]
    return rows, spark.createDataFrame(rows, "k long, t long, id long, w long").repartition(5).cache()


@pytest.mark.parametrize("keys", [[], ["k"]])
def test_running_total(skewed, keys):
    rows, df = skewed
    got = {r["id"]: r["start"] for r in O.running_total(df, ["t", "id"], F.col("w"), keys).collect()}
    sums, want = {}, {}
    for k, t, i, w in sorted(rows, key=lambda r: (r[1], r[2])):
        group = k if keys else None
        want[i] = sums.get(group, 0)
        sums[group] = want[i] + w
    assert got == want


def test_previous_and_median(skewed):
    rows, df = skewed
    got = {r["id"]: r["previous"] for r in O.previous_value(df, ["t", "id"], "w", "k").collect()}
    last, want = {}, {}
    for k, t, i, w in sorted(rows, key=lambda r: (r[1], r[2])):
        want[i], last[k] = last.get(k), w
    assert got == want
    import statistics

    medians = {r["k"]: r["median"] for r in O.exact_median(df, "t", "k").collect()}
    assert medians == {k: statistics.median([r[1] for r in rows if r[0] == k]) for k in {r[0] for r in rows}}


@pytest.mark.parametrize("leaf", [50, 100_000])
def test_cuts(skewed, leaf):
    rows, df = skewed
    total = sum(r[3] for r in rows)
    wanted = [0, 1, total // 3, total // 2, total - 1, total, total + 5]
    ordered, start, want = sorted(rows, key=lambda r: (r[1], r[2])), 0, {}
    for k, t, i, w in ordered:
        for p in wanted:
            if start <= p < start + w:
                want[p] = ((t, i), p - start)
        start += w
    for p, cut in zip(wanted, O.find_cuts(df, ["t", "id"], F.col("w"), wanted, leaf_rows=leaf)):
        assert (cut.key, cut.offset) == want.get(p, (None, 0))


def test_first_n_beyond_the_builtin_limit(skewed):
    rows, df = skewed
    got = sorted(r["id"] for r in O.first_n(df, "k", ["t", "id"], 1500).collect())
    want = []
    for k in {r[0] for r in rows}:
        want += [r[2] for r in sorted((r for r in rows if r[0] == k), key=lambda r: (r[1], r[2]))[:1500]]
    assert got == sorted(want)


def test_hot_key_is_cut_before_the_shuffle(skewed):
    _, df = skewed
    plan = O.last_n(df, "k", ["t", "id"], 24)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_ema_over_many_blocks(spark):
    rng = random.Random(2)
    rows = [(k, i, rng.random()) for k, n in ((1, 3500), (2, 1)) for i in range(n)]
    df = spark.createDataFrame(rows, "run long, step long, v double")
    got = {(r["run"], r["step"]): r["ema"] for r in P.ema(df, "v", "step").collect()}
    state = {}
    for k, i, v in rows:
        state[k] = v if k not in state else 0.9 * state[k] + 0.1 * v
        assert got[k, i] == pytest.approx(state[k], rel=1e-9)


def test_split_and_encode(spark):
    docs = spark.createDataFrame([(i, "abc déf" * (i % 4) + "\U0001f600") for i in range(40)], "doc_id long, text string")
    vocab = C.char_vocab(docs)
    tokens = C.encode_split(docs, vocab)
    whole = "".join(r["text"] for r in docs.orderBy("doc_id").collect())
    ids = {c: i for i, c in enumerate(sorted(set(whole)))}
    cut = int(len(whole) * 0.9)
    for split, text in (("train", whole[:cut]), ("val", whole[cut:])):
        rows = tokens.where(F.col("split") == split).orderBy("doc_id", "start").collect()
        assert [i for r in rows for i in r["ids"]] == [ids[c] for c in text]
    decoded = tokens.select(C.decode("ids", vocab).alias("t"), "doc_id", "start").orderBy("doc_id", "start").collect()
    assert "".join(r["t"] for r in decoded) == whole
    small = C.prefix_fraction(tokens.where("split = 'train'"), ["doc_id", "start"], 0.25)
    assert small.agg(F.sum(F.size("ids"))).first()[0] == int(cut * 0.25)


def test_unknown_characters(spark):
    vocab = C.char_vocab(spark.createDataFrame([(1, "ab")], "doc_id long, text string"))
    df = spark.createDataFrame([("azb",)], "t string")
    assert df.select(C.encode("t", vocab, "skip").alias("v")).first()["v"] == [0, 1]
    with pytest.raises(Exception, match="outside the vocabulary"):
        df.select(C.encode("t", vocab).alias("v")).collect()


def test_blocks(spark):
    df = spark.createDataFrame([(1, list(range(10))), (2, [1, 2])], "doc_id long, ids array<int>")
    rows = C.make_blocks(df, 4, "doc_id", stride=3).orderBy("block").collect()
    assert [(r["x"], r["y"]) for r in rows] == [
        ([0, 1, 2, 3], [1, 2, 3, 4]), ([3, 4, 5, 6], [4, 5, 6, 7]), ([6, 7, 8, 9], [7, 8, 9, 1])]


def test_base_ids_stay(spark):
    base = spark.createDataFrame([("b", 0), ("a", 1)], "token string, id int")
    more = spark.createDataFrame([("a",), ("z",), ("c",)], "token string")
    assert {r["token"]: r["id"] for r in C.extend_vocab(base, more).collect()} == {"b": 0, "a": 1, "c": 2, "z": 3}


def test_elapsed_frontier_and_parameters(spark):
    t = spark.createDataFrame([("a", 0), ("b", 10), ("c", 14), ("d", 34)], "label string, m int") \
        .withColumn("ts", F.timestamp_seconds(F.col("m") * 60))
    got = {r["label"]: r["elapsed_minutes"] for r in P.recover_elapsed(t, "label", "ts").collect()}
    assert got == {"a": 10.0, "b": 10.0, "c": 4.0, "d": 20.0}
    one = P.recover_elapsed(t.where("label = 'a'"), "label", "ts").collect()
    assert [r["elapsed_minutes"] for r in one] == [None]
    runs = spark.createDataFrame([(1, 2.0, 0), (1, 1.9, 1), (2, 2.1, 2), (3, 1.5, 3)], "flops long, val double, i int")
    best = P.frontier(runs, "flops", "val", "i").orderBy("flops").collect()
    assert [(r["val"], r["best_so_far"]) for r in best] == [(1.9, 1.9), (2.1, 1.9), (1.5, 1.5)]
    grid = P.model_grid(spark).withColumn("p", P.param_count(F.lit(65), F.lit(256), "n_layer", "n_embd"))
    assert [r["p"] for r in grid.orderBy("model_order").collect()] == [119168, 828672, 10745088, 25338880]
    lora = P.lora_params("n_layer", "n_embd", F.lit(4)).alias("p")
    assert grid.where("model_size = 'M'").select(lora).first()[0] == 36864


def test_histories(spark):
    runs = spark.createDataFrame(
        [("a", [0, 250, 500], [4.0, 2.0, 1.0], [4.0, 1.5, 1.8], None), ("b", [], [], [], None)],
        "run string, steps array<int>, train_loss array<double>, val_loss array<double>, elapsed_minutes double")
    rows = {r["run"]: r for r in P.history_summary(runs).collect()}
    assert (rows["a"]["final_val"], rows["a"]["best_val"], round(rows["a"]["gap"], 9)) == (1.8, 1.5, 0.8)
    assert rows["b"]["final_val"] is None and rows["b"]["gap"] is None
    assert P.run_steps(runs).count() == 3

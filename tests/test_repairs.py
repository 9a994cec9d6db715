"""Rows that once got lost: null keys, ties, odd responses, empty versions, failing prompts."""

import math

import pandas as pd
import pytest
from pyspark.sql import functions as F

from taleweave.functions.records import STORED_SCHEMA
from taleweave.operators import corpus as C
from taleweave.operators import evaluate as E
from taleweave.operators import landing as L
from taleweave.operators import matching as M
from taleweave.operators import ordering as O
from taleweave.operators import registry as G
from taleweave.plans import corpus_queries
from taleweave.sources import readers, writers


@pytest.mark.parametrize("n", [1000, 2000])  # below and above one bucket's sample
def test_null_keys_and_null_order(spark, n):
    rows = [(None if i % 10 == 0 else i % 3, None if i == 7 else i, i) for i in range(n)]
    df = spark.createDataFrame(rows, "k int, t int, id int")
    ordered = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0))
    sums, last, want, lag = {}, {}, {}, {}
    for k, t, i in ordered:
        want[i], lag[i] = sums.get(k, 0) + 1, last.get(k)
        sums[k], last[k] = want[i], i
    assert {r["id"]: r["ordinal"] for r in O.ordinal(df, "t", "k").collect()} == want
    assert {r["id"]: r["previous"] for r in O.previous_value(df, "t", "id", "k").collect()} == lag
    medians = {r["k"]: r["median"] for r in O.exact_median(df, "id", "k").collect()}
    assert medians == {k: float(pd.Series([r[2] for r in rows if r[0] == k]).median()) for k in (None, 0, 1, 2)}


def test_cuts_with_equal_and_null_order(spark):
    docs = spark.createDataFrame([(1, "ab"), (1, "cdefghij"), (None, "xyz")], "doc_id int, text string")
    cut = C.prefix_splits(docs, "doc_id", [0.5]).collect()
    before = sum(len(r["text"]) for r in cut if r["piece"] == 0)
    assert (before, sum(len(r["text"]) for r in cut)) == (6, 13)
    assert [r["piece"] for r in cut if r["doc_id"] is None] == [0]  # null comes first


def test_cuts_of_one_key_end(spark):
    df = spark.range(3000).select(F.lit(1).alias("k"), F.lit(1).alias("w"), F.col("id").alias("other"))
    cut = O.find_cuts(df, "k", F.col("w"), [1500], leaf_rows=50)[0]
    assert (cut.key, cut.offset) == ((1,), 0)
    done = O.pieces(df, "k", F.col("w"), [cut]).groupBy("piece").count().collect()
    assert sorted((r["piece"], r["count"]) for r in done) == [(0, 1500), (1, 1500)]
    # rows without any difference are cut by their number
    same = spark.range(3000).select(F.lit(1).alias("k"), F.lit(4).alias("w"))
    cuts = O.find_cuts(same, "k", F.col("w"), [6001, 6003, 9000], leaf_rows=50)
    assert [(c.key, c.offset, c.copies) for c in cuts] == [((1,), 1, 3000), ((1,), 3, 3000), ((1,), 0, 3000)]
    done = O.pieces(same, "k", F.col("w"), cuts).groupBy("piece").agg(
        F.sum(F.col("piece_to") - F.col("piece_from")).alias("w"), F.count("*").alias("n")).collect()
    assert {r["piece"]: (r["w"], r["n"]) for r in done} == {0: (6001, 1501), 1: (2, 1), 2: (2997, 750), 3: (3000, 750)}


def test_split_of_a_doubled_table(spark):
    rows = [(i % 5, "abcdefghij"[: i % 7]) for i in range(40)] + [(None, "zz")] * 9
    docs = spark.createDataFrame(rows * 2, "doc_id int, text string")
    vocab = C.char_vocab(docs)
    total = sum(len(t) for _, t in rows * 2)
    for fraction in (0.05, 0.5, 0.9):
        split = C.encode_split(docs, vocab, "doc_id", fraction).collect()
        train = sum(len(r["ids"]) for r in split if r["split"] == "train")
        assert train == math.floor(total * fraction) and sum(len(r["ids"]) for r in split) == total
        top = max((r["doc_id"] is not None, r["doc_id"] or 0) for r in split if r["split"] == "train")
        low = min((r["doc_id"] is not None, r["doc_id"] or 0) for r in split if r["split"] == "val")
        assert top <= low


def test_a_split_reads_texts_twice(spark, tmp_path):
    """One scan for the sums, one for the split; the descent reads sums only."""
    reads = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def seen(text):
        reads.add(1)
        return text

    docs = spark.range(500).select(F.col("id").alias("doc_id"), F.lit("some text").alias("text"))
    docs = docs.withColumn("text", seen.asNondeterministic()("text"))
    C.split_position(docs, "doc_id", 0.9).write.format("noop").mode("overwrite").save()
    assert reads.value <= 2 * 500


def test_responses_keep_everything(spark):
    texts = [
        '{"name": "Ann", "hp": 9, "extra_traits": "{oops"}',
        '{"class": "Wizard", "primary_class": "Rogue", "hp": 9, "HP": "10"}',
        '{"name": "[Red] Bob", "tags": ["a", "b"]}',
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    terms = spark.createDataFrame([("primary_class", "Rogue"), ("primary_class", "Wizard")], "field string, term string")
    landed, rejects = L.land_responses(docs, terms)
    got = {(r["doc_id"], r["field"]): r["value"] for r in landed.collect()}
    assert got[0, "name"] == "Ann" and got[0, "hp"] == "9"
    assert (got[1, "primary_class"], got[1, "hp"]) == ("Rogue", "10")
    assert got[2, "name"] == "Red Bob" and got[2, "trait:tags"] == "a, b"
    assert rejects.count() == 0


def test_an_empty_version_is_the_newest(spark, tmp_path):
    path = str(tmp_path / "registry")
    records = G.conform(spark.createDataFrame([("a", "Ann", 1)], "npc_id string, name string, seq long"))
    assert readers.read_registry_table(spark, path).schema == STORED_SCHEMA
    writers.write_registry(records, path)
    assert writers.write_registry(records.limit(0), path) == 1
    assert readers.read_registry_table(spark, path).count() == 0
    assert writers.write_registry(records, path) == 2
    assert readers.read_registry_table(spark, path).count() == 1


def test_one_failing_prompt_fails_alone(spark):
    def scorer(prompts):
        if (prompts == "bad 7").any():
            raise RuntimeError("no")
        return prompts + "!"

    df = spark.createDataFrame([(i, f"{'bad' if i == 7 else 'ok'} {i}") for i in range(100)], "id int, prompt string").coalesce(1)
    rows = {r["id"]: r for r in E.score(df, scorer, error="problem").collect()}
    assert [i for i, r in rows.items() if r["generated"] is None] == [7]
    assert rows[7]["problem"] == "RuntimeError: no" and rows[3]["generated"] == "ok 3!"


def test_edits_of_unknown_ids_are_rejected(spark):
    records = G.conform(spark.createDataFrame([("a", "Ann", 1)], "npc_id string, name string, seq long"))
    edits = spark.createDataFrame([("a", 1, "goal", "gold"), ("b", 2, "goal", "fame")], "npc_id string, seq long, field string, value string")
    done, rejects = G.apply_edits(records, edits)
    assert [r["goal"] for r in done.collect()] == ["gold"]
    assert [(r["npc_id"], r["reason"]) for r in rejects.collect()] == [("b", "unknown id")]


def test_long_texts_match_in_linear_time(spark):
    text = " ".join(f"word{i % 977}" for i in range(8000)) + " a half-elf with a long sword"
    docs = spark.createDataFrame([(i, text) for i in range(4)], "doc_id long, text string")
    terms = spark.createDataFrame([("race", "Half-Elf"), ("race", "Elf"), ("weapon", "Long Sword"), ("race", "word5 word7")], "field string, term string")
    got = {(r["doc_id"], r["field"]): r["value"] for r in M.match_dictionary(docs, terms).collect()}
    assert got == {(i, f): v for i in range(4) for f, v in (("race", "Half-Elf"), ("weapon", "Long Sword"))}


def test_blocks_cross_documents(spark):
    sizes, at, rows, flat = [3, 0, 10, 1, 1, 40, 2], 0, [], []
    for i, n in enumerate(sizes):
        rows.append((i, list(range(at, at + n))))
        flat += rows[-1][1]
        at += n
    tokens = spark.createDataFrame([(r[0], "train", r[1]) for r in rows], "doc_id int, split string, ids array<int>")
    got = sorted((r["block"], r["x"], r["y"]) for r in C.make_blocks(tokens, 4, "doc_id", "split").collect())
    assert got == [(b, flat[4 * b:4 * b + 4], flat[4 * b + 1:4 * b + 5]) for b in range((len(flat) - 1) // 4)]
    drawn = C.draw_blocks(tokens, 4, 50, 1, "doc_id", "split").collect()
    assert len(drawn) == 50 and all(
        (r["x"], r["y"]) == (flat[r["start"]:r["start"] + 4], flat[r["start"] + 1:r["start"] + 5]) for r in drawn)
    assert max(r["start"] for r in drawn) <= len(flat) - 5


def test_prefix_fractions_with_equal_ids_and_lengths(spark, tmp_path):
    rows = [(None, "abcde")] * 3 + [(None, "vwxyz")] * 4 + [(7, "pqrst")] * 8 + [(8, "x")]
    folder = str(tmp_path)
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{folder}/documents.parquet")
    got = {r["fraction"]: tuple(r)[1:] for r in corpus_queries.prefix_fractions(spark, folder).collect()}
    train, sizes, want = math.floor(76 * 0.9), [5] * 15 + [1], {}
    for f in (0.1, 0.25, 0.5, 1.0):
        end = max(1, math.floor(train * f))
        documents = sum(sum(sizes[:i]) < end for i in range(len(sizes)))
        want[f] = (documents, end, 7 if documents > 7 else None)
    assert got == want

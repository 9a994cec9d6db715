from collections import Counter

from pyspark.sql import functions as F

from taleweave.operators import dialogue as D
from taleweave.operators import ngram as N
from taleweave.operators import subword as B


def test_stream_history_equals_batch(spark, tmp_path):
    from taleweave.streaming import history as H

    rows = [(c, t, "user", f"c{c} t{t}") for t in range(9) for c in (1, 2, 3) if t < 9 - c]
    source = str(tmp_path / "in")
    for part in range(3):
        spark.createDataFrame([r for r in rows if r[1] // 3 == part], H.TURN_SCHEMA) \
            .coalesce(1).write.mode("append").parquet(source)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", H.ROCKSDB)
    stream = spark.readStream.schema(H.TURN_SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
    run = H.bounded_history(stream, 4).writeStream.format("parquet").option("path", str(tmp_path / "out")) \
        .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    run.awaitTermination()
    out = spark.read.schema(H.OUT_SCHEMA).parquet(str(tmp_path / "out"))
    newest = out.join(out.groupBy("conv_id").agg(F.max("version").alias("version")), ["conv_id", "version"])
    got = sorted((r["conv_id"], r["turn"], r["text"]) for r in newest.collect())
    batch = D.bounded_history(spark.createDataFrame(rows, H.TURN_SCHEMA), 4).select("conv_id", F.explode("history.content").alias("text"))
    assert sorted((c, x) for c, _, x in got) == sorted((r["conv_id"], r["text"]) for r in batch.collect())


def brute_merges(words, steps):
    parts = {w: [f"{b:02X}" for b in w.encode()] for w in words}
    merges = []
    for _ in range(steps):
        pairs = Counter()
        for w, n in words.items():
            for p in zip(parts[w], parts[w][1:]):
                pairs[p] += n
        if not pairs or max(pairs.values()) < 2:
            break
        best = min(pairs, key=lambda p: (-pairs[p], p))
        merges.append((*best, pairs[best]))
        parts = {w: B.encode_word(s, {best: 0}) for w, s in parts.items()}
    return merges


def test_merges_equal_one_at_a_time_learning(spark):
    text = "the cat sat on the mat, that cat and the rat: aaaa aaa banana été été naïve " * 3 + "unique words here"
    docs = spark.createDataFrame([(1, text), (2, text[::-1])], "doc_id long, text string")
    words = {r["word"]: r["n"] for r in B.word_counts(docs).collect()}
    alphabet, merges = B.learn_merges(docs, 80)
    assert merges == brute_merges(words, 80 - 1 - len(alphabet))
    vocab = B.learn_bpe(docs, 80)
    encoded = B.bpe_encode(docs, vocab).withColumn("text", B.bpe_decode("ids", vocab))
    for r in encoded.collect():
        want = text if r["doc_id"] == 1 else text[::-1]
        assert r["text"] == (want if want.startswith(" ") else " " + want) and 0 not in r["ids"]


def test_ngram_loss_brute_force(spark):
    import math

    texts = ["abcabcabd" * 3, "", "bca", "abdabd" * 2, "cabbac", "abcd"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    whole = sum(map(len, texts))
    train = int(whole * 0.9)
    for row in N.ngram_loss(docs, "doc_id", [1, 2, 3], [0.25, 1.0]).collect():
        n, end = row["ngram"], max(1, int(train * row["fraction"]))
        seen, held, at, letters = Counter(), Counter(), 0, set()
        for t in texts:
            for i in range(len(t)):
                if at + i < train:
                    letters.add(t[i])
                if i + n <= len(t):
                    seen[t[i:i + n]] += at + i + n <= end
                    held[t[i:i + n]] += at + i >= train
            at += len(t)
        context = Counter()
        for g, c in seen.items():
            context[g[:-1]] += c
        loss = sum(-math.log((seen[g] + 1) / (context[g[:-1]] + len(letters))) * c for g, c in held.items()) / sum(held.values())
        assert row["tokens"] == sum(held.values()) and abs(row["loss"] - loss) < 1e-9


def test_top_k_keeps_ties(spark):
    counts = spark.createDataFrame([("a", "x", 5), ("a", "y", 3), ("a", "z", 3), ("a", "w", 1)], "context string, next string, n long")
    rows = N.next_token_dist(counts, 2).collect()
    assert {r["next"] for r in rows} == {"x", "y", "z"} and abs(sum(r["p"] for r in rows) - 1) < 1e-12


def test_a_round_touches_only_words_with_its_pairs(spark):
    text = "the cat sat on the mat, that cat and the rat: banana été naïve " * 2
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    counted = B.word_counts(docs)
    parts = {r["word"]: [f"{b:02X}" for b in r["word"].encode()] for r in counted.collect()}
    times = {r["word"]: r["n"] for r in counted.collect()}
    index = B.PairIndex(counted)
    for i, pair in enumerate([("61", "74"), ("20", "74"), ("68", "65"), ("2074", "6865"), ("20", "6D"), ("74", "68"), ("6E", "61")]):
        held = {w for w, s in parts.items() if pair in set(zip(s, s[1:]))}
        assert {r["word"] for r in index.words_with([pair]).collect()} == held
        parts = {w: B.encode_word(s, {pair: 0}) for w, s in parts.items()}
        index.merge([pair])
        if index.fresh:
            assert {r["word"] for r in index._read(index.fresh[-1:]).collect()} == held
        counts = Counter()
        for w, s in parts.items():
            for p in zip(s, s[1:]):
                counts["><".join(p)] += times[w]
        assert {r["pair"]: r["n"] for r in index.pair_counts().collect()} == counts
        if i in (2, 4):  # putting changes together changes nothing that is read
            index._gather()
            assert {r["pair"]: r["n"] for r in index.pair_counts().collect()} == counts


CHANGES = [  # npc_id, seq, field, value
    ("a", 5, "goal", "late"), ("a", 2, "goal", "early"), ("a", 3, "level", "x"), ("a", 4, "level", "7"), ("b", 1, "hat", "red"),
    ("ghost", 1, "goal", "none"), ("b", 9, "notes", "p, q,,r"), ("b", 8, "notes", "old"), ("b", 2, None, "v"), ("a", 6, "quirk", None),
]


def test_edit_stream_equals_batch(spark, tmp_path):
    from taleweave.operators import registry as G
    from taleweave.streaming import changes as C
    from taleweave.streaming import history as H

    records = G.conform(spark.createDataFrame([("a", "Ann", 1), ("b", "Bob", 2), ("c", "Cid", 3)], "npc_id string, name string, seq long"))
    schema = "npc_id string, seq long, field string, value string"
    source = str(tmp_path / "in")
    for i in range(3):
        spark.createDataFrame(CHANGES[i::3], schema).coalesce(1).write.mode("append").parquet(source)
        with H.rocksdb(spark):
            C.change_stream(
                C.checked_edits(spark.readStream.schema(schema).parquet(source)), records, str(tmp_path / "out"),
                str(tmp_path / "no"), str(tmp_path / "cp")).awaitTermination()
    want, refused = G.apply_edits(records, spark.createDataFrame(CHANGES, schema))
    got, _ = G.apply_edits(records, C.read_changes(spark, str(tmp_path / "out")))

    def rows(df):
        return sorted(map(repr, df.select("npc_id", "level", "goal", "quirk", "notes").collect()))

    assert rows(got) == rows(want)
    keys = ["npc_id", "seq", "field", "value", "reason"]
    rejects = spark.read.parquet(str(tmp_path / "no" / "epoch=*"))
    assert sorted(map(repr, rejects.select(*keys).collect())) == sorted(map(repr, refused.select(*keys).collect()))
    assert refused.count() == 4


def test_update_state_is_bounded_and_whole(spark, tmp_path):
    from taleweave.operators import extract
    from taleweave.operators import registry as G
    from taleweave.streaming import changes as C
    from taleweave.streaming import history as H

    records = G.conform(spark.createDataFrame([("a", "Ann", 1), ("b", "Bob", 2)], "npc_id string, name string, seq long"))
    log = [("a", i, f" text {i} " if i % 4 else "  ") for i in range(30)] + [("b", 3, "only")]
    found = [("a", i, "goal", f"g{i}") for i in range(0, 30, 7)] + [("a", 11, "trait:x", "1"), ("a", 11, "trait:y", "2"),
             ("a", 20, "trait:z", "3"), ("b", 3, "trait:x", "9")]
    log_df = spark.createDataFrame(log, "npc_id string, seq long, text string")
    attributes = spark.createDataFrame(found, C.CHANGE_SCHEMA)
    rows = C.update_rows(log_df, attributes)
    source = str(tmp_path / "in")
    for i in (2, 0, 1):  # newest traits may come first
        rows.where(F.col("seq") % 3 == i).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(C.CHANGE_SCHEMA).parquet(source).withColumn("reason", F.lit(None).cast("string"))
        with H.rocksdb(spark):
            C.change_stream(stream, records, str(tmp_path / "out"), str(tmp_path / "no"), str(tmp_path / "cp"), 5).awaitTermination()
    short = C.read_changes(spark, str(tmp_path / "out"))
    assert short.where(F.col("field") == C.NOTE).groupBy("npc_id").count().agg(F.max("count")).first()[0] == 5
    short_attributes, short_log = C.split_notes(short)

    def state(log_, attributes_):
        updated = extract.apply_updates(records, log_, attributes_, note_cap=5)
        return sorted(map(repr, updated.select("npc_id", "goal", "extra_traits", "notes").collect()))

    assert state(short_log, short_attributes) == state(log_df, attributes)
    assert C.read_changes(spark, str(tmp_path / "none")).count() == 0


def test_records_share_state_and_known_ids_stay(spark, tmp_path):
    """Many records need few calls of the step, and a restart with other
    records knows the ids that the first start knew."""
    from taleweave.streaming import changes as C
    from taleweave.streaming import history as H

    schema = "npc_id string, seq long, field string, value string"
    source, at = str(tmp_path / "in"), [str(tmp_path / n) for n in ("out", "no", "cp")]
    for round_no, known in enumerate((["a", None, *map(str, range(600))], ["late"])):
        rows = [(str(i), 10 * round_no, "goal", f"g{i} {round_no}") for i in range(600)]
        rows += [("late", round_no, "goal", "x"), (None, round_no, "goal", "null's"), ("a", -round_no, "goal", f"old {round_no}"), (None, 5, None, "v")]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        stream = C.checked_edits(spark.readStream.schema(schema).parquet(source))
        records = spark.createDataFrame([(k,) for k in known], "npc_id string")
        with H.rocksdb(spark):
            query = C.change_stream(stream, records, *at)
            query.awaitTermination()
        # at most a state for 256 records, not one for each
        assert sum(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress[-1:]) <= 3
    got = {r["npc_id"]: r["value"] for r in C.read_changes(spark, at[0]).collect()}
    assert got == {"a": "old 0"} | {str(i): f"g{i} 1" for i in range(600)} | ({None: "null's"} if None in got else {})
    refused = spark.read.parquet(f"{at[1]}/epoch=*")
    assert {(r["npc_id"], r["reason"]): r["n"] for r in refused.groupBy("npc_id", "reason").agg(F.count("*").alias("n")).collect()} == {
        ("late", "unknown id"): 2, (None, "unknown field"): 2}


def test_a_round_writes_one_row_for_each_changed_word(spark):
    docs = spark.createDataFrame([(1, "banana bandana cat cat aaaa nab")], "doc_id long, text string")
    index = B.PairIndex(B.word_counts(docs))
    for i, pair in enumerate([("61", "6E"), ("63", "61"), ("62", "616E"), ("61", "61"), ("20", "62616E"), ("6361", "74")]):
        held = sorted(r["word"] for r in index.words_with([pair]).collect())
        index.merge([pair])
        if index.fresh:
            assert sorted(r["word"] for r in index._read(index.fresh[-1:]).collect()) == held
        assert index.words_with([pair]).count() == 0
    assert {r["symbols"] for r in index._words().collect()} == {
        "<2062616E><616E><61>", "<2062616E><64><616E><61>", "<20><636174>", "<20><6161><6161>", "<20><6E><61><62>"}


def test_words_encoded_together():
    """Many words at once get the ids that each gets alone."""
    import random

    import numpy as np

    rng = random.Random(9)
    tokens, ranks = [f"{b:02X}" for b in b"abc"], {}
    for _ in range(40):
        pair = (rng.choice(tokens), rng.choice(tokens))
        ranks.setdefault(pair, len(ranks))
        tokens.append("".join(pair))
    ids = {t: i + 1 for i, t in enumerate(tokens)}
    words = ["".join(rng.choice("aabbc\u00e4") for _ in range(rng.randrange(30))) for _ in range(500)] + ["a" * n for n in range(40)]
    for known in (ranks, {}):
        want = [[ids.get(p, 0) for p in B.encode_word([f"{b:02X}" for b in w.encode()], known)] for w in words]
        assert [np.frombuffer(x, np.int32).tolist() for x in B.WordEncoder(ids, known).encode(words)] == want
    assert B.WordEncoder(ids, ranks).encode([]) == []


def test_encoding_keeps_null_and_empty_texts(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None), (3, ""), (4, "b")], "doc_id int, text string")
    vocab = B.learn_bpe(docs, 8)
    got = {r["doc_id"]: r["text"] for r in B.bpe_encode(docs, vocab).withColumn("text", B.bpe_decode("ids", vocab)).collect()}
    assert got == {1: " a b", 2: None, 3: " ", 4: " b"}

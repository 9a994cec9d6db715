"""Language model, tokens and encodings against brute force."""

import math
import re
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from taleweave.llm import bpe, kneser_ney, tokencount
from taleweave.llm import wordtable

BPE, UNIGRAM = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("piece_bpe_32k.model")


def tokens(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [w for w in re.split("[\x20\x09-\x0D]+", lowered) if w] + [None]


def cuts(values):
    n = [sum(v == k for v in values) for k in (1, 2, 3, 4)]
    if min(n) == 0:
        return [0, 0.5, 1, 1.5]
    y = n[0] / (n[0] + 2 * n[1])
    return [0, *[min(max(k - (k + 1) * y * n[k] / n[k - 1], 0), k) for k in (1, 2, 3)]]


def brute_scores(rows):
    held = {i: zlib.crc32(str(i if i is not None else "").encode()) % 10 == 0 for i, _ in rows}
    train = [tokens(t) for i, t in rows if not held[i]]
    counts = Counter(w for t in train for w in t)
    total, words = sum(counts.values()), len(counts)
    pairs = Counter((a, b) for t in train for a, b in zip(["<s>", *t], t))
    before = Counter(b for _, b in pairs)
    low, high = cuts(list(before.values())), cuts(list(pairs.values()))
    context = defaultdict(lambda: [0, 0, 0, 0])
    for (a, _), n in pairs.items():
        context[a][0] += n
        context[a][min(n, 3)] += 1
    left = sum(low[min(n, 3)] for n in before.values())

    def single(w):
        if not before:
            return 1.0
        return (max(before[w] - low[min(before[w], 3)], 0) + left / (words + 1)) / len(pairs)

    def double(a, w):
        if a not in context:
            return single(w)
        c, n = context[a], pairs[a, w]
        return (max(n - high[min(n, 3)], 0) + sum(high[k] * c[k] for k in (1, 2, 3)) * single(w)) / c[0]

    out = []
    for i, text in rows:
        t = tokens(text)
        out.append((i, held[i], len(t), sum(w in counts for w in t), total,
                    sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (words + 1))) for w in t),
                    sum(math.log10(double(a, w)) for a, w in zip(["<s>", *t], t))))
    return out


def test_model_against_brute_force(make, odd):
    rows = odd + [(i, "a b c a b d " * (i % 4) + f"w{i % 5} a b") for i in range(10, 60)]
    got = kneser_ney.perplexity_scores(make(rows)).collect()
    got = [(r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in got]
    order = lambda r: (str(r[0]), r[2], r[5])
    for a, b in zip(sorted(got, key=order), sorted(brute_scores(rows), key=order), strict=True):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:], rel=1e-9)


def test_model_of_nothing(make):
    assert kneser_ney.perplexity_scores(make([])).count() == 0
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0)
    row = kneser_ney.perplexity_scores(make([(held, "only held out")])).first()
    assert (row["train_tokens"], row["n_known"], row["base_score"], row["score"]) == (0, 0, 0.0, 0.0)


def test_mixing_of_hashes_is_a_bijection():
    import numpy as np

    values = np.random.default_rng(1).integers(0, 2 ** 64, 1000, dtype=np.uint64)
    assert (kneser_ney.unmix(kneser_ney.mix(values)) == values).all()


def check_bpe(frame, rows):
    tok = Tokenizer.from_file(BPE)
    want = sorted((str(i), tok.encode(t or "", add_special_tokens=False).ids) for i, t in rows)
    want = [(i, ids, tok.decode(ids, skip_special_tokens=False)) for i, ids in want]
    got = sorted((str(r["doc_id"]), r["ids"], r["text"]) for r in bpe.encode_decode(frame, BPE).collect())
    assert got == want


def test_encoding_against_the_library(make, odd):
    check_bpe(make(odd).withColumnRenamed("n_chars", "ids"), odd)  # a clashing name


def test_encoding_of_rare_words(make, monkeypatch):
    rows = [(i, " ".join(f"tok{i * 7 % 50}{j} the" for j in range(40))) for i in range(60)]
    monkeypatch.setattr(wordtable, "FREQUENT_WORDS", 3)
    check_bpe(make(rows), rows)
    monkeypatch.setattr(wordtable, "FREQUENT_WORDS", 0)
    monkeypatch.setattr(bpe, "BLOCK_WORDS", 100)
    check_bpe(make(rows + rows[:5]), rows + rows[:5])
    check_bpe(make([]), [])


def test_decoding_leaves_unknown_ids_out(spark):
    df = spark.createDataFrame([(1, [320, -1, 10 ** 6, None, 1125]), (2, None), (3, [])], "k long, ids array<int>")
    got = {r["k"]: r["text"] for r in bpe.decode(df, BPE, key="k").collect()}
    assert got == {1: Tokenizer.from_file(BPE).decode([320, 1125]), 2: "", 3: ""}


PIECES, IN_BYTES = tokencount.piece_scores(UNIGRAM)


def best(word):
    """All segmentations by plain dynamic programming, one word at a time."""
    found = [(0, 0)]
    for end in range(1, len(word) + 1):
        options = [(found[s][0] + PIECES[word[s:end]], found[s][1] - 1) for s in range(max(0, end - 40), end) if word[s:end] in PIECES]
        if word[end - 1] not in PIECES:
            raw = word[end - 1].encode()
            options.append((found[end - 1][0] + sum(IN_BYTES[b] for b in raw), found[end - 1][1] - len(raw)))
        found.append(max(options))
    return -found[-1][1], found[-1][0]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="abcthe▁éß汉", min_size=0, max_size=12), max_size=20))
def test_trie_shares_prefixes(words):
    trie = tokencount.TrieScores(PIECES, IN_BYTES)
    for w in sorted(words) + words:
        assert trie.terminal("▁" + w) == best("▁" + w)


@pytest.mark.parametrize("frequent", [0, 2, 1 << 18])
def test_token_counts(make, odd, monkeypatch, frequent):
    monkeypatch.setattr(wordtable, "FREQUENT_WORDS", frequent)
    want = []
    for i, t in odd:
        each = [best("▁" + w.decode()) for w in (t or "").encode().split()]
        want.append((str(i), len(each), sum(n for n, _ in each), sum(s for _, s in each)))
    got = tokencount.count_tokens(make(odd), UNIGRAM).collect()
    assert sorted((str(r["doc_id"]), r["n_words"], r["n_tokens"], r["score"]) for r in got) == sorted(want)
    assert tokencount.count_tokens(make([]), UNIGRAM).count() == 0


def test_token_counts_of_rows_that_share_an_id(spark, make, monkeypatch):
    # these texts had the same 31 bits of a hash once
    pair = [(None, "w104857"), (None, "w231324 more words here to count"), (7, "w104857"), (7, "w231324 more words here to count")]
    got = tokencount.count_tokens(make(pair), UNIGRAM).collect()
    assert sorted((str(r["doc_id"]), r["n_words"], r["n_tokens"]) for r in got) == [
        ("7", 1, 7), ("7", 6, 12), ("None", 1, 7), ("None", 6, 12)]
    monkeypatch.setattr(wordtable, "FREQUENT_WORDS", 3)
    many = spark.range(100_000).select(
        F.lit(None).cast("string").alias("doc_id"), F.concat_ws(" ", F.lit("w"), "id", F.col("id") % 7).alias("text"))
    got = tokencount.count_tokens(many, UNIGRAM).groupBy("n_words", "n_tokens", "score").count().collect()
    want = Counter()
    for i in range(100_000):
        each = [best("▁" + w) for w in ("w", str(i), str(i % 7))]
        want[(3, sum(n for n, _ in each), sum(s for _, s in each))] += 1
    assert {tuple(r)[:3]: r["count"] for r in got} == want


def test_token_counts_keep_the_type_of_the_key(spark):
    docs = spark.createDataFrame([("a/1", "the cat"), ("b", None)], "doc_id string, text string")
    got = tokencount.count_tokens(docs, UNIGRAM).collect()
    assert {(r["doc_id"], r["n_words"]) for r in got} == {("a/1", 2), ("b", 0)}


def test_bucket_holds_few_words_as_values(monkeypatch, tmp_path):
    """The words of a bucket are encoded some at a time, each once."""
    import zlib

    import pyarrow as pa

    from taleweave.llm import bpe

    seen = []

    def fake(_, words):
        seen.append(words)
        return [[len(w), int(w)] if w != "7" else [] for w in words]

    monkeypatch.setattr(bpe, "encode_words", fake)
    monkeypatch.setattr(bpe, "load_tokenizer", lambda path: None)
    asked = [[str(i) for i in range(a, b)] for a, b in ((0, 6000), (3000, 9000), (7, 8))]
    batch = pa.RecordBatch.from_arrays(
        [pa.array([1, 2, 3], pa.int64()), pa.array([4, 4, 5], pa.int32()),
         pa.array([zlib.compress("\n".join(words).encode()) for words in asked], pa.binary())], names=["block", "bucket", "words"])
    made = [row for out in bpe._rare_ids("x")(iter([batch])) for row in out.to_pylist()]
    assert [(r["block"], r["bucket"], r["rare"]) for r in made] == [(1, 4, 6000), (2, 4, 6000), (3, 5, 1)]
    for row, words in zip(made, asked):
        ids = fake(None, words)
        assert bpe._expand(row["payload"]).tolist() == [*map(len, ids), *(x for i in ids for x in i)]
    assert max(map(len, seen[:-3])) <= bpe._BATCH and sum(map(len, seen[:-3])) == 9001

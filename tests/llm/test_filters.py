"""Toxicity, quality, near duplicates and the pipeline."""

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from taleweave.llm import components, neardup, quality, toxicity

COMMON = [a + b for a in "pa mo ti re lu sa ko ni".split() for b in "ra be lo di na".split()]


def prose(rng, n=60):
    return ". ".join(" ".join(rng.choice(COMMON) for _ in range(8)).capitalize() for _ in range(n // 8)) + "."


@pytest.fixture(scope="module")
def corpus():
    """Prose, junk and insults, with labels for half of each."""
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(400):
        text, good, toxic = prose(rng), 1, 0
        if i % 5 == 0:
            text, good = " ".join(f"{rng.choice(COMMON)}%%% ***" for _ in range(40)), 0
        if i % 7 == 0:
            words = text.split()
            words.insert(rng.randint(0, len(words)), rng.choice(["grokful!", "Zunkish", "zunkier,"]))
            text, toxic = " ".join(words), 1
        rows.append((i, text))
        if i % 2 == 0:
            labels.append((i, good, toxic))
    return rows, labels


@pytest.fixture(scope="module")
def labels(spark, corpus):
    more = [(None, 0, 1), (0, None, None), (10_000, 1, 0), (2, 1, 0)]
    return spark.createDataFrame(corpus[1] + more, "doc_id long, quality int, toxic int")


def test_chain_finds_toxic_rows(make, corpus, labels):
    docs = make(corpus[0]).withColumn("p_toxic", F.lit("clash"))
    got = {r["doc_id"]: r for r in toxicity.score_toxicity(docs, labels).withColumn("t", toxicity.is_toxic()).collect()}
    found, toxic = {i for i, r in got.items() if r["t"]}, {i for i, _ in corpus[0] if i % 7 == 0}
    assert found <= toxic and len(found) >= 0.95 * len(toxic)  # few labels: a rare mix may be missed
    junk = [r for i, r in got.items() if r["t"] and i % 5 == 0]
    plain = [r for i, r in got.items() if r["t"] and i % 5]
    mean = lambda rows, c: sum(r[c] for r in rows) / len(rows)
    assert mean(junk, "p_toxic_junk") > mean(plain, "p_toxic_junk")
    assert mean(plain, "p_toxic_prose") > mean(junk, "p_toxic_prose")


def sparse(matrix):
    return toxicity.Hits.of([np.flatnonzero(r).tolist() for r in matrix], matrix.shape[1])


def test_chain_feeds_out_of_fold_probabilities(monkeypatch):
    """The second category's model sees what models without the row have said."""
    seen = []
    real = toxicity.fit_logistic
    monkeypatch.setattr(toxicity, "fit_logistic", lambda x, y, **k: (seen.append((x, y.copy())), real(x, y, **k))[1])
    rng = np.random.default_rng(2)
    hits = rng.integers(0, 2, (60, 3))
    first = hits[:, 0]
    folds = np.arange(60) % 3
    toxicity.fit_chain(sparse(hits), np.column_stack([first, first * hits[:, 1]]), folds, ["a", "b"], {})
    fed = seen[-1][0].earlier[:, 0]
    for f in range(3):
        x, y = seen[f]
        assert x.hits.n == len(y) == 40
        own = real(x, y)
        want = toxicity._sigmoid(np.column_stack([hits[folds == f], np.ones(20)]) @ own)
        assert fed[folds == f] == pytest.approx(want)


def test_logistic_fit_is_a_minimum():
    rng = np.random.default_rng(1)
    for width in (4, 150):
        hits, earlier = rng.integers(0, 2, (200, width)), rng.random((200, 2))
        x = np.column_stack([hits, earlier, np.ones(200)])
        y = (hits[:, 0] + earlier[:, 1] + rng.normal(size=200) > 0.9).astype(float)
        w = toxicity.fit_logistic(toxicity.Design(sparse(hits), earlier), y, penalty=0.5)
        slope = x.T @ (toxicity._sigmoid(x @ w) - y) + 0.5 * np.array([*w[:-1], 0])
        assert np.abs(slope).max() < 1e-2
        assert toxicity.Design(sparse(hits), earlier).times(w) == pytest.approx(x @ w)
        assert toxicity.Design(sparse(hits), earlier).back(y) == pytest.approx(x.T @ y)
        assert toxicity.Design(sparse(hits), earlier).back(y, square=True) == pytest.approx((x * x).T @ y)


def test_chain_of_repeated_keys(make, labels, corpus):
    """A key of very many rows is one row of the sample, whatever the partitions."""
    docs = make(corpus[0] + [(0, f"{corpus[0][0][1]} v{i}") for i in range(300)])
    one = toxicity.fit(docs, toxicity.label_categories(labels), toxicity.CATEGORIES, most=50)
    two = toxicity.fit(docs.repartition(7), toxicity.label_categories(labels), toxicity.CATEGORIES, most=50)
    assert one.features == two.features and len(one.features) <= 150
    assert all(np.allclose(a, b) for a, b in zip(one.weights, two.weights))


def test_chain_without_labels(make, labels):
    docs = make([(1, "a"), (2, None)])
    none = toxicity.score_toxicity(docs, labels.limit(0)).withColumn("t", toxicity.is_toxic()).collect()
    assert [(r["p_toxic"], r["t"]) for r in none] == [(0.5, False)] * 2
    assert toxicity.score_toxicity(make([]), labels).count() == 0


def test_toxicity_of_odd_tables(make, odd, labels):
    assert toxicity.score_toxicity(make(odd), labels).count() == len(odd)


def test_rules_tell_junk_from_prose(make, corpus, labels):
    docs = make(corpus[0]).withColumn("score", F.lit("clash"))
    train = F.col("doc_id") % 3 != 0
    got = quality.score_quality(docs, labels, train).collect()
    right = [(r["predicted"] == 1) == (r["doc_id"] % 5 != 0) for r in got if r["doc_id"] % 3 == 0]
    assert sum(right) / len(right) > 0.97 and all(0 <= r["score"] <= 1 for r in got)


def test_rules_of_trees():
    told = """Model
  Tree 0 (weight 1.0):
    If (feature 0 <= 0.5)
     If (feature 1 > 2.0E-3)
      Predict: 1
     Else (feature 1 <= 2.0E-3)
      Predict: 2
    Else (feature 0 > 0.5)
     Predict: 3
  Tree 1 (weight 0.1):
    If (feature 1 <= 7.0)
     Predict: 0
"""
    a, b = ("a", "<=", 0.5), ("b", ">", 0.002)
    assert quality.tree_rules(told, ["a", "b"]) == [
        (a,), (a, b), (a, ("b", "<=", 0.002)), (("a", ">", 0.5),), (("b", "<=", 7.0),)]


def test_compiled_rules_equal_their_sum(spark):
    df = spark.createDataFrame([(0.2, 5.0), (0.7, 5.0), (0.2, 9.0)], "a double, b double").select(F.struct("a", "b").alias("_stats"))
    kept = [((("a", "<=", 0.5),), 1.5), ((("a", "<=", 0.5), ("b", ">", 6.0)), -4.0)]
    got = [r[0] for r in df.select(quality.compile_score(0.25, kept)).collect()]
    assert got == pytest.approx([1 / (1 + math.exp(-z)) for z in (1.75, 0.25, -2.25)])


def test_quality_of_odd_tables(make, odd, labels):
    assert quality.score_quality(make(odd), labels).count() == len(odd)
    assert quality.score_quality(make([]), labels).count() == 0
    one = quality.score_quality(make([(1, "x")]), labels.limit(0)).first()
    assert one["score"] == 0.5


# --- near duplicates ----------------------------------------------------------

def weighted(text):
    words = (text or "").encode().split()
    if not words:
        return {}
    counts = Counter(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4)))
    return {k: 1 + math.log(n) for k, n in counts.items()}


def probability_jaccard(w, v):
    every = set(w) | set(v)
    return sum(1 / sum(max(w.get(e, 0) / w[d], v.get(e, 0) / v[d]) for e in every) for d in set(w) & set(v))


def brute_classes(rows):
    sets, parent = [weighted(t) for _, t in rows], list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] or "") == (rows[j][1] or "") or (sets[i] and sets[j] and probability_jaccard(sets[i], sets[j]) >= 0.8):
                parent[root(i)] = root(j)
    groups = {}
    for i, (doc, _) in enumerate(rows):
        groups.setdefault(root(i), []).append(doc)
    return sorted(sorted(map(str, g)) for g in groups.values())


def check_classes(frame, rows):
    got = neardup.near_duplicates(frame).collect()
    groups = {}
    for r in got:
        groups.setdefault((r["class_id"],), []).append(r)
    assert sorted(sorted(str(r["doc_id"]) for r in g) for g in groups.values()) == brute_classes(rows)
    for (name,), g in groups.items():
        ids = [r["doc_id"] for r in g if r["doc_id"] is not None]
        assert name == (min(ids) if ids else None)
        assert sum(r["stays"] for r in g) == 1


def copies(rng, text, n, edits):
    out = []
    for _ in range(n):
        words = text.split()
        for _ in range(edits):
            words[rng.randrange(len(words))] = f"e{rng.random()}"
        out.append(" ".join(words))
    return out


def test_classes_against_brute_force(make):
    rng = random.Random(6)
    base = [prose(rng, 80) for _ in range(12)]
    shared = prose(rng, 64)
    texts = [t for b in base for t in copies(rng, b, 4, rng.randint(0, 3))]
    texts += [f"{shared} {prose(rng, 40)}" for _ in range(12)]  # one passage, different documents
    texts += [f"{shared} tail {i % 2}" for i in range(6)] + ["one two", "one two", "one two three", "w " * 300, "w " * 299]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    check_classes(make(rows).withColumn("node", F.lit(1)), rows)


def test_a_large_group_of_near_copies(make):
    rng = random.Random(7)
    rows = list(enumerate(copies(rng, prose(rng, 120), 300, 1) + [prose(rng) for _ in range(40)]))
    got = neardup.near_duplicates(make(rows)).collect()
    assert sum(r["class_id"] == 0 for r in got) == 300 and sum(r["stays"] for r in got) == 41


def test_a_star_against_brute_force(make):
    """One text and 600 copies, each with its own edits: similar to the original alone."""
    rng = random.Random(8)
    first = prose(rng, 400)
    texts = [first, *copies(rng, first, 600, 7)]
    rng.shuffle(texts)
    rows, values, weights = neardup.shingles(pa.array(texts))
    sets = [(values[rows == i], weights[rows == i]) for i in range(len(texts))]
    parent = list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if root(i) != root(j) and neardup.similarity(sets[i], sets[j]) >= 0.8:
                parent[root(i)] = root(j)
    want = [root(i) for i in range(len(texts))]
    assert max(Counter(want).values()) > 550
    got = {r["doc_id"]: r["class_id"] for r in neardup.near_duplicates(make(list(enumerate(texts)))).collect()}
    least = {}
    for i, w in enumerate(want):
        least.setdefault(w, i)
    assert got == {i: least[w] for i, w in enumerate(want)}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=40), st.lists(st.integers(0, 3), min_size=1, max_size=40))
def test_bound_of_similarity(a, b):
    rows, values, weights = neardup.shingles(pa.array([" ".join(map(str, a)), " ".join(map(str, b))]))
    (x, w), (y, v) = [(values[rows == i], weights[rows == i]) for i in (0, 1)]
    _, in_a, in_b = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    bound = neardup.most_similar(
        np.array([w.sum()]), np.array([v.sum()]), np.array([[w[in_a].sum()]]), np.array([[v[in_b].sum()]]))
    assert neardup.similarity((x, w), (y, v)) <= bound[0, 0] + 1e-9


def test_classes_of_odd_tables(make):
    rows = [(1, None), (2, ""), (3, " "), (None, "a b c d e f g"), (4, "a b c d e f g"), (None, "lonely null"), (5, "z " * 30_000)]
    check_classes(make(rows), rows)
    got = neardup.near_duplicates(make([(1, "same"), (1, "same"), (1, "other text under the same id"), (0, "same")])).collect()
    assert sorted((r["class_id"], r["stays"]) for r in got) == [(0, False), (0, False), (0, True), (1, True)]
    assert neardup.near_duplicates(make([])).count() == 0


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 6), min_size=1, max_size=25), st.lists(st.integers(0, 6), min_size=1, max_size=25))
def test_similarity_formula(a, b):
    one, two = (" ".join(f"w{x}" for x in v) for v in (a, b))
    rows, values, weights = neardup.shingles(pa.array([one, two]))
    parts = [(values[rows == i], weights[rows == i]) for i in (0, 1)]
    want = probability_jaccard(weighted(one), weighted(two))
    assert neardup.similarity(*parts) == pytest.approx(want)


def test_signatures_estimate_the_similarity():
    rng = random.Random(9)
    a = [f"w{rng.randint(0, 60)}" for _ in range(150)]
    b = a[:120] + [f"v{i}" for i in range(30)] + a[:40]
    one, two = " ".join(a), " ".join(b)
    rows, values, weights = neardup.shingles(pa.array([one, two]))
    found = neardup.signatures(rows, values, weights, 2, 4096)
    want = probability_jaccard(weighted(one), weighted(two))
    assert abs((found[0] == found[1]).mean() - want) < 0.04


def test_components_of_long_chains(spark):
    edges = [(f"{i:03d}", f"{i + 1:03d}") for i in range(60)] + [("x", "y"), ("y", "x"), ("q", "q")]
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(edges, "u string, v string")).collect()}
    assert got == {f"{i:03d}": "000" for i in range(61)} | {"x": "x", "y": "x"}


# --- the pipeline -------------------------------------------------------------

def test_stages_keep_columns_and_clean_documents(make, corpus, labels, tmp_path, spark):
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    rng = random.Random(1)
    extra = [(1000 + i, t) for i, t in enumerate(copies(rng, corpus[0][1][1], 5, 1))] + [(None, None), (1001, "twice"), (1001, "twice")]
    docs = make(corpus[0] + extra, source=lambda i: "rest" if i is None or i % 4 else "main")
    docs = docs.withColumns({"score": F.lit(1), "p_toxic": F.lit("x"), "block": F.lit(2), "n_tokens": F.lit(None).cast("int")})
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        out.write.parquet(str(tmp_path / name))
        if name != "bpe":
            assert out.columns == docs.columns
        docs = spark.read.parquet(str(tmp_path / name))
        kept[name] = [r["doc_id"] for r in docs.collect()]
    toxic = {i for i, _ in corpus[0] if i % 7 == 0}
    left = toxic & set(kept["toxicity"])
    assert len(left) <= 0.05 * len(toxic) and len(kept["toxicity"]) == 400 - len(toxic) + len(left) + len(extra)
    clean = {i for i, _ in corpus[0] if i % 7 and i % 5}
    assert clean <= set(kept["quality"]) and not {i for i, _ in corpus[0] if i % 5 == 0} & set(kept["quality"])
    assert clean <= set(kept["near duplicates"]) and not {1000, 1002, 1003, 1004} & set(kept["near duplicates"])
    assert len(kept["near duplicates"]) == len(set(kept["near duplicates"]))
    assert set(kept["mixing"]) == set(kept["near duplicates"]) == set(kept["bpe"])
    assert sorted(map(str, kept["mixing"])) == sorted(map(str, kept["bpe"]))

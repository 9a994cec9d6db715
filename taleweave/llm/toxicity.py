"""Toxicity categories by a classifier chain of linear models.

A text is the set of its words and word beginnings. Features that tell a
category's documents from the rest are chosen by their log odds. The categories
are predicted one after the other: a model sees the features and the
probabilities of all earlier categories. While fitting, these come from models
that did not see the row (out-of-fold); when scoring, from the final ones.

The chain is fitted on a bounded sample of labelled rows; texts are read and
scored by Spark.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taleweave.llm.common import settled, whole_text

#: Labelled rows that the chain is fitted on at most, features of a category,
#: documents that must hold a feature, folds, and the penalty on weights.
SAMPLE_ROWS, FEATURES, LEAST_DOCS, FOLDS, PENALTY = 16_000, 400, 5, 4, 0.05
CATEGORIES = ["toxic", "toxic_prose", "toxic_junk"]
#: Lengths of the word beginnings that are features.
BEGINNINGS = (4, 5, 6)
_PART = re.compile(r"[^\W\d_]+|[^\w\s]{2,}")


def part_features(part: str) -> list[str]:
    """A word, and its beginnings followed by `*`; or a run of signs alone."""
    return [part, *[f"{part[:n]}*" for n in BEGINNINGS if len(part) >= n and part[0].isalpha()]]


def text_features(text: str) -> set[str]:
    """Features of the words of a text, in lower case, and of its runs of signs."""
    return {f for part in set(_PART.findall(text.lower())) for f in part_features(part)}


@dataclass
class Hits:
    """Rows of features as a sparse 0/1 matrix: row and feature of each hit."""

    rows: np.ndarray
    columns: np.ndarray
    n: int
    width: int

    @classmethod
    def of(cls, lists, width: int) -> Hits:
        sizes = np.array([len(x) for x in lists], np.int64)
        flat = np.fromiter((i for x in lists for i in x), np.int64, int(sizes.sum()))
        return cls(np.repeat(np.arange(len(sizes)), sizes), flat, len(sizes), width)

    def part(self, wanted: np.ndarray) -> Hits:
        """The rows that a mask selects."""
        own, places = wanted[self.rows], np.cumsum(wanted) - 1
        return Hits(places[self.rows[own]], self.columns[own], int(wanted.sum()), self.width)


@dataclass
class Design:
    """Hits, the probabilities of earlier categories, and a constant."""

    hits: Hits
    earlier: np.ndarray

    @property
    def width(self) -> int:
        return self.hits.width + self.earlier.shape[1] + 1

    def times(self, w: np.ndarray) -> np.ndarray:
        m = self.hits.width
        found = np.bincount(self.hits.rows, w[self.hits.columns], self.hits.n)
        return found + self.earlier @ w[m:-1] + w[-1]

    def back(self, u: np.ndarray, square: bool = False) -> np.ndarray:
        """Sums of `u` over the rows of each column, weighted by its values or
        their squares."""
        dense = self.earlier ** 2 if square else self.earlier
        return np.concatenate([np.bincount(self.hits.columns, u[self.hits.rows], self.hits.width), dense.T @ u, [u.sum()]])


@dataclass
class Chain:
    categories: list[str]
    features: dict[str, int]
    weights: list[np.ndarray]  # per category: features, earlier probabilities, constant

    def probabilities(self, hits: Hits) -> np.ndarray:
        """One column per category for rows of features."""
        found = np.zeros((hits.n, 0))
        for w in self.weights:
            found = np.column_stack([found, _sigmoid(Design(hits, found).times(w))])
        return found


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def _solve(product, scale: np.ndarray, b: np.ndarray, tolerance: float) -> np.ndarray:
    """Conjugate gradients for `product(v) = b`, scaled by the diagonal."""
    x, r = np.zeros(len(b)), b.copy()
    z = r / scale
    p, rz, enough = z.copy(), r @ z, tolerance * np.sqrt(b @ b)
    for _ in range(10 * len(b)):
        if np.sqrt(r @ r) <= enough:
            break
        q = product(p)
        step = rz / (p @ q)
        x, r = x + step * p, r - step * q
        z = r / scale
        before, rz = rz, r @ z
        p = z + rz / before * p
    return x


def fit_logistic(x: Design, y: np.ndarray, penalty: float = PENALTY, steps: int = 50) -> np.ndarray:
    """Penalised logistic regression by Newton steps over sparse rows; the
    last column is the constant and carries no penalty."""
    w = np.zeros(x.width)
    rate = (y.sum() + 0.5) / (len(y) + 1)
    w[-1] = np.log(rate / (1 - rate))
    if len(y) == 0 or y.min() == y.max():
        return w
    ridge = np.full(len(w), penalty)
    ridge[-1] = 1e-6

    def loss(v: np.ndarray, z: np.ndarray) -> float:
        return float(np.logaddexp(0, z).sum() - y @ z + 0.5 * ridge @ (v * v))

    z = x.times(w)
    now = loss(w, z)
    for _ in range(steps):
        p = _sigmoid(z)
        gradient = x.back(y - p) - ridge * w
        bend = np.maximum(p * (1 - p), 1e-9)
        move = _solve(lambda v: x.back(bend * x.times(v)) + ridge * v, x.back(bend, square=True) + ridge, gradient, 1e-3)
        size, along = 1.0, x.times(move)
        while (then := loss(w + size * move, z + size * along)) > now and size > 1e-6:  # a full step may overshoot
            size /= 2
        if now - then < 1e-7 * max(1.0, now):
            break
        w, z, now = w + size * move, z + size * along, then
    return w


def fit_chain(hits: Hits, labels: np.ndarray, folds: np.ndarray, categories: list[str],
              features: dict[str, int]) -> Chain:
    """Fit the categories in order, feeding out-of-fold probabilities on."""
    earlier = np.zeros((hits.n, 0))
    weights = []
    for k in range(len(categories)):
        y = labels[:, k].astype(float)
        unseen = np.zeros(len(y))
        for f in np.unique(folds):
            inside = folds == f
            w = fit_logistic(Design(hits.part(~inside), earlier[~inside]), y[~inside])
            unseen[inside] = _sigmoid(Design(hits.part(inside), earlier[inside]).times(w))
        weights.append(fit_logistic(Design(hits, earlier), y))
        earlier = np.column_stack([earlier, unseen])
    return Chain(categories, features, weights)


def label_categories(labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, categories): any toxicity, then its kinds, in running prose and in
    junk. A repeated key is toxic if any of its rows is; rows without a key or a toxic
    label do not count, and a missing quality counts as prose."""
    once = labels.where(F.col(key).isNotNull() & F.col("toxic").isNotNull()).groupBy(key).agg(
        F.max("toxic").alias("t"), F.coalesce(F.min("quality"), F.lit(1)).alias("q"))
    toxic = F.col("t") == 1
    return once.select(
        key, toxic.cast("int").alias("toxic"), (toxic & (F.col("q") == 1)).cast("int").alias("toxic_prose"),
        (toxic & (F.col("q") == 0)).cast("int").alias("toxic_junk"))


def _count_features(categories: list[str]):
    """Arrow step: documents of each feature, in all and by category."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [Counter() for _ in range(len(categories) + 1)]
            marks = [batch.column(c).to_pylist() for c in categories]
            for i, text in enumerate(batch.column("text")):
                found = text_features(text.as_py())
                counts[0].update(found)
                for c, mark in zip(counts[1:], marks):
                    if mark[i]:
                        c.update(found)
            names = list(counts[0])
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), *[pa.array([c[n] for n in names], pa.int64()) for c in counts]],
                names=["feature", "n", *categories])

    return run


def choose_features(sample: DataFrame, categories: list[str], most: int = FEATURES) -> dict[str, int]:
    """The features with the clearest log odds for each category. Of features
    with one beginning that the same documents hold, as far as counts tell,
    the shortest is taken."""
    counted = sample.mapInArrow(
        _count_features(categories), "feature string, n long, " + ", ".join(f"{c} long" for c in categories))
    counted = counted.groupBy("feature").agg(*[F.sum(c).alias(c) for c in ["n", *categories]]).where(
        F.col("n") >= LEAST_DOCS)
    alike = [F.left("feature", F.lit(min(BEGINNINGS))).alias("start"), "n", *categories]
    counted = counted.groupBy(*alike).agg(F.min_by("feature", F.struct(F.length("feature"), "feature")).alias("feature"))
    counted = settled(counted, "features")
    totals = sample.agg(F.count("*").alias("n"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in categories]).first()
    chosen: dict[str, int] = {}
    half = F.lit(0.5)
    for c in categories:
        inside, outside = F.col(c) + half, F.col("n") - F.col(c) + half
        rest_in, rest_out = F.lit(totals[c]) - F.col(c) + half, F.lit(totals["n"] - totals[c]) - F.col("n") + F.col(c) + half
        clear = F.abs(F.log(inside * rest_out / (outside * rest_in))) / F.sqrt(
            1 / inside + 1 / outside + 1 / rest_in + 1 / rest_out)
        for r in counted.orderBy(F.desc(clear), "feature").select("feature").limit(most).collect():
            chosen.setdefault(r["feature"], len(chosen))
    return chosen


def _mark(features: dict[str, int], texts) -> list[list[int]]:
    """Features of each text, in ascending order."""
    of_word: dict[str, list[int]] = {}
    out = []
    for text in texts:
        hits: set[int] = set()
        for word in set(_PART.findall(text.lower())):
            found = of_word.get(word)
            if found is None:
                found = of_word[word] = [features[n] for n in part_features(word) if n in features]
            hits.update(found)
        out.append(sorted(hits))
        if len(of_word) > 60_000:  # a memory, not a limit on words
            of_word.clear()
    return out


def fit(docs: DataFrame, labels: DataFrame, categories: list[str], key: str = "doc_id", text: str = "text",
        sample_rows: int = SAMPLE_ROWS, seed: int = 5, most: int = FEATURES) -> Chain:
    """Fit a chain on at most `sample_rows` labelled rows, drawn by digest; of
    rows that share a key, the one whose text has the least digest.

    The sample is bounded, so one task fits it; the driver sees weights only.
    Without labelled rows every probability is one half; a category with one
    class only gets its smoothed rate.
    """
    draw = F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(key).cast("string")))
    drawn = labels.select(key, *categories).orderBy(draw, key).limit(sample_rows)
    rows = docs.select(F.col(key).alias("key"), whole_text(text).alias("text")).join(
        F.broadcast(drawn.withColumnRenamed(key, "key")), "key")
    sample = rows.groupBy("key", *categories).agg(F.min_by("text", F.md5("text")).alias("text"))
    sample = settled(sample, "labelled")
    features = choose_features(sample, categories, most)

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits = _mark(features, batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(hits, pa.list_(pa.int32())), *[batch.column(c) for c in categories]],
                names=["key", "hits", *categories])

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = sorted((r for b in batches for r in b.to_pylist()), key=lambda r: str(r["key"]))
        marks = np.array([[r[c] for c in categories] for r in got]).reshape(len(got), len(categories))
        hits = Hits.of([r["hits"] for r in got], len(features))
        chain = fit_chain(hits, marks, np.arange(len(got)) % FOLDS, categories, features)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(categories)), pa.int32()), pa.array([w.tolist() for w in chain.weights], pa.list_(pa.float64()))],
            names=["k", "weights"])

    kind = sample.schema["key"].dataType.simpleString()
    hits = sample.mapInArrow(marked, f"key {kind}, hits array<int>, " + ", ".join(f"{c} int" for c in categories))
    weights = hits.repartition(1).mapInArrow(fitted, "k int, weights array<double>").orderBy("k").collect()
    if not weights:  # nothing to fit on, and no task to say so
        return fit_chain(Hits.of([], 0), np.zeros((0, len(categories))), np.zeros(0), categories, {})
    return Chain(categories, features, [np.array(r["weights"]) for r in weights])


def chances(chain: Chain, text: Column) -> Column:
    """Array of the categories' probabilities; only the text goes to Python."""
    @F.pandas_udf("array<double>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            hits = Hits.of(_mark(chain.features, texts), len(chain.features))
            yield pd.Series(chain.probabilities(hits).tolist())

    return run(F.coalesce(text, F.lit("")))


def score(docs: DataFrame, chain: Chain, text: str = "text") -> DataFrame:
    """The given columns, with `p_<category>` for every category. A null text
    is empty. Given columns of these names are replaced."""
    names = [f"p_{c}" for c in chain.categories]
    scored = docs.drop(*names, "_chances").withColumn("_chances", chances(chain, F.col(text)))
    return scored.withColumns({n: F.col("_chances")[k] for k, n in enumerate(names)}).drop("_chances")


def is_toxic(threshold: float = 0.5) -> Column:
    """The decision on a scored row: its probability of any toxicity. Nothing
    is toxic to a chain that has seen no labels (it says one half)."""
    return F.col("p_toxic") > threshold


def score_toxicity(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fit on the labels (key, toxic, quality) and score all rows. Every given
    row comes back once, repeated rows too."""
    return score(docs, fit(docs, label_categories(labels, key), CATEGORIES, key, text), text)

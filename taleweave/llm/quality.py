"""Text quality by a sparse ensemble of rules.

Boosted trees over text statistics are cut into rules: the conditions on the
way to a node. A lasso logistic regression weighs the rules, and keeps few. The
kept rules are compiled into one column expression over the statistics, so
scoring is a projection.
"""

from __future__ import annotations

import math
import re

from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taleweave.llm.common import settled, short_plans, whole_text

TREES, DEPTH, STEP, LASSO, SEED = 12, 3, 0.3, 0.002, 3

Rule = tuple[tuple[str, str, float], ...]  # (statistic, "<=" or ">", bound), all of which hold


def statistics(text: str = "text") -> dict[str, Column]:
    """Named statistics of a text; all 0 for an empty one."""
    body = whole_text(text)
    chars = F.greatest(F.char_length(body), F.lit(1)).cast("double")
    words = F.filter(F.split(body, "\\s+"), lambda w: w != "")
    lines = F.filter(F.split(body, "\n"), lambda w: w != "")

    def share(pattern: str) -> Column:
        # how much shorter the text is without these characters
        return (F.char_length(body) - F.char_length(F.regexp_replace(body, pattern, ""))) / chars

    return {
        "n_words": F.size(words).cast("double"),
        "word_length": F.char_length(body) / F.greatest(F.size(words), F.lit(1)),
        "distinct_words": F.size(F.array_distinct(words)) / F.greatest(F.size(words), F.lit(1)),
        "distinct_lines": F.size(F.array_distinct(lines)) / F.greatest(F.size(lines), F.lit(1)),
        "words_per_line": F.size(words) / F.greatest(F.size(lines), F.lit(1)),
        "upper": share("\\p{Lu}+"), "digits": share("[0-9]+"), "symbols": share("[%&*#$@|<>{}=~^\\\\+_/\\[\\]]+"),
        "shouts": share("!+"), "stops": share("[.,;:?]+"),
    }


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """The given columns and one struct `_stats`."""
    return docs.withColumn("_stats", F.struct(*[c.alias(n) for n, c in statistics(text).items()]))


def tree_rules(described: str, names: list[str]) -> list[Rule]:
    """Rules of the trees that a model describes: one for every node below a root."""
    rules: dict[Rule, None] = {}
    path: list[tuple[int, tuple[str, str, float]]] = []
    for line in described.splitlines():
        indent = len(line) - len(line.lstrip())
        found = re.match(r"(?:If|Else) \(feature (\d+) (<=|>) ([-+.\dEe]+)\)", line.strip())
        if line.strip().startswith("Tree "):
            path = []
        elif found:
            path = [p for p in path if p[0] < indent]
            path.append((indent, (names[int(found[1])], found[2], float(found[3]))))
            rules[tuple(sorted({c for _, c in path}))] = None
    return list(rules)


def holds(rule: Rule) -> Column:
    """A rule as a column of 0 and 1 over `_stats`."""
    met = F.lit(True)
    for name, sign, bound in rule:
        value = F.col(f"_stats.{name}")
        met = met & (value <= F.lit(bound) if sign == "<=" else value > F.lit(bound))
    return F.when(met, F.lit(1.0)).otherwise(F.lit(0.0))


def fit_rules(labelled: DataFrame, label: str = "label") -> tuple[float, list[tuple[Rule, float]]]:
    """(constant, weighted rules) from rows with `_stats` and a 0/1 label.

    All given rows are used. With one class only, or no rows, there are no
    rules and the constant is the smoothed log odds.
    """
    names = list(statistics())
    flat = labelled.select(*[F.col(f"_stats.{n}").alias(n) for n in names], F.col(label).cast("double").alias("label"))
    n, ones = flat.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    if n == 0 or ones in (0, n):
        return math.log((ones + 0.5) / (n - ones + 0.5)), []
    rows = VectorAssembler(inputCols=names, outputCol="features").transform(flat).select("features", "label")
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, seed=SEED, maxBins=64).fit(rows)
    rules = tree_rules(trees.toDebugString, names)
    ruled = labelled.select(
        array_to_vector(F.array(*[holds(r) for r in rules])).alias("features"),
        F.col(label).cast("double").alias("label"))
    lasso = LogisticRegression(elasticNetParam=1.0, regParam=LASSO, maxIter=60, standardization=False).fit(ruled)
    kept = [(r, float(w)) for r, w in zip(rules, lasso.coefficients) if w]
    return float(lasso.intercept), kept


def compile_score(constant: float, kept: list[tuple[Rule, float]]) -> Column:
    """The probability of good quality as one expression over `_stats`."""
    z = F.lit(constant)
    for rule, weight in kept:
        z = z + holds(rule) * F.lit(weight)
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def score_quality(docs: DataFrame, labels: DataFrame, train=None, key: str = "doc_id", text: str = "text",
                  label: str = "quality", threshold: float = 0.3) -> DataFrame:
    """The given columns with `score` (0 to 1) and `predicted` (score at or
    above the threshold).

    Rules are learned from the labelled rows for which the column expression
    `train` holds (all by default). A null text is empty. Repeated rows are
    scored each. Labels that are null, or without a key, do not count; of a
    repeated key the least label counts. Given columns of the added names are
    replaced. An empty table gives an empty result.
    """
    rows = with_statistics(docs.drop("score", "predicted", "_stats"), text)
    use = rows if train is None else rows.where(train)
    once = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(key).agg(F.min(label).alias("label"))
    labelled = settled(use.select(key, "_stats").join(once, key).select("_stats", "label"), "labelled")
    with short_plans(docs.sparkSession):  # hundreds of rules stand in the plans
        constant, kept = fit_rules(labelled)
    scored = rows.withColumn("score", compile_score(constant, kept)).drop("_stats")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))

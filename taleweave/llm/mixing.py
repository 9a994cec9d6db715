"""Mixing sources by temperature.

A source's token share p becomes the weight p^a / sum(p^a). The exponent a is
found by bisection: entropy grows and repetition grows as a falls from 1 to 0.
Weights become token budgets under which the most plentiful source, against
its weight, is read exactly once; the others repeat. A budget is realised as
block permutations: for every epoch the documents of a source are dealt to
blocks by a digest, blocks are taken in order while the budget lasts, and the
block that meets the end of the budget is cut by row.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from taleweave.llm.common import unit_hash, whole_text

#: Documents of a block, about.
BLOCK_DOCS = 500
#: Sources at most: shares and budgets are held by the driver.
MOST_SOURCES = 100_000


def count_tokens(text: str = "text") -> Column:
    """Words of a text, split at ASCII white space."""
    return F.regexp_count(whole_text(text), F.lit("[^\\x20\\x09-\\x0D]+")).cast("long")


def temper(shares: list[float], exponent: float) -> list[float]:
    raised = [p ** exponent if p > 0 else 0.0 for p in shares]
    total = sum(raised)
    return [r / total for r in raised]


def entropy(weights: list[float]) -> float:
    return -sum(w * math.log(w) for w in weights if w > 0)


def repeats(shares: list[float], exponent: float) -> list[float]:
    """Epochs of each source when none is read less than once."""
    ratios = [w / p for w, p in zip(temper(shares, exponent), shares)]
    least = min(ratios)
    return [r / least for r in ratios]


def bisect_exponent(good, steps: int = 60) -> float:
    """Largest exponent in [0, 1] that is good, if 0 is and badness grows."""
    if good(1.0):
        return 1.0
    low, high = 0.0, 1.0
    for _ in range(steps):
        middle = (low + high) / 2
        low, high = (middle, high) if good(middle) else (low, middle)
    return low


def solve_exponent(shares: list[float], target_entropy: float | None = None,
                   max_repeats: float | None = None) -> float:
    """Exponent that meets a target entropy (a share of the entropy of equal
    weights) without repeating any source more often than the limit; where
    both cannot be met, the limit wins. With the limit alone: the flattest mix
    within it. With neither: 1."""
    goal = 1.0 if target_entropy is None and max_repeats is None else 0.0
    if target_entropy is not None:
        bar = target_entropy * math.log(len(shares)) - 1e-12
        goal = bisect_exponent(lambda a: entropy(temper(shares, a)) >= bar)
    if max_repeats is not None:
        # repetition falls as the exponent rises: search the smallest good one
        limit = 1.0 - bisect_exponent(lambda b: max(repeats(shares, 1.0 - b)) <= max_repeats + 1e-12)
        goal = max(goal, limit)
    return goal


def plan_mix(counted: DataFrame, target_entropy: float | None, max_repeats: float | None,
             source: str = "source", tokens: str = "n_tokens") -> list[dict]:
    """One entry per source: share, weight, budget, whole epochs and the
    tokens left for a last, partial one. A source with empty documents alone
    has no share and is read once."""
    rows = counted.groupBy(source).agg(F.sum(tokens).alias("t"), F.count("*").alias("n")).limit(MOST_SOURCES + 1)
    rows = sorted(rows.collect(), key=lambda r: (r[source] is not None, r[source]))
    if len(rows) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    total = sum(r["t"] for r in rows)
    shares = [r["t"] / total for r in rows if r["t"]]
    exponent = solve_exponent(shares, target_entropy, max_repeats) if shares else 1.0
    mixed = iter(zip(shares, temper(shares, exponent), repeats(shares, exponent)) if shares else [])
    plan = []
    for r in rows:
        share, weight, times = next(mixed) if r["t"] else (0.0, 0.0, 1.0)
        budget = max(r["t"], round(r["t"] * times))
        plan.append({
            "source": r[source], "docs": r["n"], "tokens": r["t"], "share": share, "weight": weight, "budget": budget,
            "epochs": budget // r["t"] if r["t"] else 1, "rest": budget % r["t"] if r["t"] else 0, "exponent": exponent})
    return plan


def mix_sources(docs: DataFrame, target_entropy: float | None = 0.95, max_repeats: float | None = 1.5,
                seed: int = 11, key: str = "doc_id", source: str = "source", tokens: str = "n_tokens",
                block_docs: int = BLOCK_DOCS) -> DataFrame:
    """The rows of the mix: the given columns, with `epoch` (from 0), `block`,
    `weight` of the source and `mix_position` in [0, 1), the share of the
    source's budget that comes before the row. Ordering by `mix_position`
    interleaves the sources by weight.

    `tokens` names a column of token counts (null: none). Every document is in
    epoch 0, so none is lost; in a last, partial epoch a document is taken if
    it begins within the budget. A null source is a source of its own. Empty
    texts come along in whole epochs. Repeated rows are documents of their own
    and may change places. Given columns named like the added ones are
    replaced. An empty table gives an empty result.
    """
    base = docs.drop("epoch", "block", "weight", "mix_position")
    base = base.withColumn(tokens, F.coalesce(F.col(tokens).cast("long"), F.lit(0).cast("long")))
    plan = plan_mix(base, target_entropy, max_repeats, source, tokens)
    planned = docs.sparkSession.createDataFrame(
        [(i, p["source"], p["docs"], p["epochs"], p["rest"], p["budget"], p["tokens"], p["weight"])
         for i, p in enumerate(plan)],
        f"_s int, _source {dict(base.dtypes)[source]}, _docs long, _epochs long, _rest long, _budget long, "
        "_tokens long, weight double")
    # at most MOST_SOURCES rows
    rows = base.join(F.broadcast(planned), base[source].eqNullSafe(planned["_source"])).drop("_source")
    last = F.when(F.col("_rest") > 0, F.col("_epochs")).otherwise(F.col("_epochs") - 1)
    rows = rows.withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    # the permutation of an epoch: blocks by a digest of the row, and the digest within a block
    rows = rows.withColumn("_order", unit_hash(F.lit(seed), F.col("epoch"), F.col(key)))
    rows = rows.withColumn("block", F.floor(
        F.col("_order") * F.ceil(F.col("_docs") / F.lit(block_docs))).cast("long"))
    at = ["_s", "epoch", "block"]
    blocks = rows.groupBy(*at).agg(F.sum(tokens).alias("_size"))
    # one row per block
    through = Window.partitionBy("_s", "epoch").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(*at, F.coalesce(F.sum("_size").over(through), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(*at).orderBy("_order", key).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.join(blocks, at).withColumn("_begins", F.col("_before") + F.sum(tokens).over(inside) - F.col(tokens))
    rows = rows.where((F.col("epoch") < F.col("_epochs")) | (F.col("_begins") < F.col("_rest")))
    spent = F.col("epoch") * F.col("_tokens") + F.col("_begins")
    position = F.when(F.col("_budget") > 0, spent / F.col("_budget")).otherwise(F.lit(0.0))
    return rows.withColumn("mix_position", position).drop(
        "_s", "_docs", "_epochs", "_rest", "_budget", "_tokens", "_order", "_before", "_begins")

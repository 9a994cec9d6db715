"""Score labelled examples and compare setups."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taleweave.functions import lexicon as X
from taleweave.functions.text import col, extract_answer, norm_label, preview, prompt_of, slug
from taleweave.operators import relational as R


def score(examples: DataFrame, scorer: Callable[[pd.Series], pd.Series], prompt: str = "prompt",
          out: str = "generated", error: str | None = None) -> DataFrame:
    """Run a text scorer over Arrow batches: prompts in, generated text out.

    Only the prompts go to Python. When a batch fails its prompts are tried one
    by one, so a prompt that fails gives a null text and leaves the others
    alone, whatever the batches; `error` names a column for what it raised.
    """
    def one(text) -> tuple:
        try:
            return scorer(pd.Series([text], dtype=object)).iloc[0], None
        except Exception as e:
            return None, f"{type(e).__name__}: {e}"

    @F.pandas_udf("text string, error string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for prompts in batches:
            try:
                made, failed = scorer(prompts), None
            except Exception:
                made, failed = zip(*[one(p) for p in prompts])
            yield pd.DataFrame({"text": list(made), "error": failed}, index=prompts.index)

    scored = examples.withColumn("_scored", run(prompt)).withColumn(out, F.col("_scored.text"))
    return (scored.withColumn(error, F.col("_scored.error")) if error else scored).drop("_scored")


def keyword_scorer(rules: list[tuple[str, str]], default: str) -> Callable[[pd.Series], pd.Series]:
    """Scorer that answers with the label of the first word found in a prompt."""
    def run(prompts: pd.Series) -> pd.Series:
        label = pd.Series(default, index=prompts.index, dtype=object)
        for word, name in reversed(rules):
            label = label.mask(prompts.str.contains(re.escape(word), na=False), name)
        return prompts + label + f" {X.END_MARK}"

    return run


def judged(predictions: DataFrame, generated: str = "generated", gold: str = "label") -> DataFrame:
    """Adds pred, pred_norm, gold_norm and correct; a missing answer is wrong
    unless the gold label is missing too."""
    return (
        predictions.withColumn("pred", extract_answer(generated))
        .withColumn("pred_norm", norm_label("pred"))
        .withColumn("gold_norm", norm_label(gold))
        .withColumn("correct", F.col("pred_norm").eqNullSafe(F.col("gold_norm")))
    )


def accuracy(predictions: DataFrame, by=()) -> DataFrame:
    """Examples, correct ones and accuracy; 0.0 on no examples."""
    right = F.coalesce(F.sum(F.col("correct").cast("int")), F.lit(0)).cast("long")
    return predictions.groupBy(*([by] if isinstance(by, str) else by)).agg(
        F.count("*").alias("examples"), right.alias("hits"),
        F.coalesce(F.avg(F.col("correct").cast("double")), F.lit(0.0)).alias("accuracy"))


def mistakes(predictions: DataFrame) -> DataFrame:
    return predictions.where(~F.col("correct"))


def evaluate(examples: DataFrame, scorer, text: str = "text") -> DataFrame:
    """Prompt, score and judge in one chain."""
    return judged(score(examples.withColumn("prompt", prompt_of(text)), scorer))


def compare_setups(results: DataFrame, baseline: str, value: str = "val_loss") -> DataFrame:
    """Setup table with the random baseline row and the forgetting delta."""
    label, task_a, task_b = X.RANDOM_BASELINE
    columns = {"setup": label, "task_a": task_a, "task_b": task_b}
    full = R.with_baseline(results, **{k: v for k, v in columns.items() if k in results.columns})
    return R.delta_vs(full, "setup", baseline, value, "forgetting_delta")


def marker_count(c, markers=tuple(X.MARKERS)) -> Column:
    """Non-overlapping occurrences of any marker, each counted on its own."""
    counts = [F.regexp_count(col(c), F.lit(r"\Q" + m + r"\E")) for m in markers]
    total = counts[0]
    for more in counts[1:]:
        total = total + more
    return total


def marker_hits(samples: DataFrame, by: str, text: str = "text", markers=tuple(X.MARKERS)) -> DataFrame:
    return samples.groupBy(by).agg(F.sum(marker_count(text, markers)).cast("long").alias("hits"))


def sample_report(samples: DataFrame, setup: str, order: str, text: str = "text") -> DataFrame:
    """Per setup: marker hits, preview of the first sample, slug."""
    return samples.groupBy(setup).agg(
        F.sum(marker_count(text)).cast("long").alias("hits"),
        F.min_by(preview(text), F.col(order)).alias("preview"),
    ).withColumn("slug", slug(setup))


def longest_label(examples: DataFrame, label: str = "label") -> DataFrame:
    """Longest label with its end mark: the budget an answer needs."""
    return examples.agg(F.max(F.length(F.concat(F.col(label), F.lit(f" {X.END_MARK}")))).alias("longest"))

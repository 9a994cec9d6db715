"""Character n-gram statistics: counts, next-token distributions, losses."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from taleweave.operators import ordering
from taleweave.session import working_dir


def grams(text, n: int) -> Column:
    """All runs of n characters. The look-ahead captures overlapping runs in
    one pass inside the JVM."""
    return F.regexp_extract_all(text, F.lit("(?s)(?=(" + "." * n + "))"), F.lit(1))


def split_gram(n: int, gram="gram") -> tuple[Column, Column]:
    """Context of n-1 characters and the next character."""
    return F.substring(gram, 1, n - 1), F.substring(gram, n, 1)


def ngram_counts(docs: DataFrame, n: int, by=(), text: str = "text") -> DataFrame:
    """Counts per (context, next). Runs are counted on the map side first, so
    the shuffle carries distinct runs only."""
    by = [by] if isinstance(by, str) else list(by)
    counted = docs.select(*by, F.explode(grams(F.col(text), n)).alias("gram")) \
        .groupBy(*by, "gram").agg(F.count("*").alias("n"))
    context, following = split_gram(n)
    return counted.select(*by, context.alias("context"), following.alias("next"), "n")


def next_token_dist(counts: DataFrame, k: int, temperature: float = 1.0) -> DataFrame:
    """Top-k next tokens per context, ties with the k-th kept, renormalised at
    a temperature. `counts` has (context, next, n); a context has at most one
    row per vocabulary entry, so the window is bounded by the vocabulary."""
    by_context = W.partitionBy("context")
    ranked = counts.withColumn("_rank", F.rank().over(by_context.orderBy(F.desc("n")))).where(F.col("_rank") <= k)
    weight = F.pow(F.col("n").cast("double"), F.lit(1.0 / temperature))
    return ranked.withColumn("_w", weight).withColumn("p", F.col("_w") / F.sum("_w").over(by_context)) \
        .drop("_w", "_rank")


def banded_pieces(docs: DataFrame, order: str, fractions: list[float], max_order: int,
                  train: float = 0.9, text: str = "text") -> DataFrame:
    """Text pieces by position band: band i ends at the i-th prefix of the
    training part, the last band is the validation part.

    A run belongs to the band of its last character, so a training piece
    starts up to `max_order - 1` characters early inside its document
    (`lead` says how many).
    """
    length = F.length(text).cast("long")
    tree = ordering.SumTree(docs, order, length)
    train_total = math.floor(tree.total * train)
    # the last fraction is the whole training part
    ends = [max(1, math.floor(train_total * f)) for f in fractions]
    cut = ordering.pieces(docs, order, length, tree.cuts(ends))
    lead = F.when(F.col("piece") < len(ends), F.least(F.col("piece_from"), F.lit(max_order - 1).cast("long"))) \
        .otherwise(F.lit(0).cast("long"))
    start = F.col("piece_from") - lead
    whole = (start == 0) & (F.col("piece_to") == length)
    part = F.col(text).substr((start + 1).cast("int"), (F.col("piece_to") - start).cast("int"))
    return cut.select(order, F.col("piece").alias("band"), lead.cast("int").alias("lead"),
                      F.when(whole, F.col(text)).otherwise(part).alias(text))


def banded_runs(pieces: DataFrame, longest: int, text: str = "text") -> DataFrame:
    """(band, run, n): for every character the run of up to `longest` that ends
    there, backwards, counted per band. A run is shorter at the start of its
    piece. Written once, as several totals read it."""
    backwards = F.regexp_extract_all(F.reverse(F.col(text)), F.lit(f"(?s)(?=(.{{1,{longest}}}))"), F.lit(1))
    # characters of the lead belong to an earlier band
    own = F.slice(backwards, F.lit(1), F.length(text) - F.col("lead"))
    counted = pieces.select("band", F.explode(own).alias("run")).groupBy("band", "run").agg(F.count("*").alias("n"))
    path = working_dir(pieces.sparkSession, "runs")
    counted.write.parquet(path)
    return pieces.sparkSession.read.schema("band int, run string, n long").parquet(path)


def ngram_loss(docs: DataFrame, order: str, orders: list[int], fractions: list[float],
               add: float = 1.0, text: str = "text") -> DataFrame:
    """Mean negative log-likelihood on the validation part for every n-gram
    order and training fraction, with add-`add` smoothing.

    All orders and fractions come from one scan of the text: the longest runs
    are counted per position band, lower orders are rolled up from them, and
    the bands are summed up. Only distinct runs are shuffled.
    """
    pieces = banded_pieces(docs, order, fractions, max(orders), text=text)
    bands = len(fractions)
    counted = banded_runs(pieces, max(orders), text)
    # a run of a lower order that ends at a character begins the run kept for it
    counted = counted.withColumn("order", F.explode(F.array(*[F.lit(n) for n in orders]))).where("length(run) >= `order`")
    counted = counted.select("band", "order", "n", F.substring("run", 1, 1).alias("next"),
                             F.expr("substring(run, 2, `order` - 1)").alias("context"))
    # one row per run with the training count up to every fraction
    upto = [F.sum(F.when(F.col("band") <= i, F.col("n")).otherwise(0)).alias(f"t{i}") for i in range(bands)]
    held = F.sum(F.when(F.col("band") == bands, F.col("n")).otherwise(0)).alias("held")
    runs = counted.groupBy("order", "context", "next").agg(*upto, held)
    totals = runs.groupBy("order", "context").agg(*[F.sum(f"t{i}").alias(f"c{i}") for i in range(bands)])
    size = counted.where(F.col("band") < bands).agg(F.count_distinct("next").alias("v"))
    scored = runs.where("held > 0").join(totals, ["order", "context"]).join(size)  # one-row side
    aggs = [F.sum("held").alias("tokens")]
    for i in range(bands):
        p = (F.col(f"t{i}") + F.lit(add)) / (F.col(f"c{i}") + F.lit(add) * F.col("v"))
        aggs.append((F.sum(-F.log(p) * F.col("held")) / F.sum("held")).alias(f"loss{i}"))
    wide = scored.groupBy("order").agg(*aggs)
    rows = F.array(*[F.struct(F.lit(f).alias("fraction"), F.col(f"loss{i}").alias("loss")) for i, f in enumerate(fractions)])
    return wide.select(F.col("order").alias("ngram"), "tokens", F.inline(rows))


def cross_entropy(model: DataFrame, held: DataFrame, vocabulary: int, add: float = 1.0, by=()) -> DataFrame:
    """Exact mean negative log-likelihood of counted tokens under counted
    runs. `model` has (context, next, n), `held` has the same per split."""
    by = [by] if isinstance(by, str) else list(by)
    totals = model.groupBy("context").agg(F.sum("n").alias("total"))
    seen = held.withColumnRenamed("n", "held").join(model, ["context", "next"], "left").join(totals, "context", "left")
    p = (F.coalesce("n", F.lit(0)) + F.lit(add)) / (F.coalesce("total", F.lit(0)) + F.lit(add * vocabulary))
    return seen.groupBy(*by).agg(
        F.sum("held").alias("tokens"), (F.sum(-F.log(p) * F.col("held")) / F.sum("held")).alias("loss"))

"""Experiment analytics: plan grid, run summaries, frontier, elapsed time."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from taleweave.functions import lexicon as X
from taleweave.functions.text import col
from taleweave.operators import ordering
from taleweave.operators import relational as R


# --- plan --------------------------------------------------------------------

def param_count(vocab, block, layers, width) -> Column:
    """Weights of a decoder without biases and with a tied output layer."""
    v, t, n, d = (col(c).cast("long") if isinstance(c, str) else c for c in (vocab, block, layers, width))
    return v * d + t * d + n * (12 * d * d + 2 * d) + d


def lora_params(layers, width, rank) -> Column:
    return 4 * col(rank).cast("long") * col(width) * col(layers)


def tokens_seen(iters: int = X.MAX_ITERS) -> int:
    return X.BATCH_SIZE * X.BLOCK_SIZE * X.ACCUMULATION * iters


def model_grid(spark: SparkSession) -> DataFrame:
    rows = [F.struct(F.lit(i).alias("model_order"), F.lit(n).alias("model_size"), F.lit(l).alias("n_layer"),
                     F.lit(h).alias("n_head"), F.lit(d).alias("n_embd")) for i, (n, l, h, d) in enumerate(X.MODEL_GRID)]
    return spark.range(1).select(F.inline(F.array(*rows)))


def fraction_grid(spark: SparkSession) -> DataFrame:
    rows = [F.struct(F.lit(i).alias("data_order"), F.lit(n).alias("dataset_size"), F.lit(f).alias("dataset_fraction"))
            for i, (n, f) in enumerate(X.FRACTIONS)]
    return spark.range(1).select(F.inline(F.array(*rows)))


def plan(corpus: DataFrame) -> DataFrame:
    """Model sizes x data fractions. `corpus` is one row (vocabulary,
    train_tokens, val_tokens); both grids are fixed lists of four."""
    spark = corpus.sparkSession
    grid = model_grid(spark).crossJoin(fraction_grid(spark)).crossJoin(corpus)  # 4 x 4 x 1 rows
    seen = F.lit(tokens_seen()).cast("long")
    available = F.greatest(F.lit(1).cast("long"), F.floor(F.col("train_tokens") * F.col("dataset_fraction")))
    grid = grid.withColumn("param_count", param_count("vocabulary", F.lit(X.BLOCK_SIZE), "n_layer", "n_embd"))
    grid = grid.withColumn("train_tokens_available", available).withColumn("tokens_seen", seen)
    return grid.select(
        "model_order", "model_size", "n_layer", "n_head", "n_embd", "data_order", "dataset_size", "dataset_fraction",
        "train_tokens_available", "val_tokens", "param_count",
        (F.col("train_tokens_available") / F.col("param_count")).alias("dataset_tokens_per_param"),
        "tokens_seen",
        (F.col("tokens_seen") / F.col("param_count")).alias("tokens_seen_per_param"),
        (6 * F.col("param_count") * F.col("tokens_seen")).alias("estimated_total_flops"),
    ).orderBy("model_order", "data_order")


# --- runs --------------------------------------------------------------------

def run_steps(runs: DataFrame) -> DataFrame:
    """Long form (run, step, train_loss, val_loss) of array histories."""
    zipped = F.arrays_zip("steps", "train_loss", "val_loss")
    return runs.select("run", F.inline(zipped)).withColumnRenamed("steps", "step")


def run_summary(steps: DataFrame, order: str = "step") -> DataFrame:
    """Final and best losses per run from the long form.

    Only `max_by`, `min` and `count`: a long run never gathers in one task.
    """
    return steps.groupBy("run").agg(
        F.count("*").alias("points"),
        F.max_by("train_loss", order).alias("final_train"),
        F.max_by("val_loss", order).alias("final_val"),
        F.min("val_loss").alias("best_val"),
    ).withColumn("gap", F.col("final_val") - F.col("final_train"))


#: Points of a part of a stored run.
PART_POINTS = 4096


def run_parts(steps: DataFrame, order="step", points: int = PART_POINTS) -> DataFrame:
    """Array histories (run, part, steps, train_loss, val_loss) from the long
    form: numbered parts of a bounded length, so that a run of any length is
    spread over tasks and rows."""
    order = [order] if isinstance(order, str) else list(order)
    placed = ordering.ordinal(steps, order, "run", "_n").withColumn("part", F.floor((F.col("_n") - 1) / points).cast("int"))
    listed = F.array_sort(F.collect_list(F.struct("_n", "step", "train_loss", "val_loss")))
    rows = placed.groupBy("run", "part").agg(listed.alias("p"))
    return rows.select("run", "part", F.transform("p", lambda p: p["step"]).alias("steps"),
                       F.transform("p", lambda p: p["train_loss"]).alias("train_loss"),
                       F.transform("p", lambda p: p["val_loss"]).alias("val_loss"))


def history_summary(runs: DataFrame) -> DataFrame:
    """The same from array histories, in parts or whole; an empty history
    gives nulls."""
    part = F.col("part") if "part" in runs.columns else F.lit(0)
    last = F.struct(*[F.try_element_at(F.col(c), F.lit(-1)).alias(c) for c in ("train_loss", "val_loss")])
    rows = runs.groupBy("run").agg(
        F.max_by(last, part).alias("last"), F.min(F.array_min("val_loss")).alias("best_val"))
    final = {c: F.col(f"last.{c}") for c in ("train_loss", "val_loss")}
    return rows.select(
        "run", final["train_loss"].alias("final_train"), final["val_loss"].alias("final_val"), "best_val",
        (final["val_loss"] - final["train_loss"]).alias("gap"))


def run_configs(spark: SparkSession) -> DataFrame:
    names = ["run", "category", "lr", "layers", "embd_heads", "block", "dropout", "iters"]
    rows = [F.struct(*[F.lit(v).alias(n) for n, v in zip(names, r)]) for r in X.RUN_CONFIGS]
    return spark.range(1).select(F.inline(F.array(*rows)))


def summary_table(summaries: DataFrame, configs: DataFrame | None = None) -> DataFrame:
    """Summaries joined with their configuration and category."""
    configs = run_configs(summaries.sparkSession) if configs is None else configs
    return configs.join(summaries, "run").select(
        "category", "run", "lr", "layers", "embd_heads", "block", "dropout", "iters",
        "final_train", "final_val", "best_val", "gap", F.lit("Not Logged").alias("time"))


# --- grid and frontier -------------------------------------------------------

def loss_grid(results: DataFrame, rows: str, columns: str, value: str, row_order: list, column_order: list) -> DataFrame:
    """Pivot in fixed order, four decimals; a missing cell stays null."""
    grid = results.groupBy(rows).pivot(columns, column_order).agg(F.round(F.first(value), 4))
    wanted = results.sparkSession.range(1).select(F.posexplode(F.array(*[F.lit(r) for r in row_order])).alias("_pos", rows))
    return wanted.join(grid, rows, "left").orderBy("_pos").drop("_pos")


def frontier(results: DataFrame, cost: str, value: str, tie: str) -> DataFrame:
    """Best row per cost, then the running best by growing cost.

    The running minimum is cut into cost buckets: a window inside each bucket,
    and the minimum of earlier buckets from a tree over them.
    """
    best = R.best_per(results, cost, value, tie)
    tagged = best.withColumn("_bucket", ordering.bucket_of(best, *ordering.bucket_edges(best, cost)))
    lows = tagged.groupBy(F.lit(0).alias("_all"), "_bucket").agg(F.min(value).alias("_m"))
    levels = ordering.scan_levels(ordering.MOST_BUCKETS)
    none = F.lit(None).cast(dict(lows.dtypes)["_m"])
    carried = ordering.scan_before(
        lows, "_all", "_bucket", "_m", lambda _, values, start: F.least(F.array_min(values), start), none, levels, "_carry") \
        .select("_bucket", "_carry")
    inside = W.partitionBy("_bucket").orderBy(cost).rowsBetween(W.unboundedPreceding, 0)
    return tagged.withColumn("_local", F.min(value).over(inside)).join(carried, "_bucket") \
        .withColumn("best_so_far", F.least("_local", "_carry")).drop("_bucket", "_local", "_carry")


# --- elapsed time and staleness ----------------------------------------------

def recover_elapsed(artifacts: DataFrame, label: str, stamp: str, keys=()) -> DataFrame:
    """Minutes between neighbouring timestamps, clipped at zero; the first
    artefact takes the median gap. A single artefact has none."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    timed = artifacts.select(*keys, label, stamp)
    gaps = ordering.previous_value(timed, [stamp, label], stamp, keys, "_previous")
    micros = F.unix_micros(F.col(stamp).cast("timestamp")) - F.unix_micros(F.col("_previous").cast("timestamp"))
    gaps = R.settle(gaps.withColumn("gap", F.when(
        F.col("_previous").isNotNull(), F.greatest(micros / F.lit(60e6), F.lit(0.0)))))
    middle = ordering.exact_median(gaps, "gap", keys, "_median")
    filled = gaps.join(middle, keys, "left") if keys else gaps.join(middle)
    return filled.select(*keys, label, F.coalesce("gap", "_median").alias("elapsed_minutes"))


def stale(artifacts: DataFrame, inputs: DataFrame, key: str, base_stamp: Column | None = None) -> DataFrame:
    """Artefacts older than their newest input (or a common base).

    `artifacts` has (key, artifact_ts), null when absent; `inputs` has (key,
    input_ts), many per key. An absent artefact is not stale.
    """
    newest = inputs.groupBy(key).agg(F.max("input_ts").alias("input_ts"))
    joined = artifacts.join(newest, key, "left")
    limit = F.greatest(F.col("input_ts"), base_stamp) if base_stamp is not None else F.col("input_ts")
    return joined.withColumn("stale", F.coalesce(F.col("artifact_ts") < limit, F.lit(False)))


def presence(expected: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """Expected artefacts that are absent, and stale ones with the reason.

    `found` has (key, stale).
    """
    joined = expected.select(key).join(found.select(key, "stale").withColumn("_found", F.lit(True)), key, "left")
    reason = F.when(F.col("_found").isNull(), "absent").when(F.col("stale"), "stale; rerun")
    return joined.withColumn("reason", reason).where(F.col("reason").isNotNull()).select(key, "reason")


def all_present(expected: DataFrame, found: DataFrame, key: str) -> DataFrame:
    joined = expected.select(key).join(found.select(key).distinct().withColumn("_found", F.lit(True)), key, "left")
    return joined.agg(F.coalesce(F.bool_and(F.coalesce("_found", F.lit(False))), F.lit(True)).alias("all_present"))


def elapsed_source(history, estimate) -> tuple[Column, Column]:
    return R.first_known((col(history), "history"), (col(estimate), "checkpoint_timestamp_estimate"))


# --- step logs ---------------------------------------------------------------

def mfu(params, layers, heads, width, block, per_iter, dt, peak: float = X.PEAK_FLOPS) -> Column:
    """Share of peak arithmetic reached in one logged step."""
    n, l, h, d, t = (col(c) for c in (params, layers, heads, width, block))
    per_token = 6 * n + 12 * l * h * F.floor(d / h) * t
    return per_token * t * col(per_iter) / col(dt) / F.lit(peak)


def ema(steps: DataFrame, value: str, order, keys="run", alpha: float = 0.9, out: str = "ema",
        block: int = 1024, fan: int = ordering.FAN) -> DataFrame:
    """Exponential moving average `alpha * last + (1 - alpha) * value`, seeded
    with the first value, per key. With alpha 0 it is the value itself, with
    alpha 1 the first value of the key.

    A step is an affine map of the state, and so is a block of steps: a window
    runs inside each block of a key's steps, and the maps of blocks are
    combined by a tree, so that no window grows with the length of a run.
    """
    if not 0 <= alpha <= 1:
        raise ValueError("alpha must be from 0 to 1")
    if alpha == 0:
        return steps.withColumn(out, F.col(value).cast("double"))
    keys = [keys] if isinstance(keys, str) else list(keys)
    if alpha < 1:  # powers of alpha inside a block stay within a double
        block = max(1, min(block, int(500 / -math.log(alpha))))
    placed = ordering.ordinal(steps, order, keys, "_i").withColumn("_i", F.col("_i") - 1)
    placed = placed.withColumn("_b", F.floor(F.col("_i") / block)).withColumn("_r", F.col("_i") % block)
    # the first value of a key enters whole
    weighted = F.when(F.col("_i") == 0, F.col(value)).otherwise(F.col(value) * (1 - alpha))
    a = F.lit(float(alpha))
    inside = W.partitionBy(*keys, "_b").orderBy("_r").rowsBetween(W.unboundedPreceding, 0)
    local = placed.withColumn("_local", F.sum(weighted / F.pow(a, F.col("_r"))).over(inside) * F.pow(a, F.col("_r")))
    ends = local.groupBy(*keys, "_b").agg(F.max_by("_local", "_r").alias("_end"))

    def after(level: int, values: Column, start: Column) -> Column:
        whole = F.lit(float(alpha) ** (block * fan ** level))  # zero once a double cannot hold it
        return F.aggregate(values, start, lambda state, e: state * whole + e)

    levels = ordering.scan_levels(-(-steps.count() // block), fan)
    carried = ordering.scan_before(ends, keys, "_b", "_end", after, F.lit(0.0), levels, fan=fan)
    named = carried.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_b").alias("_block"), "_state")
    same = F.col("_b") == F.col("_block")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return local.join(named, same).withColumn(
        out, F.col("_local") + F.col("_state") * F.pow(a, F.col("_r") + 1)).select(*steps.columns, out)


# --- low-rank table ----------------------------------------------------------

def lora_table(rows: DataFrame) -> DataFrame:
    """Comparison table sorted by method, rank and setup, rounded for display."""
    ordered = R.order_by_rank(rows)
    return R.rounded(ordered, {"task_a": 4, "task_b": 4, "val_loss": 4, "minutes": 2})

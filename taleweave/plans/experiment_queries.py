"""Experiment analytics over `events` and `documents`.

A user of `events` stands for a run: its events in time order are the logged
steps, `value` the loss or the step time.
"""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from taleweave.functions import lexicon as X
from taleweave.operators import corpus as C
from taleweave.operators import experiments as P
from taleweave.operators import ngram, ordering
from taleweave.operators import relational as R
from taleweave.plans import corpus_queries
from taleweave.plans.base import documents, query, table
from taleweave.session import working_dir
from taleweave.sources import readers, writers

SQL_GRID = "(VALUES " + ", ".join(
    f"({i}, '{n}', {l}, {h}, {d})" for i, (n, l, h, d) in enumerate(X.MODEL_GRID)) + ") m(model_order, model_size, n_layer, n_head, n_embd)"
SQL_FRACTIONS = "(VALUES " + ", ".join(
    f"({i}, '{n}', {f}::DOUBLE)" for i, (n, f) in enumerate(X.FRACTIONS)) + ") f(data_order, dataset_size, dataset_fraction)"
SQL_CORPUS = """
corpus AS (SELECT total, CAST(floor(total * 0.9::DOUBLE) AS BIGINT) AS train, vocabulary FROM (
  SELECT CAST(sum(length(text)) AS BIGINT) AS total,
         (SELECT count(DISTINCT c) FROM (SELECT unnest(string_split(text, '')) AS c FROM documents) WHERE c <> '') AS vocabulary FROM documents))
"""
SQL_PLAN = f"""
{SQL_CORPUS},
plan AS (
  SELECT *, CAST(vocabulary AS BIGINT) * n_embd + 256 * n_embd + n_layer * (12 * n_embd * n_embd + 2 * n_embd) + n_embd AS param_count,
         greatest(1, CAST(floor(train * dataset_fraction) AS BIGINT)) AS train_tokens_available, total - train AS val_tokens, 40960000::BIGINT AS tokens_seen
  FROM {SQL_GRID}, {SQL_FRACTIONS}, corpus)
"""


def _corpus_row(spark, sf):
    stats = C.corpus_stats(documents(spark, sf))
    train = F.floor(F.col("characters") * 0.9)
    return stats.select("vocabulary", train.alias("train_tokens"), (F.col("characters") - train).alias("val_tokens"))


@query("plan_grid", f"""
WITH {SQL_PLAN}
SELECT model_order, model_size, n_layer, n_head, n_embd, data_order, dataset_size, dataset_fraction, train_tokens_available, val_tokens, param_count,
       round(train_tokens_available / param_count, 9) AS dataset_tokens_per_param, tokens_seen, round(tokens_seen / param_count, 9) AS tokens_seen_per_param,
       CAST(6 * param_count * tokens_seen AS BIGINT) AS estimated_total_flops, CAST(4 * 4 * n_embd * n_layer AS BIGINT) AS lora_params FROM plan""")
def plan_grid(spark, sf):
    grid = P.plan(_corpus_row(spark, sf))
    grid = grid.withColumn("lora_params", P.lora_params("n_layer", "n_embd", F.lit(4)))
    return R.rounded(grid, {"dataset_tokens_per_param": 9, "tokens_seen_per_param": 9})


# --- runs --------------------------------------------------------------------

SQL_STEPS = """
steps AS (SELECT user_id AS run, ts, event_id, value AS val_loss, value / 2.0 + (event_id % 7) AS train_loss FROM events)
"""


def _steps(spark, sf):
    return table(spark, sf, "events").select(
        F.col("user_id").alias("run"), "ts", "event_id", F.col("value").alias("val_loss"),
        (F.col("value") / 2.0 + F.col("event_id") % 7).alias("train_loss"))


@query("run_summary", f"""
WITH {SQL_STEPS}
SELECT run, count(*) AS points, round(arg_max(train_loss, event_id), 6) AS final_train, round(arg_max(val_loss, event_id), 6) AS final_val,
       round(min(val_loss), 6) AS best_val, round(arg_max(val_loss, event_id) - arg_max(train_loss, event_id), 6) AS gap FROM steps GROUP BY run""")
def run_summary(spark, sf):
    return R.rounded(P.run_summary(_steps(spark, sf), "event_id"), {c: 6 for c in ("final_train", "final_val", "best_val", "gap")})


SQL_CONFIGS = "(VALUES " + ", ".join(
    f"({i}, '{r[0]}', '{r[1]}', '{r[2]}', {r[3]}, {r[7]})" for i, r in enumerate(X.RUN_CONFIGS)) + ") c(no, run_name, category, lr, layers, iters)"


@query("summary_table", f"""
WITH {SQL_STEPS},
s AS (SELECT run, arg_max(train_loss, event_id) AS final_train, arg_max(val_loss, event_id) AS final_val FROM steps GROUP BY run)
SELECT category, run_name AS run, lr, layers, iters, round(final_train, 4) AS final_train, round(final_val, 4) AS final_val, 'Not Logged' AS time
FROM s JOIN {SQL_CONFIGS} ON c.no = s.run % (SELECT count(*) FROM {SQL_CONFIGS})""")
def summary_table(spark, sf):
    """Runs named by their number, joined with configuration and category;
    several runs may share a configuration."""
    names = [n for n, *_ in X.RUN_CONFIGS]
    named = P.run_summary(_steps(spark, sf), "event_id").withColumn(
        "run", F.get(F.array(*[F.lit(n) for n in names]), F.pmod("run", F.lit(len(names))).cast("int")))
    full = P.summary_table(named).select("category", "run", "lr", "layers", "iters", "final_train", "final_val", "time")
    return R.rounded(full, {"final_train": 4, "final_val": 4})


@query("selected_runs", """
WITH w AS (SELECT DISTINCT user_id * 3 AS run FROM events), s AS (SELECT user_id AS run, min(value) AS best FROM events GROUP BY 1)
SELECT w.run, round(s.best, 6) AS best_val, s.run IS NOT NULL AS present FROM w LEFT JOIN s ON s.run = w.run""")
def selected_runs(spark, sf):
    steps = _steps(spark, sf)
    summary = P.run_summary(steps, "event_id").select("run", F.round("best_val", 6).alias("best_val"))
    wanted = steps.select((F.col("run") * 3).alias("run")).distinct()
    return R.select_runs(summary, wanted).select("run", "best_val", "present")


DAYS = [f"d{day:02d}" for day in range(1, 32)]
SQL_DAYS = ", ".join(f"round(max(v) FILTER (WHERE day = '{d}'), 4) AS {d}" for d in DAYS)


@query("loss_grid", f"""
WITH g AS (SELECT event_type, 'd' || strftime(ts, '%d') AS day, arg_max(value, event_id) AS v FROM events GROUP BY 1, 2)
SELECT event_type, {SQL_DAYS} FROM g GROUP BY 1
UNION ALL SELECT 'absent', {", ".join(["NULL"] * len(DAYS))}""")
def loss_grid(spark, sf):
    events = table(spark, sf, "events")
    cells = events.groupBy("event_type", F.date_format("ts", "'d'dd").alias("day")).agg(F.max_by("value", "event_id").alias("v"))
    kinds = sorted(r["event_type"] for r in events.select("event_type").distinct().collect())  # a few kinds
    return P.loss_grid(cells, "event_type", "day", "v", [*kinds, "absent"], DAYS)


@query("runs_roundtrip", """
SELECT user_id AS run, count(*) AS points, round(arg_max(value, event_id), 6) AS final_val, round(min(value), 6) AS best_val FROM events GROUP BY user_id""")
def runs_roundtrip(spark, sf):
    """Store the whole history of every run in parts, read it back, summarise
    the arrays."""
    folder = working_dir(spark, "runs")
    steps = _steps(spark, sf).select(F.col("run").cast("string").alias("run"), F.col("event_id").cast("int").alias("step"), "train_loss", "val_loss")
    writers.write_runs(P.run_parts(steps, points=16).withColumn("elapsed_minutes", F.lit(None).cast("double")), folder)
    read = readers.read_runs(spark, folder)
    points = read.groupBy("run").agg(F.sum(F.size("steps")).alias("points"))
    stored = P.history_summary(read).join(points, "run")
    return R.rounded(stored.select(F.col("run").cast("long").alias("run"), "points", "final_val", "best_val"), {"final_val": 6, "best_val": 6})


@query("category_order", """
WITH named AS (
  SELECT c_custkey, c_mktsegment, coalesce(n_name, 'nowhere') AS nation, c_acctbal
  FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_nationkey < 20) n ON c_nationkey = n_nationkey),
top AS (SELECT * FROM named ORDER BY c_acctbal DESC, c_custkey LIMIT 40)
SELECT c_custkey, nation, CASE c_mktsegment WHEN 'MACHINERY' THEN 1 WHEN 'BUILDING' THEN 2 ELSE 3 END AS place FROM top""")
def category_order(spark, sf):
    """The customers with the largest balances, named by their nation, in a
    custom order of segments."""
    order = ["MACHINERY", "BUILDING"]
    nations = table(spark, sf, "nation").where("n_nationkey < 20").withColumnRenamed("n_nationkey", "c_nationkey")
    named = R.lookup_dim(table(spark, sf, "customer"), nations, "c_nationkey", "n_name", "nowhere", "nation")
    top = R.limit_ordered(named, [F.desc("c_acctbal"), "c_custkey"], 40)
    return R.order_by_category(top, "c_mktsegment", order).select(
        "c_custkey", "nation", R.category_place("c_mktsegment", order).cast("int").alias("place"))


# --- frontier ----------------------------------------------------------------

@query("frontier", """
WITH r AS (SELECT CAST(floor(value * 10) AS BIGINT) AS cost, event_id, 1.0 / (1.0 + (event_id * 7919) % 1000 + user_id) AS loss FROM events),
b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY cost ORDER BY loss, event_id) AS rn FROM r) WHERE rn = 1)
SELECT cost, event_id, round(loss, 9) AS loss, round(min(loss) OVER (ORDER BY cost), 9) AS best_so_far FROM b""")
def frontier(spark, sf):
    events = table(spark, sf, "events")
    loss = F.lit(1.0) / (F.lit(1.0) + (F.col("event_id") * 7919) % 1000 + F.col("user_id"))
    results = events.select(F.floor(F.col("value") * 10).alias("cost"), "event_id", loss.alias("loss"))
    return R.rounded(P.frontier(results, "cost", "loss", "event_id"), {"loss": 9, "best_so_far": 9})


@query("ngram_frontier", f"""
WITH losses AS (SELECT * FROM ({corpus_queries.SQL_LOSSES}) WHERE ngram <= 2),
t AS (SELECT CAST(floor(sum(length(text)) * 0.9::DOUBLE) AS BIGINT) AS train FROM documents),
c AS (SELECT losses.*, CAST(ngram * floor(train * fraction) AS BIGINT) AS cost FROM losses, t),
b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY cost ORDER BY loss, ngram) AS rn FROM c) WHERE rn = 1)
SELECT ngram, tokens, fraction, loss, cost, min(loss) OVER (ORDER BY cost) AS best_so_far FROM b""")
def ngram_frontier(spark, sf):
    """The n-gram loss grid as a frontier: cost is order x training tokens."""
    docs = documents(spark, sf)
    total = ordering.total_weight(docs, F.length("text").cast("long"))
    losses = ngram.ngram_loss(docs, "doc_id", [1, 2], [f for _, f in X.FRACTIONS])
    train = F.lit(math.floor(total * 0.9))
    costed = losses.withColumn("cost", F.col("ngram") * F.floor(train * F.col("fraction")))
    return R.rounded(P.frontier(costed, "cost", "loss", "ngram"), {"loss": 6, "best_so_far": 6})


# --- elapsed time and staleness ----------------------------------------------

@query("elapsed_recovery", """
WITH g AS (SELECT user_id, event_id, CASE WHEN lag(ts) OVER w IS NOT NULL THEN greatest(date_diff('microsecond', lag(ts) OVER w, ts) / 60e6, 0.0) END AS gap FROM events
           WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
m AS (SELECT user_id, median(gap) AS med FROM g GROUP BY user_id)
SELECT g.user_id, event_id, round(coalesce(gap, med), 6) AS elapsed_minutes FROM g JOIN m ON g.user_id = m.user_id""")
def elapsed_recovery(spark, sf):
    found = P.recover_elapsed(table(spark, sf, "events"), "event_id", "ts", "user_id")
    return found.withColumn("elapsed_minutes", F.round("elapsed_minutes", 6))


@query("median_value", "SELECT event_type, round(median(value), 6) AS median FROM events GROUP BY event_type")
def median_value(spark, sf):
    return ordering.exact_median(table(spark, sf, "events"), "value", "event_type").withColumn("median", F.round("median", 6))


SQL_STALE = """
art AS (SELECT user_id, max(ts) FILTER (WHERE event_type = 'purchase') AS artifact_ts FROM events GROUP BY user_id),
inp AS (SELECT user_id, max(ts) AS input_ts FROM events WHERE event_type = 'view' GROUP BY user_id),
j AS (SELECT art.user_id, artifact_ts, coalesce(artifact_ts < input_ts, false) AS stale FROM art LEFT JOIN inp ON art.user_id = inp.user_id)
"""


def _stale(spark, sf):
    events = table(spark, sf, "events")
    artifacts = events.groupBy("user_id").agg(F.max(F.when(F.col("event_type") == "purchase", F.col("ts"))).alias("artifact_ts"))
    inputs = events.where("event_type = 'view'").select("user_id", F.col("ts").alias("input_ts"))
    return P.stale(artifacts, inputs, "user_id")


@query("stale_artifacts", f"""
WITH {SQL_STALE}
SELECT user_id, stale, artifact_ts IS NULL AS absent FROM j""")
def stale_artifacts(spark, sf):
    return _stale(spark, sf).select("user_id", "stale", F.col("artifact_ts").isNull().alias("absent"))


@query("missing_artifacts", f"""
WITH {SQL_STALE}
SELECT user_id, CASE WHEN artifact_ts IS NULL THEN 'absent' ELSE 'stale; rerun' END AS reason FROM j WHERE artifact_ts IS NULL OR stale""")
def missing_artifacts(spark, sf):
    joined = _stale(spark, sf)
    return P.presence(joined, joined.where(F.col("artifact_ts").isNotNull()), "user_id")


@query("elapsed_source", """
WITH e AS (SELECT user_id, sum(value) FILTER (WHERE event_type = 'purchase') AS h, sum(value) FILTER (WHERE event_type = 'error') AS c FROM events GROUP BY 1)
SELECT user_id, round(coalesce(h, c), 2) AS minutes,
       CASE WHEN h IS NOT NULL THEN 'history' WHEN c IS NOT NULL THEN 'checkpoint_timestamp_estimate' ELSE 'missing' END AS source FROM e""")
def elapsed_source(spark, sf):
    per = table(spark, sf, "events").groupBy("user_id").agg(
        F.sum(F.when(F.col("event_type") == "purchase", F.col("value"))).alias("h"),
        F.sum(F.when(F.col("event_type") == "error", F.col("value"))).alias("c"))
    value, source = P.elapsed_source("h", "c")
    return per.select("user_id", F.round(value, 2).alias("minutes"), source.alias("source"))


@query("file_listing", "SELECT source, true AS found, true AS stamped FROM documents GROUP BY source")
def file_listing(spark, sf):
    """Modification times of the documents stored in files by source."""
    folder = working_dir(spark, "listing")
    documents(spark, sf).select("doc_id", "source").write.partitionBy("source").parquet(folder)
    files = readers.list_files(spark, [folder, folder + "-absent"]).where(F.col("path").endswith(".parquet"))
    source = F.regexp_extract("path", "source=([^/]+)/", 1)
    return files.groupBy(source.alias("source")).agg((F.count("*") > 0).alias("found"), F.bool_and(F.col("modified").isNotNull()).alias("stamped"))


# --- step logs ---------------------------------------------------------------

SQL_MFU = "(6 * 10745088 + 12 * 6 * 6 * 64 * 256) * 256.0::DOUBLE * 64 / (value + 0.001::DOUBLE) / 312e12"


@query("step_log_ema", f"""
WITH RECURSIVE s AS (SELECT user_id, event_id, {SQL_MFU} AS mfu, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events),
e AS (
  SELECT user_id, event_id, n, mfu, mfu AS ema FROM s WHERE n = 1
  UNION ALL
  SELECT s.user_id, s.event_id, s.n, s.mfu, 0.9::DOUBLE * e.ema + 0.1::DOUBLE * s.mfu FROM s JOIN e ON s.user_id = e.user_id AND s.n = e.n + 1)
SELECT user_id, event_id, round(mfu, 6) AS mfu, round(ema, 6) AS ema FROM e""")
def step_log_ema(spark, sf):
    numbers = {"p": 10_745_088, "l": 6, "h": 6, "d": 384, "t": X.BLOCK_SIZE}
    share = P.mfu(*[F.lit(v).cast("double") for v in numbers.values()], F.lit(X.BATCH_SIZE), F.col("value") + 0.001)
    steps = table(spark, sf, "events").select("user_id", "event_id", "ts", share.alias("mfu"))
    smooth = P.ema(steps, "mfu", ["ts", "event_id"], "user_id")
    return R.rounded(smooth.select("user_id", "event_id", "mfu", "ema"), {"mfu": 6, "ema": 6})


# --- report tables -----------------------------------------------------------

@query("lora_table", """
WITH r AS (SELECT event_type || ' ' || (user_id % 5) AS setup, CASE WHEN event_type = 'view' THEN 'Full FT' ELSE 'LoRA' END AS method,
                  CASE WHEN user_id % 5 = 0 THEN '--' ELSE CAST(user_id % 5 * 4 AS VARCHAR) END AS rank,
                  avg(value) / 500 AS task_a, stddev_samp(value) / 500 AS task_b, max(value) AS val_loss, sum(value) AS minutes FROM events GROUP BY 1, 2, 3)
SELECT CAST(row_number() OVER (ORDER BY method, coalesce(TRY_CAST(rank AS INTEGER), 0), setup) AS INTEGER) AS place, setup, method, rank,
       round(task_a, 4) AS task_a, round(task_b, 4) AS task_b, round(val_loss, 4) AS val_loss, round(minutes, 2) AS minutes FROM r""")
def lora_table(spark, sf):
    from pyspark.sql import Window as W

    slot = F.col("user_id") % 5
    rows = table(spark, sf, "events").groupBy(
        F.concat_ws(" ", "event_type", slot.cast("string")).alias("setup"),
        F.when(F.col("event_type") == "view", "Full FT").otherwise("LoRA").alias("method"),
        F.when(slot == 0, "--").otherwise((slot * 4).cast("string")).alias("rank")).agg(
        (F.avg("value") / 500).alias("task_a"), (F.stddev_samp("value") / 500).alias("task_b"),
        F.max("value").alias("val_loss"), F.sum("value").alias("minutes"))
    listed = P.lora_table(rows)
    # the report has one row per setup, method and rank
    place = F.row_number().over(W.orderBy("method", "rank_order", "setup"))
    return R.select_report(listed.withColumn("place", place), {c: c for c in (
        "place", "setup", "method", "rank", "task_a", "task_b", "val_loss", "minutes")}, drop=["rank_order"])

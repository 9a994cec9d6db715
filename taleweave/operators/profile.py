"""Profile a character table and synthesise records from what was learned."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from taleweave.functions import lexicon as X
from taleweave.functions.draws import normal, pick, uniform
from taleweave.functions.text import blank_to_null
from taleweave.operators import ordering
from taleweave.operators import relational as R

RAW_STATS = {"Str": "str", "Dex": "dex", "Con": "con", "Int": "int", "Wis": "wis", "Cha": "cha"}
RAW_NUMBERS = {**RAW_STATS, "HP": "hp", "AC": "ac", "level": "level"}


def clean_characters(raw: DataFrame) -> DataFrame:
    """Typed character table: numbers coerced, core fields required, race and
    class normalised. Keeps the raw pipe lists."""
    df = R.coerce_numeric(R.missing_to_null(raw), RAW_NUMBERS)
    df = R.require(df, ["race", "justClass"])
    df = df.withColumn("race_clean", R.coalesce_col("processedRace", "race"))
    df = df.withColumn("primary_class", R.first_of_list("justClass"))
    return df.withColumnsRenamed(RAW_NUMBERS)


# --- distributions -----------------------------------------------------------

def value_dist(df: DataFrame, column: str, known=None) -> DataFrame:
    """value, p, cdf interval [lo, hi). Intervals follow value order.

    The window runs over distinct values; their counts are pre-aggregated.
    """
    source = df.where(F.col(column).isNotNull())
    if known is not None:
        source = R.filter_known(source, column, known)
    counted = R.settle(source.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n")))
    placed = ordering.running_total(counted, "value", F.col("n"), out="before")
    total = counted.agg(F.sum("n").alias("total"))
    return placed.join(total).select(  # one-row side
        "value", "n",
        (F.col("n") / F.col("total")).alias("p"),
        (F.col("before") / F.col("total")).alias("lo"),
        ((F.col("before") + F.col("n")) / F.col("total")).alias("hi"))


def alignment_dist(df: DataFrame, column: str = "processedAlignment") -> DataFrame:
    """Distribution over the known codes; all `NG` when none is left."""
    dist = value_dist(df, column, list(X.ALIGNMENT_CODES))
    spark = df.sparkSession
    none_left = spark.range(1).join(dist.agg(F.count("*").alias("c"))).where("c = 0").select(
        F.lit("NG").alias("value"), F.lit(0).cast("long").alias("n"),
        F.lit(1.0).alias("p"), F.lit(0.0).alias("lo"), F.lit(1.0).alias("hi"))
    return dist.unionByName(none_left)


def stat_params(df: DataFrame, key: str = "primary_class", stats=tuple(X.STATS)) -> DataFrame:
    """Mean and sample deviation per group and stat, in long form."""
    aggs = [f(s).alias(f"{s}_{n}") for s in stats for n, f in (("mean", F.avg), ("std", F.stddev_samp))]
    wide = df.groupBy(key).agg(*aggs)
    return wide.select(key, F.inline(F.array(*[
        F.struct(F.lit(s).alias("stat"), F.col(f"{s}_mean").alias("mean"), F.col(f"{s}_std").alias("std"))
        for s in stats])))


def global_params(df: DataFrame, stats=tuple(X.STATS + ["hp", "ac", "level"])) -> DataFrame:
    aggs = [f(s).alias(f"{s}_{n}") for s in stats for n, f in (("mean", F.avg), ("std", F.stddev_samp))]
    return df.agg(*aggs).select(F.inline(F.array(*[
        F.struct(F.lit(s).alias("stat"), F.col(f"{s}_mean").alias("mean"), F.col(f"{s}_std").alias("std"))
        for s in stats])))


def params_for(df: DataFrame, params: DataFrame, overall: DataFrame, key: str = "primary_class") -> DataFrame:
    """Parameters of each row's group, else the global ones, one struct per stat.

    Both parameter tables are turned into one row per group (or one row in
    all), so the join adds no rows.
    """
    def packed(frame, by):
        entry = F.struct("stat", F.struct("mean", "std"))
        return frame.groupBy(*by).agg(F.map_from_entries(F.collect_list(entry)).alias("m"))

    grouped = packed(params, [key]).withColumnRenamed("m", "_group")
    whole = packed(overall, []).withColumnRenamed("m", "_global")
    known = df.join(grouped, key, "left").join(whole)  # one-row side
    return known.withColumn("params", F.coalesce("_group", "_global")).drop("_group")


def known_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(F.col(column).alias("value")).where(F.col("value").isNotNull()).distinct().orderBy("value")


def known_items(df: DataFrame, column: str) -> DataFrame:
    """Distinct items of pipe lists, blanks and `NA` left out."""
    items = df.select(F.explode(R.list_items(column)).alias("value"))
    return items.where(F.upper("value") != "NA").distinct().orderBy("value")


def pair_lists(df: DataFrame, names: str, owners: str, order: str) -> DataFrame:
    """Pair the i-th item of one list with the i-th of the other, else its first."""
    paired = df.select(order, R.list_items(owners).alias("_o"), F.posexplode(R.list_items(names)).alias("pos", "name"))
    owner = F.coalesce(F.get("_o", F.col("pos")), F.get("_o", F.lit(0)))
    return paired.select(order, "pos", "name", owner.alias("owner")).where(
        (F.upper("name") != "NA") & F.col("owner").isNotNull())


def first_value_map(pairs: DataFrame, key: str, value: str, order: list[str], defaults: dict | None = None) -> DataFrame:
    """First value seen per key; fixed defaults fill keys never seen.

    Two hash aggregations keep a frequent key from piling up in one task.
    """
    lead, minor = order
    step = pairs.groupBy(key, lead).agg(F.min_by(value, minor).alias(value))
    seen = step.groupBy(key).agg(F.min_by(value, lead).alias(value))
    if not defaults:
        return seen
    rows = F.array(*[F.struct(F.lit(k).alias(key), F.lit(v).alias(value)) for k, v in defaults.items()])
    fixed = pairs.sparkSession.range(1).select(F.inline(rows))
    return seen.unionByName(fixed.join(seen, key, "left_anti"))


def subclass_to_class(df: DataFrame, order: str) -> DataFrame:
    """Lower-cased subclass to class, first one seen, completed by fixed lists."""
    pairs = pair_lists(df, "subclass", "justClass", order).withColumn("name", F.lower("name"))
    fixed = {s.lower(): c for c, names in X.SUBCLASSES.items() for s in names}
    return first_value_map(pairs, "name", "owner", [order, "pos"], fixed)


# --- synthesis ---------------------------------------------------------------

def draw(df: DataFrame, dist: DataFrame, u: str, out: str, slots: int = 4096) -> DataFrame:
    """Weighted draw: the value whose [lo, hi) holds `u`.

    A range join as an equi-join: every interval is listed under the slots of
    [0, 1) it touches, a row looks up its own slot and keeps the one interval
    that holds it. Slots are even because `u` is uniform.
    """
    low = F.floor(F.col("lo") * slots).cast("int")
    high = F.least(F.floor(F.col("hi") * slots).cast("int"), F.lit(slots - 1))
    listed = dist.select("value", "lo", "hi", F.explode(F.sequence(low, high)).alias("_slot"))
    hit = (F.col(u) >= F.col("lo")) & (F.col(u) < F.col("hi"))
    return (
        df.withColumn("_slot", F.floor(F.col(u) * slots).cast("int"))
        .join(listed, "_slot").where(hit)
        .withColumnRenamed("value", out).drop("_slot", "lo", "hi")
    )


def hit_points(con, level, drawn) -> Column:
    """Floor under a drawn value: (trunc((con - 8) / 2) + 4) * level + 10."""
    base = ((con - 8) / F.lit(2)).cast("int")
    return F.greatest((base + 4) * level + 10, drawn)


def drawn_int(z: Column, mean: Column, std: Column, floor_std: bool = True) -> Column:
    """Rounded normal draw; a null mean counts as 10, a null deviation as 2."""
    mean = F.coalesce(mean, F.lit(10.0))
    std = F.coalesce(std, F.lit(2.0))
    if floor_std:
        std = F.greatest(std, F.lit(1.0))
    return F.bround(mean + std * z, 0).cast("int")


class Learned:
    """The small tables that synthesis needs, learned from one clean table."""

    def __init__(self, df: DataFrame):
        self.race = R.settle(value_dist(df, "race_clean"))
        self.primary_class = R.settle(value_dist(df, "primary_class"))
        self.background = R.settle(value_dist(df, "background"))
        self.alignment = R.settle(alignment_dist(df))
        self.params = R.settle(stat_params(df))
        self.overall = R.settle(global_params(df))


def synthesise(keys: DataFrame, learned: Learned, seed: int, key: str = "id",
               overrides: DataFrame | None = None, personality: bool = True) -> DataFrame:
    """One record per key row. The same key and seed give the same record.

    `overrides` (keyed like `keys`) replaces drawn values where non-empty; hit
    points still come from the drawn level and constitution.
    """
    df = keys
    for name, dist in (("race", learned.race), ("primary_class", learned.primary_class),
                       ("background", learned.background), ("alignment_code", learned.alignment)):
        df = draw(df.withColumn("_u", uniform(seed, name, key)), dist, "_u", name).drop("_u")
    df = df.withColumn("alignment", R.lookup("alignment_code", X.ALIGNMENT_CODES, "True Neutral"))
    df = params_for(df, learned.params, learned.overall)

    def bounded(value, low, high):
        return F.greatest(F.lit(low), F.least(F.lit(high), value))

    stats = {
        s: bounded(drawn_int(normal(seed, s, key), F.col("params")[s]["mean"], F.col("params")[s]["std"]), 4, 20)
        for s in X.STATS
    }
    df = df.withColumns(stats)

    def overall(name):
        entry = F.col("_global")[name]
        return drawn_int(normal(seed, name, key), entry["mean"], entry["std"], floor_std=False)

    df = df.withColumn("level", bounded(overall("level"), 1, 20))
    df = df.withColumn("hp", hit_points(F.col("con"), F.col("level"), overall("hp")))
    df = df.withColumn("ac", bounded(overall("ac"), 5, 25)).drop("params", "_global")
    df = df.withColumn("name", F.concat(
        pick(X.FIRST_NAMES, uniform(seed, "first name", key)), F.lit(" "),
        pick(X.LAST_NAMES, uniform(seed, "last name", key))))

    open_fields = ["subclass", "weapon", "emotional_state", "goal", "quirk", "secret"]
    df = df.withColumns({f: F.lit(None).cast("string") for f in open_fields})
    df = df.withColumn("source_prompt", F.lit(""))
    if overrides is not None:
        df = R.apply_overrides(df, R.keyed(overrides), key)
    df = df.withColumns({f: R.clamp(f, low, high) for f, (low, high) in X.CLAMPS.items()})

    def given(field, otherwise):
        return F.coalesce(blank_to_null(field), otherwise)

    details = {
        "subclass": pick(R.options_for("primary_class", X.SUBCLASSES, X.SUBCLASS_DEFAULT), uniform(seed, "subclass", key)),
        "weapon": pick(R.options_for("primary_class", X.WEAPONS, X.WEAPON_DEFAULT), uniform(seed, "weapon", key)),
        "emotional_state": pick(X.EMOTIONAL_STATES, uniform(seed, "emotional_state", key)),
        "goal": pick(X.GOALS, uniform(seed, "goal", key)) if personality else F.lit(""),
        "quirk": pick(X.QUIRKS, uniform(seed, "quirk", key)) if personality else F.lit(""),
        "secret": pick(X.SECRETS, uniform(seed, "secret", key)) if personality else F.lit(""),
    }
    df = df.withColumns({f: given(f, c) for f, c in details.items()})
    return df.withColumn("emotional_state", F.lower("emotional_state"))


def synthesise_n(spark: SparkSession, learned: Learned, n: int, seed: int, **kwargs) -> DataFrame:
    return synthesise(spark.range(n), learned, seed, "id", **kwargs)


def phrase_for(field: str, cls="primary_class", mood="emotional_state") -> Column:
    """Fallback goal, quirk or secret of a class."""
    if field == "goal":
        base = R.lookup(cls, X.GOAL_PHRASES, X.GOAL_PHRASE_DEFAULT)
        return F.when(F.col(mood).isin(X.QUIET_GOAL_MOODS), F.concat(F.lit("quietly "), base)).otherwise(base)
    if field == "quirk":
        base = R.lookup(cls, X.QUIRK_PHRASES, X.QUIRK_PHRASE_DEFAULT)
        return F.when(F.col(mood).isin(X.OPEN_QUIRK_MOODS), F.replace(base, F.lit("quietly "), F.lit(""))).otherwise(base)
    return R.lookup(cls, X.SECRET_PHRASES, X.SECRET_PHRASE_DEFAULT)

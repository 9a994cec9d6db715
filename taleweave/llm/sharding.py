"""Shards of near-equal size by sampled splitters.

Records are ordered by (digest of the text, key), so equal texts lie together.
A size-weighted sample of these keys gives quantile boundaries, which cut the
order into many more ranges than shards. Exact byte and row totals per range
then place every range in the whole; a range is ordered on its own. A range
that more than one shard claims, or that one group of equal texts overfills, is
subdivided by row. Only expressions and shuffles of the given columns are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from taleweave.llm.common import settled, tree_search, unit_hash, whole_text

#: Ranges for each shard at least, rows of a range about, and ranges at most
#: (they are one comparison tree).
RANGES_PER_SHARD = 16
ROWS_PER_RANGE = 1_000_000
MOST_RANGES = 2048
#: Sampled keys for each range, and the share of a shard that a group of equal
#: texts may have and still stay whole.
SAMPLES_PER_RANGE = 24
WHOLE_GROUP = 1 / 200


def text_bytes(text: str = "text") -> Column:
    """UTF-8 bytes of a text, null as none, plus one."""
    return F.octet_length(whole_text(text)).cast("long") + F.lit(1)


def text_group(text: str = "text") -> Column:
    """60 bits of a digest: equal texts have equal values."""
    return F.conv(F.substring(F.md5(whole_text(text)), 1, 15), 16, 10).cast("long")


def _below(cut) -> Column:
    group, key = cut
    group = F.lit(group)
    return (F.col("_group") < group) | ((F.col("_group") == group) & (F.col("_key") < F.lit(key)))


def splitters(rows: DataFrame, ranges: int, total: int, heavy: set[int], seed: int) -> list[tuple[int, int]]:
    """Ascending quantile boundaries of a size-weighted sample of the keys.

    A row is drawn with a chance in proportion to its size, so quantiles of
    the sample are quantiles of the bytes. A boundary that falls into a group
    of equal texts moves to its start, except in a heavy group.
    """
    wanted = ranges * SAMPLES_PER_RANGE  # expected number of rows drawn: bounded by MOST_RANGES
    chance = F.col("_size") * F.lit(wanted / max(total, 1))
    drawn = rows.where(unit_hash(F.lit(seed), F.col("_group"), F.col("_key")) < chance)
    keys = sorted((r["_group"], r["_key"]) for r in drawn.select("_group", "_key").collect())
    at = [keys[len(keys) * i // ranges] for i in range(1, ranges)] if keys else []
    lowest = -(2 ** 63)
    return sorted({(g, k if g in heavy else lowest) for g, k in at})


def assign_shards(docs: DataFrame, shards: int = 8, key: str = "doc_id", size: str = "size", group: str = "group",
                  seed: int = 7) -> DataFrame:
    """The given rows with `shard` (0 .. shards-1), `slot` (gapless from 0 in
    its shard) and `range`.

    Shards follow the order of (group, key) and have near-equal totals of
    `size`: they differ by about one row, or by a group that stays whole
    (at most 1/200 of a shard). A null key sorts first. Repeated equal rows get
    slots of their own. An empty table gives an empty result. The columns
    `_group`, `_key`, `_size` are reserved.
    """
    narrow = docs.withColumns({
        "_group": F.col(group), "_size": F.col(size),
        "_key": F.coalesce(F.col(key).cast("long"), F.lit(-(2 ** 63) + 1))})
    totals = narrow.agg(F.count("*").alias("n"), F.coalesce(F.sum("_size"), F.lit(0)).alias("s")).first()
    count, total = totals["n"], totals["s"]
    whole = total * WHOLE_GROUP / shards
    # groups above the limit: at most shards / WHOLE_GROUP of them, whatever the data
    heavy = narrow.groupBy("_group").agg(F.sum("_size").alias("s"), F.count("*").alias("n")).where(
        (F.col("s") > whole) & (F.col("n") > 1)).select("_group")
    heavy = {r["_group"] for r in heavy.collect()}
    ranges = min(MOST_RANGES, max(shards * RANGES_PER_SHARD, -(-count // ROWS_PER_RANGE)))
    cuts = splitters(narrow, ranges, total, heavy, seed)
    ranged = narrow.withColumn("range", tree_search(_below, cuts).cast("int"))

    # one row per range: its place in bytes and in rows
    each = ranged.groupBy("range").agg(F.sum("_size").alias("s"), F.count("*").alias("n"))
    before, where, row = {}, 0, 0
    for r in sorted(each.collect(), key=lambda r: r["range"]):
        before[r["range"]] = (where, row)
        where, row = where + r["s"], row + r["n"]
    first = _pick(before, 0)
    order = Window.partitionBy("range").orderBy("_group", "_key")
    same = Window.partitionBy("range", "_group")
    ranged = ranged.withColumn("_start", first + F.sum("_size").over(
        order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("_size"))
    ranged = ranged.withColumns({
        "_row": F.row_number().over(order).cast("long") - 1,
        "_group_start": F.min("_start").over(same), "_group_size": F.sum("_size").over(same)})
    split = F.col("_group").isin(*heavy) if heavy else F.lit(False)
    double_middle = F.when(split, F.lit(2) * F.col("_start") + F.col("_size")).otherwise(
        F.lit(2) * F.col("_group_start") + F.col("_group_size"))
    shard = F.least(F.lit(shards - 1), F.expr("double_middle * shards div twice").cast("int"))
    ranged = ranged.withColumns({"double_middle": double_middle, "shards": F.lit(shards).cast("long"),
                                 "twice": F.lit(max(1, 2 * total)).cast("long")})
    ranged = ranged.withColumn("shard", shard).withColumn("_row", F.col("_row") + _pick(before, 1))
    ranged = settled(ranged.drop("double_middle", "shards", "twice", "_start", "_group_start", "_group_size"), "shards")
    starts = {r["shard"]: r["row"] for r in ranged.groupBy("shard").agg(F.min("_row").alias("row")).collect()}
    lead = F.lit(0)
    for s, at in sorted(starts.items()):
        lead = F.when(F.col("shard") == s, F.lit(at)).otherwise(lead)
    return ranged.withColumn("slot", (F.col("_row") - lead).cast("long")).drop("_row", "_group", "_key", "_size")


def _pick(before: dict[int, tuple[int, int]], which: int) -> Column:
    """Value of the row's range, out of a bounded literal list."""
    if not before:
        return F.lit(0).cast("long")
    values = [before.get(i, (0, 0))[which] for i in range(max(before) + 1)]
    literal = F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")
    return F.get(literal, F.col("range"))


def write_shards(docs: DataFrame, path: str, shards: int = 8, text: str = "text", key: str = "doc_id") -> None:
    """Write whole records as Parquet, one folder per shard, in slot order
    within each file."""
    sized = docs.withColumns({"size": text_bytes(text), "group": text_group(text)})
    placed = assign_shards(sized, shards, key=key)
    placed.repartition("shard", "range").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)

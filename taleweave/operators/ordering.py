"""Order-dependent operators that never put a whole table or key in one task.

A global `Window.orderBy` (or one window over a hot key) sorts everything in a
single task. The operators here cut the order into buckets first, aggregate one
small row per bucket, and only then run a window inside each bucket. The bucket
edges come from a deterministic bottom-k hash sample, so they affect balance
but never the result.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from taleweave.session import working_dir

# these bound the work of a task and of the driver; no result depends on them
ROWS_PER_BUCKET = 1_000_000
BUCKETS, MOST_BUCKETS = 64, 4096
SAMPLE_PER_BUCKET = 20
LEAF_ROWS = 100_000
#: Blocks that a level of a scan takes together.
FAN = 64


def _names(columns) -> list[str]:
    return [columns] if isinstance(columns, str) else list(columns)


def _sortable(key: tuple) -> tuple:
    """Python order of key tuples as Spark sorts them: nulls first."""
    return tuple((v is not None, v) for v in key)


def bucket_edges(df: DataFrame, order, buckets: int | None = None) -> tuple[list[str], list[tuple]]:
    """Columns and key tuples that cut `df` into even ranges.

    One pass with a per-partition top-k; the driver sees 20 keys per bucket.
    Without a number of buckets it follows from the number of rows, 64 at
    least. The leading order column alone is used when it has no heavy ties.
    """
    order = _names(order)
    if buckets is None:
        buckets = min(MOST_BUCKETS, max(BUCKETS, df.count() // ROWS_PER_BUCKET))
    wanted = buckets * SAMPLE_PER_BUCKET
    rows = (
        df.select(*order)
        .orderBy(F.xxhash64(*order), *order)
        .limit(wanted)
        .collect()
    )
    sample = sorted((tuple(r) for r in rows), key=_sortable)
    if len(sample) < wanted:  # the table is smaller than the sample: one bucket does
        return order[:1], []
    step = len(sample) / buckets
    edges = sorted({sample[int(step * i)] for i in range(1, buckets)}, key=_sortable)
    leading = {e[0] for e in edges}
    if len(leading) == len(edges):
        return order[:1], [e[:1] for e in edges if e[0] is not None]
    return order, edges


def _literal(df: DataFrame, order: list[str], edge: tuple) -> Column:
    kinds = {f.name: f.dataType for f in df.schema.fields}
    # a zone-less timestamp goes through its text form, free of any time zone
    parts = [
        F.lit(str(v) if v is not None and kinds[c].typeName() == "timestamp_ntz" else v).cast(kinds[c])
        for c, v in zip(order, edge)
    ]
    return parts[0] if len(parts) == 1 else F.struct(*[p.alias(f"k{i}") for i, p in enumerate(parts)])


def _key(order: list[str]) -> Column:
    if len(order) == 1:
        return F.col(order[0])
    return _whole(order)


def _whole(columns: list[str]) -> Column:
    """Columns as one value that is never null: equal where they are equal or
    both null, and ordered with nulls first."""
    return F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(columns)])


def bucket_of(df: DataFrame, order: list[str], edges: list[tuple]) -> Column:
    """Index of the range a row falls in: how many edges are <= its key. A
    null key comes first."""
    key, points = _key(order), [_literal(df, order, e) for e in edges]

    def search(low: int, high: int) -> Column:  # the answer lies in [low, high]
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        below = F.coalesce(key < points[middle], F.lit(True))
        return F.when(below, search(low, middle)).otherwise(search(middle + 1, high))

    return search(0, len(edges))


def _group(keys: list[str]) -> Column:
    return _whole(keys) if keys else F.lit(0)


def running_total(df: DataFrame, order, weight: Column, keys=(), out: str = "start",
                  buckets: int | None = None) -> DataFrame:
    """Exclusive prefix sum of `weight` in `order`, per `keys` if given.

    Pass narrow rows. The row window is partitioned by (keys, bucket), and the
    carried offsets have one row per (key, bucket); both use the same hash
    partitioning, so the rows are shuffled once and a hot key is spread over
    all its buckets. Null keys are a key of their own; null order values come
    first.
    """
    order, keys = _names(order), _names(keys)
    by, edges = bucket_edges(df, order, buckets)
    if not edges:  # fewer rows than the sample: one small window
        whole = W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
        return df.withColumn(out, F.coalesce(F.sum(weight).over(whole), F.lit(0)))
    tagged = df.withColumn("_bucket", bucket_of(df, by, edges)).withColumn("_group", _group(keys))
    before = W.partitionBy("_group").orderBy("_bucket")
    offsets = (
        tagged.groupBy("_group", "_bucket")
        .agg(F.sum(weight).alias("_sum"))
        .withColumn("_offset", F.coalesce(
            F.sum("_sum").over(before.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
        .drop("_sum")
    )
    inside = W.partitionBy("_group", "_bucket").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    return (
        tagged.withColumn("_local", F.coalesce(F.sum(weight).over(inside), F.lit(0)))
        .join(offsets, ["_group", "_bucket"])
        .withColumn(out, F.col("_offset") + F.col("_local"))
        .drop("_group", "_bucket", "_offset", "_local")
    )


def ordinal(df: DataFrame, order, keys=(), out: str = "ordinal", buckets: int | None = None) -> DataFrame:
    """1-based position of every row in `order` (per key if given)."""
    counted = running_total(df, order, F.lit(1), keys, "_before", buckets)
    return counted.withColumn(out, (F.col("_before") + 1).cast("long")).drop("_before")


def previous_value(df: DataFrame, order, value: str, keys=(), out: str = "previous",
                   buckets: int | None = None) -> DataFrame:
    """`lag(value)` in `order`, per key, with hot keys split over buckets.

    The first row of a bucket takes the last value of the nearest earlier
    bucket of its key, found on one row per (key, bucket). Null keys are a key
    of their own; null order values come first.
    """
    order, keys = _names(order), _names(keys)
    by, edges = bucket_edges(df, order, buckets)
    if not edges:  # fewer rows than the sample: one small window
        return df.withColumn(out, F.lag(value).over(W.partitionBy(*keys).orderBy(*order)))
    tagged = df.withColumn("_bucket", bucket_of(df, by, edges)).withColumn("_group", _group(keys))
    before = W.partitionBy("_group").orderBy("_bucket")
    tails = (
        tagged.groupBy("_group", "_bucket")
        .agg(F.max_by(F.struct(value), _whole(order))[value].alias("_tail"))
        .withColumn("_carry", F.lag("_tail").over(before))
        .drop("_tail")
    )
    inside = W.partitionBy("_group", "_bucket").orderBy(*order)
    return (
        tagged.withColumn("_n", F.row_number().over(inside))
        .withColumn("_prev", F.lag(value).over(inside))
        .join(tails, ["_group", "_bucket"])
        .withColumn(out, F.when(F.col("_n") == 1, F.col("_carry")).otherwise(F.col("_prev")))
        .drop("_group", "_bucket", "_n", "_prev", "_carry")
    )


def exact_median(df: DataFrame, value: str, keys=(), out: str = "median",
                 buckets: int | None = None) -> DataFrame:
    """Exact median per key by rank over pre-counted values; null keys are a
    key of their own.

    The built-in exact percentile holds all distinct values of a key in one
    buffer; ranking (key, value) counts keeps a hot key distributed.
    """
    keys = _names(keys)
    # pre-counted rows are read by the edge sample, the ranking and the totals
    counted = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_c"))
    ranked = running_total(counted, value, F.col("_c"), keys, "_before", buckets).withColumn("_group", _group(keys))
    totals = counted.groupBy(_group(keys).alias("_group")).agg(F.sum("_c").alias("_total"))
    joined = ranked.join(totals, "_group")
    # 0-based middle positions, equal when the count is odd
    low = F.floor((F.col("_total") - 1) / 2)
    high = F.floor(F.col("_total") / 2)

    def holds(position: Column) -> Column:
        return (F.col("_before") <= position) & (position < F.col("_before") + F.col("_c"))

    middle = joined.where(holds(low) | holds(high))
    return middle.groupBy(*keys).agg(
        ((F.max(value) + F.min(value)) / F.lit(2.0)).alias(out))


def first_n(df: DataFrame, keys, order, n: int) -> DataFrame:
    """First `n` rows per key.

    `row_number() <= n` lets Spark cut every key to `n` rows before the
    shuffle, so a hot key sends at most `n` rows per map task. Spark applies
    that cut up to a session threshold; beyond it the first round runs over
    salted groups here.
    """
    keys, order = _names(keys), _order(order)
    limit = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    if n > limit:
        salted = df.withColumn("_salt", F.pmod(F.xxhash64(*df.columns), F.lit(BUCKETS)))
        df = _ranked(salted, [*keys, "_salt"], order, n).drop("_salt")
    return _ranked(df, keys, order, n)


def _order(order) -> list:
    if isinstance(order, (str, Column)):
        return [order]
    return list(order)


def _ranked(df: DataFrame, keys, order, n: int) -> DataFrame:
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rn", rank).where(F.col("_rn") <= n).drop("_rn")


def last_n(df: DataFrame, keys, order, n: int) -> DataFrame:
    """Last `n` rows per key in `order`."""
    return first_n(df, keys, [F.col(c).desc() for c in _names(order)], n)


def cap_per_key(df: DataFrame, keys, order_key: Column, tie, n: int) -> DataFrame:
    """A seeded random choice of at most `n` rows per key."""
    kept = first_n(df.withColumn("_draw", order_key), keys, ["_draw", *_names(tie)], n)
    return kept.drop("_draw")


def keep_first(df: DataFrame, keys, order) -> DataFrame:
    """De-duplicate on `keys`, keeping the first row in `order`."""
    return first_n(df, keys, order, 1)


# --- scans over blocks --------------------------------------------------------

def scan_levels(blocks: int, fan: int = FAN) -> int:
    """Levels that a tree over so many blocks has below its top."""
    levels = 0
    while blocks > fan:
        blocks, levels = -(-blocks // fan), levels + 1
    return levels


def scan_before(ends: DataFrame, keys, at: str, end: str, fold, zero: Column, levels: int, out: str = "_state",
                fan: int = FAN) -> DataFrame:
    """What all earlier blocks of a key come to: adds `out` to (keys, at, end).

    `fold(level, values, start)` combines the values of consecutive blocks onto
    a start; a value of level l + 1 is the fold of `fan` values of level l. The
    combination is associative, so a tree does: windows and lists have at most
    `fan` rows at every level, whatever the length of a key's run.
    """
    keys = _names(keys)
    if levels == 0:
        values = F.collect_list(end).over(W.partitionBy(*keys).orderBy(at).rowsBetween(-fan, -1))
        return ends.withColumn(out, fold(0, values, zero))
    return _scan_level(ends, keys, at, end, fold, zero, levels, 0, out, fan)


def _scan_level(ends, keys, at, end, fold, zero, levels, level, out, fan):
    group = F.floor(F.col(at) / fan)
    inside = W.partitionBy(*keys, "_up").orderBy(at).rowsBetween(-fan, -1)
    rows = ends.withColumn("_up", group).withColumn("_earlier", F.collect_list(end).over(inside))
    if level == levels:
        return rows.withColumn(out, fold(level, F.col("_earlier"), zero)).drop("_up", "_earlier")
    values = F.transform(F.array_sort(F.collect_list(F.struct(F.col(at).alias("a"), F.col(end).alias("e")))), lambda v: v["e"])
    upper = ends.groupBy(*keys, group.alias("_up")).agg(values.alias("_values")) \
        .select(*keys, F.col("_up").alias(at), fold(level, F.col("_values"), zero).alias(end))
    carried = _scan_level(upper, keys, at, end, fold, zero, levels, level + 1, "_carry", fan)
    carried = carried.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col(at).alias("_at"), "_carry")
    same = F.col("_up") == F.col("_at")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    joined = rows.join(carried, same).withColumn(out, fold(level, F.col("_earlier"), F.col("_carry")))
    return joined.select(*ends.columns, out)


# --- positions in a concatenated corpus -------------------------------------

class Cut:
    """Where one global position falls: inside row `key`, `offset` units in.

    `key` is None when the position is the end of the data. Rows that are equal
    in every column are `copies` alike, one after the other; `into` counts from
    the start of the first of them.
    """

    def __init__(self, position: int, key: tuple | None, offset: int, ties: tuple = (), copies: int = 1, into: int | None = None):
        self.position, self.key, self.offset = position, key, offset
        self.ties, self.copies, self.into = ties, copies, offset if into is None else into

    def __repr__(self):
        return f"Cut({self.position}, {self.key}, {self.offset})"


def total_weight(df: DataFrame, weight: Column) -> int:
    return int(df.agg(F.coalesce(F.sum(weight), F.lit(0)).alias("t")).first()["t"])


TIES = ["_tie0", "_tie1"]


def _ties(df: DataFrame) -> list[Column]:
    """128 bits of a digest of all columns, which settle the order of rows with
    equal keys."""
    # maps cannot be hashed as they are
    values = [F.to_json(F.struct(f.name)) if "map<" in f.dataType.simpleString() else F.col(f.name) for f in df.schema.fields]
    # hashing skips nulls, so where they are is hashed as well
    values += [F.col(c).isNull() for c in df.columns]
    return [F.xxhash64(*values).alias(TIES[0]), F.xxhash64(F.lit(1), *values).alias(TIES[1])]


class SumTree:
    """Sums of a weight over ranges of a table's order, in the shared folder.

    One scan of the table leaves a narrow row (order, digest, weight, copies)
    for each distinct row; these are sorted in ranges, and summed by chunks of
    `leaf_rows` rows and by ranges. A position descends from the ranges' sums,
    one row for each on the driver, to one chunk, which has a window of its own.
    Null order values come first.
    """

    def __init__(self, df: DataFrame, order, weight: Column, leaf_rows: int = LEAF_ROWS):
        self.order, self.spark = _names(order), df.sparkSession
        narrow = self._save(df.select(*self.order, *_ties(df), weight.cast("long").alias("_w")), "narrow")
        keys = [*self.order, *TIES]
        rows = narrow.groupBy(*keys).agg(F.any_value("_w").alias("_w"), F.count("*").alias("_copies"))
        rows = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
        # the second part of the number counts from 0 in every range
        at = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
        rows = rows.select("*", F.spark_partition_id().alias("_part"), at.alias("_at"))
        self.leaves = self._save(rows.withColumn("_chunk", F.expr(f"_at div {leaf_rows}")), "leaves")
        sums = self.leaves.groupBy("_part", "_chunk").agg(F.sum(F.col("_w") * F.col("_copies")).alias("_sum"))
        self.chunks = self._save(sums, "chunks")
        parts = self.chunks.groupBy("_part").agg(F.coalesce(F.sum("_sum"), F.lit(0)).alias("w")).collect()
        self.parts = sorted((r["_part"], int(r["w"])) for r in parts)
        self.total = sum(w for _, w in self.parts)

    def _save(self, df: DataFrame, name: str) -> DataFrame:
        path = working_dir(self.spark, name)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    @staticmethod
    def _descend(nodes: list[tuple], wanted: dict) -> dict:
        """Put positions under the node they fall in: {node: {position: rest}}."""
        starts, running = [], 0
        for _, w in nodes:
            starts.append(running)
            running += w
        found: dict = {}
        for p, rest in wanted.items():
            slot = bisect_right(starts, rest) - 1  # the last of equal starts has the weight
            found.setdefault(nodes[slot][0], {})[p] = rest - starts[slot]
        return found

    def cuts(self, positions: list[int]) -> list[Cut]:
        """The cut at each position."""
        found = {p: Cut(p, None, 0) for p in positions}
        inside = {p: p for p in positions if p < self.total}
        if not inside:
            return [found[p] for p in positions]
        by_part = self._descend(self.parts, inside)
        sums: dict = {}
        for r in self.chunks.where(F.col("_part").isin(list(by_part))).collect():
            sums.setdefault(r["_part"], []).append((r["_chunk"], int(r["_sum"] or 0)))
        by_chunk = {(part, c): rests for part, wanted in by_part.items()
                    for c, rests in self._descend(sorted(sums[part]), wanted).items()}
        here = F.lit(False)
        for part, c in by_chunk:
            here = here | ((F.col("_part") == part) & (F.col("_chunk") == c))
        whole = F.col("_w") * F.col("_copies")
        before = W.partitionBy("_part", "_chunk").orderBy("_at").rowsBetween(W.unboundedPreceding, -1)
        rows = self.leaves.where(here).withColumn("_from", F.coalesce(F.sum(whole).over(before), F.lit(0)))
        hit = F.lit(False)
        for (part, c), rests in by_chunk.items():
            for rest in rests.values():
                hit = hit | ((F.col("_part") == part) & (F.col("_chunk") == c)
                             & (F.col("_from") <= rest) & (F.lit(rest) < F.col("_from") + whole))
        for r in rows.where(hit).collect():  # at most one row for each position
            for p, rest in by_chunk[(r["_part"], r["_chunk"])].items():
                into = rest - r["_from"]
                if 0 <= into < r["_w"] * r["_copies"]:
                    key = tuple(r[c] for c in self.order)
                    found[p] = Cut(p, key, into % r["_w"], tuple(r[t] for t in TIES), r["_copies"], into)
        return [found[p] for p in positions]


def find_cuts(df: DataFrame, order, weight: Column, positions: list[int], leaf_rows: int = LEAF_ROWS) -> list[Cut]:
    """Locate global positions without giving every row its prefix sum. Rows
    with equal order values follow a digest of all their columns."""
    return SumTree(df, order, weight, leaf_rows).cuts(positions)


def _at_cut(df: DataFrame, order: list[str], cut: Cut) -> Column:
    """Whether a row is the one that the cut falls in, or equal to it."""
    ties = _ties(df)
    same = _whole(order) == _whole_literal(df, order, cut.key)
    # digests are computed only for rows of the cut's key
    return F.when(same, (ties[0] == F.lit(cut.ties[0])) & (ties[1] == F.lit(cut.ties[1]))).otherwise(F.lit(False))


def _whole_literal(df: DataFrame, order: list[str], key: tuple) -> Column:
    """A key as a struct like `_whole`, also of one column."""
    if len(order) > 1:
        return _literal(df, order, key)
    return F.struct(_literal(df, order, key).alias("k0"))


def _compare(df: DataFrame, order: list[str], cut: Cut, weight: Column) -> Column:
    """Offset inside each row where the cut falls: 0 after it, all before it."""
    if cut.key is None:
        return weight
    zero = F.lit(0).cast("long")
    key, point = _whole(order), _whole_literal(df, order, cut.key)
    own = F.greatest(zero, F.least(weight, F.lit(cut.into).cast("long") - F.col("_copy") * weight))
    first, second = _ties(df)
    low = (first < F.lit(cut.ties[0])) | ((first == F.lit(cut.ties[0])) & (second < F.lit(cut.ties[1])))
    equal = (first == F.lit(cut.ties[0])) & (second == F.lit(cut.ties[1]))
    return F.when(key < point, weight).when(key > point, zero).when(equal, own).when(low, weight).otherwise(zero)


def pieces(df: DataFrame, order, weight: Column, cuts: list[Cut]) -> DataFrame:
    """Split every row at the cuts: adds `piece`, `piece_from`, `piece_to`.

    `piece` i is the part between cut i-1 and cut i. Rows away from a cut keep
    one piece; nothing is shuffled. The frame has the columns that the cuts
    were found on. Where equal rows straddle a cut, one of them is taken and
    numbered as often as they are many.
    """
    order, given = _names(order), df
    weight = weight.cast("long")
    many = {(c.key, c.ties): c for c in cuts if c.key is not None and c.copies > 1}
    rows = given.withColumn("_copy", F.lit(0).cast("long"))
    for c in many.values():
        rows = rows.where(~_at_cut(given, order, c))
    for c in many.values():
        # one row, so the join sends it to the numbers
        one = given.where(_at_cut(given, order, c)).limit(1)
        numbers = given.sparkSession.range(c.copies).withColumnRenamed("id", "_copy")
        rows = rows.unionByName(numbers.join(F.broadcast(one)).select(*given.columns, "_copy"))
    bounds = [F.lit(0).cast("long")]
    bounds += [_compare(given, order, c, weight) for c in cuts]
    bounds += [weight]
    parts = F.array(*[
        F.struct(F.lit(i).alias("piece"), bounds[i].alias("piece_from"), bounds[i + 1].alias("piece_to"))
        for i in range(len(bounds) - 1)
    ])
    kept = F.filter(parts, lambda p: p["piece_to"] > p["piece_from"])
    return rows.select(*given.columns, F.inline(kept))


def with_last(df: DataFrame, order, out: str) -> DataFrame:
    """Adds `out`, true for the last row in `order` and for no other, even if
    several rows are equal in every column."""
    order = _names(order)
    top = df.agg(F.max(F.struct(_whole(order).alias("k"), *_ties(df))).alias("top")).first()["top"]
    if top is None:
        return df.withColumn(out, F.lit(False))
    cut = Cut(0, tuple(top["k"]), 0, (top[TIES[0]], top[TIES[1]]))
    last = _at_cut(df, order, cut)
    copies = df.where(last).count()
    if copies == 1:
        return df.withColumn(out, last)
    # one row, so the join sends it to the numbers
    numbers = df.sparkSession.range(copies).select((F.col("id") == copies - 1).alias(out))
    equal = numbers.join(F.broadcast(df.where(last).limit(1))).select(*df.columns, out)
    return df.where(~last).withColumn(out, F.lit(False)).unionByName(equal)

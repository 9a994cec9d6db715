"""Small column and table operators shared by the jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from taleweave.functions.text import blank_to_null, col, strip
from taleweave.session import working_dir

MISSING = ["", "NA", "N/A", "NaN", "nan", "NULL", "null", "None", "n/a", "#N/A", "<NA>"]


def settle(df: DataFrame) -> DataFrame:
    """Write a small derived table once to the shared folder and read it back:
    its real size is known, later steps do not make it again, and their plans
    begin at it."""
    path = working_dir(df.sparkSession, "settled")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def keyed(df: DataFrame) -> DataFrame:
    """The right side of a join that has a row or more for each row of the
    input: sorted by key and never broadcast. Spark guesses its size from that
    of its compressed files and of its columns' types, which can be far too low."""
    return df.hint("merge")


def missing_to_null(df: DataFrame, columns=None) -> DataFrame:
    """One rule for every spelling of a missing value in text columns."""
    names = columns or [f.name for f in df.schema.fields if f.dataType.typeName() == "string"]
    return df.withColumns({c: F.when(~F.col(c).isin(MISSING), F.col(c)) for c in names})


def coerce_numeric(df: DataFrame, columns) -> DataFrame:
    """Text to number; what is not a number becomes null."""
    return df.withColumns({c: strip(c).try_cast("double") for c in columns})


def require(df: DataFrame, columns) -> DataFrame:
    return df.na.drop(subset=list(columns))


def coalesce_col(*columns) -> Column:
    return F.coalesce(*[col(c) for c in columns])


def first_of_list(c, separator: str = "|") -> Column:
    return strip(F.split_part(col(c), F.lit(separator), F.lit(1)))


def list_items(c, separator: str = "|") -> Column:
    """Stripped, non-blank items of a delimited text."""
    items = F.transform(F.split(col(c), r"\Q" + separator + r"\E"), lambda i: strip(i))
    return F.filter(items, lambda i: i != "")


def filter_known(df: DataFrame, column: str, codes) -> DataFrame:
    return df.where(F.col(column).isin(list(codes)))


def clamp(c, low: int, high: int) -> Column:
    """Truncate toward zero, then bound."""
    whole = col(c).cast("double")
    whole = F.when(whole < 0, F.ceil(whole)).otherwise(F.floor(whole))
    return F.greatest(F.lit(low).cast("long"), F.least(F.lit(high).cast("long"), whole)).cast("int")


def apply_overrides(base: DataFrame, over: DataFrame, key: str) -> DataFrame:
    """Replace values by non-empty overrides of the same name. Zero is a value,
    an empty text is not."""
    texts = {f.name for f in over.schema.fields if f.dataType.typeName() == "string"}
    fields = [c for c in over.columns if c != key and c in base.columns]
    renamed = over.select(key, *[F.col(c).alias("_o_" + c) for c in fields])
    joined = base.join(renamed, key, "left")
    values = {}
    for c in fields:
        given = blank_to_null("_o_" + c) if c in texts else F.col("_o_" + c)
        values[c] = F.coalesce(given, F.col(c))
    return joined.withColumns(values).drop(*["_o_" + c for c in fields])


def constant_map(pairs: dict) -> Column:
    """A small fixed mapping as a map literal."""
    return F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv])


def lookup(c, pairs: dict, default=None) -> Column:
    """Value of a fixed mapping, else the default."""
    found = F.try_element_at(constant_map(pairs), col(c))
    return found if default is None else F.coalesce(found, F.lit(default))


def options_for(c, options: dict, default: list) -> Column:
    """Option list of a key as an array, else the default list."""
    table = F.create_map(*[x for k, v in options.items() for x in (F.lit(k), F.array(*[F.lit(o) for o in v]))])
    return F.coalesce(F.try_element_at(table, col(c)), F.array(*[F.lit(o) for o in default]))


def lookup_dim(df: DataFrame, dim: DataFrame, key: str, value: str, default, out: str) -> DataFrame:
    """Code to name by a table, left outer with a default."""
    named = dim.select(F.col(key), F.col(value).alias("_v"))
    return df.join(named, key, "left").withColumn(out, F.coalesce("_v", F.lit(default))).drop("_v")


def first_known(*labelled) -> tuple[Column, Column]:
    """First non-null value and the label of where it came from.

    Takes (column, label) pairs; the label is `missing` when all are null.
    """
    value = F.coalesce(*[c for c, _ in labelled])
    source = F.lit("missing")
    for c, label in reversed(labelled):
        source = F.when(c.isNotNull(), F.lit(label)).otherwise(source)
    return value, source


def semi(df: DataFrame, keys: DataFrame, on) -> DataFrame:
    return df.join(keys, on, "left_semi")


def select_runs(df: DataFrame, names: DataFrame, key: str = "run") -> DataFrame:
    """Rows of the chosen names; a name without rows appears with nulls and
    `present` false."""
    tagged = df.withColumn("present", F.lit(True))
    return names.select(key).join(tagged, key, "left").withColumn("present", F.coalesce("present", F.lit(False)))


def counts(df: DataFrame, key) -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("n"))


def category_place(column: str, values: list[str]) -> Column:
    """Place of a category in a custom order; unknown ones come last."""
    place = F.array_position(F.array(*[F.lit(v) for v in values]), F.col(column))
    return F.when(place > 0, place).otherwise(len(values) + 1)


def order_by_category(df: DataFrame, column: str, values: list[str]) -> DataFrame:
    """Sort by a custom order of categories; unknown ones come last."""
    return df.orderBy(category_place(column, values), column)


def order_by_rank(df: DataFrame, method: str = "method", rank: str = "rank", name: str = "setup") -> DataFrame:
    """Sort by method, numeric rank (a non-number counts as 0), name."""
    return df.withColumn("rank_order", F.coalesce(F.col(rank).try_cast("int"), F.lit(0))) \
        .orderBy(method, "rank_order", name)


def limit_ordered(df: DataFrame, order, n: int) -> DataFrame:
    return df.orderBy(*([order] if isinstance(order, (str, Column)) else order)).limit(n)


def rounded(df: DataFrame, digits: dict[str, int]) -> DataFrame:
    return df.withColumns({c: F.round(c, d) for c, d in digits.items()})


def select_report(df: DataFrame, columns: dict[str, str], drop=()) -> DataFrame:
    """Reorder and rename result columns: {column: display name}."""
    return df.drop(*drop).select(*[F.col(c).alias(n) for c, n in columns.items()])


def with_baseline(df: DataFrame, **row) -> DataFrame:
    """Append one constant row; columns not given are null."""
    one = df.sparkSession.range(1).select(*[
        F.lit(row.get(f.name)).cast(f.dataType).alias(f.name) for f in df.schema.fields])
    return df.unionByName(one)


def delta_vs(df: DataFrame, key: str, baseline: str, value: str, out: str = "delta") -> DataFrame:
    """Difference of every row to one baseline row; null without a baseline."""
    base = df.where(F.col(key) == baseline).agg(F.first(value, ignorenulls=True).alias("_base"))
    return df.join(base).withColumn(out, F.col(value) - F.col("_base")).drop("_base")  # one-row side


def arg_best(df: DataFrame, value: str, tie: str, highest: bool = True) -> DataFrame:
    """The row with the best value; ties go to the smallest tie key."""
    order = F.desc_nulls_last(value) if highest else F.asc_nulls_last(value)
    return df.where(F.col(value).isNotNull()).orderBy(order, tie).limit(1)


def best_per(df: DataFrame, key: str, by: str, tie: str) -> DataFrame:
    """Whole row with the smallest `by` per key."""
    rank = F.row_number().over(W.partitionBy(key).orderBy(by, tie))
    return df.withColumn("_rn", rank).where(F.col("_rn") == 1).drop("_rn")

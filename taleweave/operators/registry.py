"""Keyed record registry: conform, upsert, delete, resolve, edit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from taleweave.functions import lexicon as X
from taleweave.functions.records import RECORD_SCHEMA, record_id
from taleweave.functions.text import blank_to_null, strip, to_int
from taleweave.operators import ordering

FIELDS = RECORD_SCHEMA


def conform(df: DataFrame, key="npc_id", keep=()) -> DataFrame:
    """Fixed record schema: unknown columns dropped but those to `keep`, absent
    values take their defaults, a blank id is derived from `key`."""
    keys = [key] if isinstance(key, str) else list(key)
    columns = []
    for field in FIELDS.fields:
        name = field.name
        given = F.col(name).cast(field.dataType) if name in df.columns else F.lit(None).cast(field.dataType)
        if name == "npc_id":
            given = F.coalesce(blank_to_null(given), record_id(*keys))
        elif name in X.RECORD_DEFAULTS:
            given = F.coalesce(given, F.lit(X.RECORD_DEFAULTS[name]).cast(field.dataType))
        elif name == "extra_traits":
            given = F.coalesce(given, F.create_map().cast(field.dataType))
        else:
            given = F.coalesce(given, F.array().cast(field.dataType))
        columns.append(given.alias(name))
    extra = [F.col(c) for c in ("seq", *keep) if c in df.columns]
    return df.select(*columns, *extra)


def upsert(registry: DataFrame, new: DataFrame, key: str = "npc_id", order: str = "seq") -> DataFrame:
    """Latest row per key wins but keeps the first position of its key.

    `new` rows carry `seq` values above the registry's; within a batch a later
    `seq` wins. `min`/`max_by`-style picks combine before the shuffle.
    """
    every = registry.unionByName(new)
    row = F.struct(*[c for c in every.columns if c not in (key, order)])
    picked = every.groupBy(key).agg(F.max_by(row, order).alias("_row"), F.min(order).alias(order))
    return picked.select(key, "_row.*", order).select(*every.columns)


def remove(registry: DataFrame, ids: DataFrame, key: str = "npc_id") -> DataFrame:
    return registry.join(ids.select(key), key, "left_anti")


def resolve(refs: DataFrame, registry: DataFrame, ref: str = "ref") -> DataFrame:
    """Record id of each reference: ordinal, exact id, or name / id in any case.

    An all-digit reference is an ordinal and nothing else. Otherwise an exact
    id wins over the first record (in insertion order) whose name or id equals
    the reference ignoring case. Three equi-joins, ranked.
    """
    asked = refs.select(ref).distinct().withColumn("_ref", strip(ref)).where(F.col("_ref") != "")
    digits = F.regexp_like("_ref", F.lit(r"^\d+$"))
    narrow = registry.select("npc_id", "name", "seq")
    numbered = ordering.ordinal(narrow.select("npc_id", "seq"), "seq")
    by_number = asked.where(digits).withColumn("ordinal", F.col("_ref").try_cast("long")) \
        .join(numbered, "ordinal").select(ref, "npc_id", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("seq"))
    named = asked.where(~digits).withColumn("_low", F.lower("_ref"))
    by_id = named.join(narrow, F.col("_ref") == F.col("npc_id")).select(ref, "npc_id", F.lit(1).alias("rank"), "seq")
    # first record per folded key, so a name shared by many stays one row
    folded = narrow.select(F.explode(F.array_distinct(F.array(F.lower("name"), F.lower("npc_id")))).alias("_low"), "npc_id", "seq")
    first = folded.groupBy("_low").agg(F.min_by("npc_id", "seq").alias("npc_id"), F.min("seq").alias("seq"))
    by_name = named.join(first, "_low").select(ref, "npc_id", F.lit(2).alias("rank"), "seq")
    hits = by_number.unionByName(by_id).unionByName(by_name)
    best = hits.groupBy(ref).agg(F.min_by("npc_id", "rank").alias("npc_id"))
    return refs.join(best, ref, "left")


def _edit_fields(key: str) -> tuple[list[str], list[str]]:
    """Text fields and number fields that an edit may set."""
    kinds = {f.name: f.dataType for f in FIELDS.fields}
    return ([n for n, t in kinds.items() if isinstance(t, T.StringType) and n != key],
            [n for n, t in kinds.items() if isinstance(t, T.IntegerType)])


def edit_reason(key: str = "npc_id") -> Column:
    """Why an edit (field, value) is refused whatever its record; else null."""
    texts, numbers = _edit_fields(key)
    known = F.coalesce(F.col("field").isin(texts + numbers + ["notes"]), F.lit(False))
    return F.when(~known, "unknown field").when(
        F.col("field").isin(numbers) & to_int("value").isNull(), "expects a number")


def apply_edits(records: DataFrame, edits: DataFrame, key: str = "npc_id", order: str = "seq") -> tuple[DataFrame, DataFrame]:
    """Typed single-field edits: (edited records, rejects with a reason).

    `edits` has (key, seq, field, value). The last valid edit per field wins;
    list fields split on commas; a bad number, an unknown field and an id
    without a record are rejected.
    """
    texts, numbers = _edit_fields(key)
    field = F.col("field")
    present = records.select(key).distinct().withColumn("_present", F.lit(True))
    checked = edits.join(present, key, "left").withColumn(
        "reason", F.coalesce(edit_reason(key), F.when(F.col("_present").isNull(), "unknown id"))).drop("_present")
    valid = checked.where(F.col("reason").isNull()).groupBy(key, "field").agg(F.max_by("value", order).alias("value"))
    picks = {f: F.max(F.when(field == f, F.col("value"))) for f in texts + numbers + ["notes"]}
    wide = valid.groupBy(key).agg(*[c.alias("_e_" + f) for f, c in picks.items()])
    joined = records.join(wide, key, "left")
    changes = {f: F.coalesce(F.col("_e_" + f), F.col(f)) for f in texts}
    changes.update({f: F.coalesce(to_int("_e_" + f), F.col(f)) for f in numbers})
    items = F.filter(F.transform(F.split("_e_notes", ","), lambda i: strip(i)), lambda i: i != "")
    changes["notes"] = F.coalesce(items, F.col("notes"))
    given = {f: c for f, c in changes.items() if f in records.columns}
    edited = joined.withColumns(given).drop(*["_e_" + f for f in picks])
    return edited, checked.where(F.col("reason").isNotNull())

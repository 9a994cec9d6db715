"""Land JSON that a model wrote into text: find it, parse it, normalise it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taleweave.functions import lexicon as X
from taleweave.functions import text as T
from taleweave.operators import extract, matching

CANONICAL = X.TEXT_FIELDS + X.NUMBER_FIELDS + ["story"]
MATCHED = ["alignment", "emotional_state", "race", "primary_class", "background", "subclass", "weapon"]


def parse_responses(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Adds `json` (first balanced object) and `payload` (its members, null
    when the text holds no valid object)."""
    found = docs.withColumn("json", T.first_json_object(text))
    return found.withColumn("payload", T.parse_object("json"))


def quarantine(parsed: DataFrame) -> DataFrame:
    """Responses without a usable object, with the reason."""
    reason = F.when(F.col("json").isNull(), "no object").otherwise("invalid json")
    return parsed.where(F.col("payload").isNull()).withColumn("reason", reason)


def _filled(value: Column) -> Column:
    return value.isNotNull() & ~value.isin("", "[]", "{}", "null")


def norm_payload(parsed: DataFrame, key: str = "doc_id") -> DataFrame:
    """Members as rows (key, field, value, pos): empty members dropped, keys
    renamed, unknown keys and nested traits turned into `trait:<key>`. A
    nested object that cannot be parsed stays a trait as its text."""
    def attribute(field, value):
        return F.struct(field.alias("field"), value.alias("value"))

    def named(e):
        return F.struct(extract.canonical_field(T.key_slug(e["key"]), X.PAYLOAD_ALIASES).alias("field"), e["value"].alias("raw"))

    def members(m):
        nested = (m["field"] == "extra_traits") & F.startswith(m["raw"], F.lit("{"))
        inner = F.transform(F.map_entries(T.parse_object(m["raw"])), lambda t: attribute(
            F.concat(F.lit(extract.TRAIT), T.key_slug(t["key"])), T.stringify_json(t["value"])))
        label = F.when(m["field"].isin(CANONICAL), m["field"]).otherwise(F.concat(F.lit(extract.TRAIT), m["field"]))
        whole = F.array(attribute(label, T.stringify_json(m["raw"])))
        return F.coalesce(F.when(nested, inner), whole)

    # one array expression per response, so the text is scanned and parsed once
    filled = F.filter(F.map_entries("payload"), lambda e: _filled(e["value"]))
    every = F.flatten(F.transform(F.transform(filled, named), members))
    rows = parsed.select(key, F.posexplode(every).alias("pos", "a")).select(key, "a.field", "a.value", "pos")
    return rows.where(F.col("value").isNotNull() & (F.col("value") != "") & (F.col("field") != extract.TRAIT))


def norm_field(rows: DataFrame, terms: DataFrame, key: str = "doc_id", cutoff: float = X.VALUE_CUTOFF) -> DataFrame:
    """Clean values by field: whole numbers, names, dictionary spellings. Of
    two spellings of one field the later member that stays after cleaning wins."""
    every = terms.unionByName(extract.fixed_terms(rows.sparkSession))
    asked = rows.where(F.col("field").isin(MATCHED)).select("field", F.col("value").alias("given"))
    known = matching.match_value(asked, every, cutoff).select("field", F.col("given").alias("value"), F.col("value").alias("_known"))
    field = F.col("field")
    cleaned = (
        F.when(field.isin(X.NUMBER_FIELDS), T.to_int("value").cast("string"))
        .when(field == "name", T.clean_name("value"))
        .when(field.isin(MATCHED), F.coalesce("_known", extract.plain_value("field", "value")))
        .otherwise(F.col("value"))
    )
    joined = rows.join(known, ["field", "value"], "left").select(key, "field", cleaned.alias("value"), "pos")
    kept = joined.where(F.col("value").isNotNull() & (F.col("value") != ""))
    return kept.groupBy(key, "field").agg(F.max_by("value", "pos").alias("value"))


def land_responses(docs: DataFrame, terms: DataFrame, explicit: DataFrame | None = None,
                   key: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(attributes, rejects). Explicit attributes beat what the model wrote."""
    parsed = parse_responses(docs, key, text)
    landed = norm_field(norm_payload(parsed, key), terms, key)
    if explicit is not None:
        landed = extract.merge_sources(explicit, landed, key=key).drop("source_rank")
    return landed, quarantine(parsed)

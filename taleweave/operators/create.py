"""From prompts to stored records, as one job."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taleweave.functions import text as T
from taleweave.functions.records import record_id
from taleweave.operators import extract, landing, ordering, profile, registry, render
from taleweave.operators.relational import keyed, settle

DETAILS = ["goal", "quirk", "secret"]


def known_attributes(prompts: DataFrame, terms: DataFrame, class_of_subclass: DataFrame, key: str = "doc_id",
                     text: str = "text") -> DataFrame:
    """(key, field, value) that prompts fix: what patterns and dictionaries
    find, an announced name where they find none, then fuzzy repairs of
    fields still open."""
    said = extract.extract_fields(prompts, terms, class_of_subclass, key, text).select(key, "field", "value")
    hints = prompts.select(key, F.lit("name").alias("field"), T.name_hint(text).alias("value")).where("value IS NOT NULL")
    named = settle(extract.merge_sources(said, hints, key=key).drop("source_rank"))
    repaired = extract.infer_fuzzy(prompts, terms, named, class_of_subclass, key, text)
    return extract.merge_sources(named, repaired, key=key).drop("source_rank")


def create_records(prompts: DataFrame, learned: profile.Learned, terms: DataFrame, class_of_subclass: DataFrame,
                   seed: int, responses: DataFrame | None = None, stored: DataFrame | None = None,
                   key: str = "doc_id", text: str = "text") -> DataFrame:
    """Records made from prompts, added to the stored ones if given.

    What a prompt fixes beats what a model's response (key, text) says, and both
    beat the draws. With responses, details that neither names come from the
    phrases of the class, and a response's story is kept; otherwise they are
    drawn and the story is rendered. `key` names a prompt.
    """
    terms, class_of_subclass = settle(terms), settle(class_of_subclass)
    fixed = known_attributes(prompts, terms, class_of_subclass, key, text)
    if responses is not None:
        fixed = landing.land_responses(responses, terms, fixed, key, text)[0]
    fixed = settle(fixed)
    wide = settle(extract.pivot_fields(fixed, key))
    drawn = profile.synthesise(prompts.select(key), learned, seed, key, wide, personality=responses is None)
    if responses is not None:
        drawn = drawn.withColumns({d: F.coalesce(T.blank_to_null(d), profile.phrase_for(d)) for d in DETAILS})
    stories = fixed.where(F.col("field") == "story").select(key, F.col("value").alias("_story"))
    none = F.create_map().cast("map<string,string>")
    full = drawn.join(keyed(wide.select(key, "extra_traits")), key, "left").join(keyed(stories), key, "left") \
        .withColumn("extra_traits", F.coalesce("extra_traits", none)).drop("source_prompt")
    told = render.render_story(full, seed, key).withColumn("story", F.coalesce("_story", "story"))
    told = told.join(keyed(prompts.select(key, F.col(text).alias("source_prompt"))), key).withColumn("npc_id", record_id(key))
    placed = told.join(keyed(ordering.ordinal(prompts.select(key), key, out="seq")), key)
    if stored is None:
        return registry.conform(placed, key)
    top = stored.agg(F.coalesce(F.max("seq"), F.lit(0)).alias("m")).first()["m"]
    return registry.upsert(stored, registry.conform(placed.withColumn("seq", F.col("seq") + top), key))

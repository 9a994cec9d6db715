"""Attribute extraction from free text, and merging of attribute sources.

Extracted values travel in long form `(doc_id, field, value)` and are pivoted
only when a record is built.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from taleweave.functions import lexicon as X
from taleweave.functions import text as T
from taleweave.operators import matching
from taleweave.operators import relational as R

TRAIT = "trait:"
FIELDS = X.TEXT_FIELDS + X.NUMBER_FIELDS
DICTIONARY_FIELDS = ["race", "primary_class", "background", "subclass", "weapon"]


def fixed_terms(spark: SparkSession) -> DataFrame:
    """Alignment and mood dictionaries as (field, term)."""
    rows = [("alignment", t) for t in X.ALIGNMENTS] + [("emotional_state", t) for t in X.EMOTIONAL_STATES]
    return spark.range(1).select(F.inline(F.array(*[
        F.struct(F.lit(f).alias("field"), F.lit(t).alias("term")) for f, t in rows])))


def canonical_field(key, aliases: dict = X.PAIR_ALIASES) -> Column:
    return F.coalesce(R.lookup(key, aliases), T.col(key))


def _numbers(stat: str) -> list[tuple[str, list[str]]]:
    # when both spellings occur the later one in the list wins
    return [(f"_{stat}{i}", [w]) for i, w in enumerate(reversed(X.STAT_WORDS[stat]))]


#: Number fields read by pattern: where their digits are kept, and the labels before them.
NUMBER_LABELS = {
    "level": [("_level", ["level", "lvl"])], "hp": [("_hp", ["hp", "hit points?"])], "ac": [("_ac", ["ac", "armor class"])],
    **{stat: _numbers(stat) for stat in X.STAT_WORDS},
}


def _said(raw: DataFrame, key: str, text: str) -> DataFrame:
    """(key, field, value) read by pattern: numbers, names and labelled phrases."""
    def phrase(labels):
        return T.text_after(text, labels, folded="_folded")

    fields = {
        "name": T.title(phrase(["name", "named", "called"])),
        "goal": phrase(["goal", "wants", "motivation"]),
        "quirk": phrase(["quirk"]),
        "secret": phrase(["secret"]),
        "subclass_said": T.title(phrase(["subclass", "archetype"])),
        "weapon_said": T.title(F.coalesce(T.blank_to_null(phrase(["weapon"])), T.blank_to_null(T.wielded(text, "_folded")))),
    }
    digits = {name: T.digits_after(text, labels, "_folded") for kept in NUMBER_LABELS.values() for name, labels in kept}
    folded = raw.select(key, text, T.case_folded(text).alias("_folded"))
    # digits are a column of their own: a number refers to them many times
    found = folded.select(key, *[c.alias(f) for f, c in (fields | digits).items()])
    numbers = {f: F.coalesce(*[T.to_int(name) for name, _ in kept]) for f, kept in NUMBER_LABELS.items()}
    return _long(found.select(key, *fields, *[c.alias(f) for f, c in numbers.items()]), key, [*fields, *numbers])


def _long(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    entries = F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value")) for c in columns])
    return df.select(key, F.inline(F.filter(entries, lambda e: e["value"].isNotNull())))


def extract_fields(docs: DataFrame, terms: DataFrame, class_of_subclass: DataFrame,
                   key: str = "doc_id", text: str = "text") -> DataFrame:
    """Attributes of every text: (key, field, value); traits are `trait:<key>`.

    `terms` has (field, term) for the five dictionary fields;
    `class_of_subclass` has (name, owner). Texts are scanned once for patterns
    and once for dictionary runs; only short attribute rows are shuffled.
    """
    raw = docs.select(key, T.strip(text).alias("_text")).where("_text <> ''")
    said = _said(raw, key, "_text")
    every = R.settle(terms.unionByName(fixed_terms(docs.sparkSession)))
    known = matching.match_dictionary(raw, every, key, "_text")
    known = known.withColumn("value", F.when(F.col("field") == "weapon", T.title("value")).otherwise(F.col("value")))
    # dictionary values come before what was said after a label
    order = F.when(F.col("field").endswith("_said"), 1).otherwise(0)
    direct = said.unionByName(known).select(
        key, F.regexp_replace("field", "_said$", "").alias("field"), "value", order.alias("rank"))

    pairs = raw.select(key, F.posexplode(T.labelled_pairs("_text")).alias("pos", "pair")).select(
        key, "pos", F.col("pair.key").alias("said_key"), F.col("pair.value").alias("value"))
    # a repeated key keeps its last value; a text has few pairs
    pairs = pairs.groupBy(key, "said_key").agg(F.max_by("value", "pos").alias("value"), F.min("pos").alias("pos"))
    pairs = pairs.withColumn("field", canonical_field("said_key"))
    pairs = _normalise_pairs(pairs, every, key)
    is_field = F.col("field").isin(FIELDS)
    # a key whose field was read by another pattern is not repeated as a trait
    named = pairs.select(
        key, F.when(is_field, F.col("field")).otherwise(F.concat(F.lit(TRAIT), F.col("field"))).alias("field"), "value",
        F.when(is_field, F.lit(2) + F.col("pos")).otherwise(0).alias("rank"))
    best = direct.unionByName(named).groupBy(key, "field").agg(
        F.min_by("value", "rank").alias("value"), F.min("rank").cast("double").alias("rank"))
    return _with_class(best, class_of_subclass, key)


def _with_class(ranked: DataFrame, class_of_subclass: DataFrame, key: str) -> DataFrame:
    """Add the class of a subclass right after the subclass in rank, so it
    yields to a class found before. Rows of a text are few, so they are held
    as one array and read once."""
    def of(field, column):
        return F.max(F.when(F.col("field") == field, F.col(column)))

    rows = ranked.groupBy(key).agg(
        F.collect_list(F.struct("field", "value")).alias("_rows"),
        F.lower(of("subclass", "value")).alias("name"),
        of("subclass", "rank").alias("_sub"), of("primary_class", "rank").alias("_cls"))
    named = rows.join(class_of_subclass, "name", "left")
    wins = F.col("owner").isNotNull() & (F.col("_cls").isNull() | (F.col("_sub") + 0.5 < F.col("_cls")))
    given = F.struct(F.lit("primary_class").alias("field"), F.col("owner").alias("value"))
    others = F.filter("_rows", lambda r: r["field"] != "primary_class")
    final = F.when(wins, F.concat(others, F.array(given))).otherwise(F.col("_rows"))
    return named.select(key, F.inline(final))


def _normalise_pairs(pairs: DataFrame, terms: DataFrame, key: str) -> DataFrame:
    """Dictionary fields of labelled pairs take the known spelling."""
    spelled = matching.spell(pairs, terms, [key, "said_key"])
    return spelled.withColumn("value", F.coalesce("known", plain_value("field", "value"))).drop("known")


def plain_value(field, value) -> Column:
    """Spelling of a value that no dictionary knows."""
    f, v = T.col(field), T.col(value)
    return (
        F.when(f.isin(DICTIONARY_FIELDS + ["alignment"]), T.title(v))
        .when(f == "emotional_state", F.lower(v))
        .otherwise(v)
    )


def infer_class(attributes: DataFrame, class_of_subclass: DataFrame, key: str = "doc_id") -> DataFrame:
    """Add the class of a known subclass where the class is absent."""
    sub = attributes.where(F.col("field") == "subclass").select(key, F.lower("value").alias("name"))
    has = attributes.where(F.col("field") == "primary_class").select(key)
    inferred = sub.join(R.keyed(has), key, "left_anti").join(class_of_subclass, "name").select(
        key, F.lit("primary_class").alias("field"), F.col("owner").alias("value"))
    return attributes.unionByName(inferred)


def merge_sources(*ranked: DataFrame, key: str = "doc_id") -> DataFrame:
    """Merge attribute tables in order of precedence, the first one strongest.

    Works per (key, field), so traits merge one by one.
    """
    tagged = None
    for rank, frame in enumerate(ranked):
        part = frame.select(key, "field", "value", F.lit(rank).alias("rank")) \
            .where(F.col("value").isNotNull() & (F.col("value") != ""))
        tagged = part if tagged is None else tagged.unionByName(part)
    return tagged.groupBy(key, "field").agg(F.min_by("value", "rank").alias("value"), F.min("rank").alias("source_rank"))


def pivot_fields(attributes: DataFrame, key: str = "doc_id", fields=tuple(FIELDS)) -> DataFrame:
    """One row per key: a column per field and a map of traits.

    One aggregation with conditional picks; a key has few attributes.
    """
    picks = [F.max(F.when(F.col("field") == f, F.col("value"))).alias(f) for f in fields]
    entry = F.when(F.col("field").startswith(TRAIT), F.struct(
        F.substring("field", len(TRAIT) + 1, 1_000_000).alias("key"), F.col("value").alias("value")))
    traits = F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("extra_traits")
    wide = attributes.groupBy(key).agg(*picks, traits)
    return wide.withColumns({f: T.to_int(f) for f in fields if f in X.NUMBER_FIELDS})


def infer_fuzzy(docs: DataFrame, terms: DataFrame, existing: DataFrame, class_of_subclass: DataFrame,
                key: str = "doc_id", text: str = "text", cutoffs: dict = X.FUZZY_CUTOFFS) -> DataFrame:
    """Fuzzy values for fields that no exact source filled, plus the class of
    an inferred subclass. Returns (key, field, value)."""
    every = terms.unionByName(fixed_terms(docs.sparkSession)).where(F.col("field").isin(list(cutoffs)))
    limits = every.withColumn("cutoff", R.lookup("field", cutoffs))
    found = matching.fuzzy_match(docs, limits, key, text).select(key, "field", "value")
    # few short rows, read for the classes and for the result
    fresh = R.settle(found.join(R.keyed(existing.select(key, "field")), [key, "field"], "left_anti"))
    known = fresh.unionByName(existing.select(key, "field", "value"))
    taken = R.keyed(known.select(key, "field"))
    classes = infer_class(known, class_of_subclass, key).join(taken, [key, "field"], "left_anti")
    return fresh.unionByName(classes)


def apply_updates(records: DataFrame, log: DataFrame, attributes: DataFrame, key: str = "npc_id",
                  seq: str = "seq", note_cap: int = 12) -> DataFrame:
    """Apply a log of free-text updates to records.

    `log` has (key, seq, text); `attributes` has (key, seq, field, value), the
    extraction of each log text. The last value per field wins, traits of the
    last update that has any replace the old map whole, numbers are not
    clamped, and every text is kept as a note (last `note_cap`).
    """
    from taleweave.operators.ordering import last_n

    plain = attributes.where(~F.col("field").startswith(TRAIT))
    # min/max_by combine on the map side, so a busy record stays cheap
    last = plain.groupBy(key, "field").agg(F.max_by("value", seq).alias("value"))
    wide = pivot_fields(last, key).drop("extra_traits")
    traits = attributes.where(F.col("field").startswith(TRAIT))
    newest = traits.groupBy(key).agg(F.max(seq).alias(seq))
    trait_map = pivot_fields(traits.join(newest, [key, seq]), key).select(key, F.col("extra_traits").alias("_traits"))
    notes = last_n(log.withColumn("_note", T.strip("text")).where("_note <> ''"), key, [seq], note_cap)
    noted = notes.groupBy(key).agg(F.transform(
        F.array_sort(F.collect_list(F.struct(seq, "_note"))), lambda n: n["_note"]).alias("_notes"))
    merged = R.apply_overrides(records, wide, key).join(trait_map, key, "left").join(noted, key, "left")
    every = F.concat(F.col("notes"), F.coalesce("_notes", F.array().cast("array<string>")))
    from_end = F.greatest(F.size(every) - note_cap, F.lit(0))
    return merged.withColumn("extra_traits", F.coalesce("_traits", "extra_traits")) \
        .withColumn("notes", F.slice(every, from_end + 1, F.lit(note_cap))).drop("_traits", "_notes")

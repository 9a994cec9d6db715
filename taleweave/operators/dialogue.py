"""Conversation analytics: bounded history, intents, replies, suggestions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taleweave.functions import lexicon as X
from taleweave.functions.draws import pick, shuffle_key, uniform
from taleweave.functions.text import col, fill
from taleweave.operators import ordering


def bounded_history(turns: DataFrame, cap: int = 24, key: str = "conv_id", order: str = "turn") -> DataFrame:
    """Last `cap` turns per conversation as an ordered array.

    Turns are cut to `cap` per key before the shuffle, so the array is bounded.
    """
    kept = ordering.last_n(turns, key, [order], cap)
    listed = kept.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(order, "role", F.col("text").alias("content")))).alias("h"))
    return listed.select(key, F.transform("h", lambda t: F.struct(
        t["role"].alias("role"), t["content"].alias("content"))).alias("history"))


def intent(c) -> Column:
    """First intent with a keyword inside the lower-cased text."""
    lowered = F.lower(col(c))
    result = F.lit(X.INTENT_DEFAULT)
    for name, words in reversed(X.INTENT_KEYWORDS):
        hit = F.contains(lowered, F.lit(words[0]))
        for w in words[1:]:
            hit = hit | F.contains(lowered, F.lit(w))
        result = F.when(hit, F.lit(name)).otherwise(result)
    return result


def mood_group(alignment: Column) -> Column:
    """evil before chaotic before lawful, else plain."""
    return (
        F.when(F.endswith(alignment, F.lit("Evil")), "evil")
        .when(F.contains(alignment, F.lit("Chaotic")), "chaotic")
        .when(F.contains(alignment, F.lit("Lawful")), "lawful")
        .otherwise("plain")
    )


def class_group(intent_name: Column, cls: Column) -> Column:
    fight = F.when(cls.isin(X.MARTIAL_CLASSES), "martial").when(cls.isin(X.ARCANE_CLASSES), "arcane")
    threat = F.when(cls.isin(X.BRAWLER_CLASSES), "brawler")
    return F.coalesce(F.when(intent_name == "fight", fight).when(intent_name == "threat", threat), F.lit("*"))


def reply(df: DataFrame, seed: int, key, intent_name: str = "intent") -> Column:
    """Reply line for a turn joined with its persona.

    The line set is the most specific row for (intent, mood, class group); a
    seeded draw picks one line.
    """
    keys = [key] if isinstance(key, str) else list(key)
    persona = {f: F.coalesce(F.col(f), F.lit(d)) if f in df.columns else F.lit(d) for f, d in X.REPLY_DEFAULTS.items()}
    persona["name"] = F.col("name")
    persona["background_lower"] = F.lower(persona["background"])
    mood = mood_group(persona["alignment"])
    group = class_group(F.col(intent_name), persona["primary_class"])
    # generic talk has extra lines by temper, and an evil temper may have both
    extra = F.array_compact(F.array(*[
        F.when(F.contains(persona["alignment"], F.lit(temper.title())), F.lit(line))
        for temper, line in X.GENERIC_EXTRA.items()]))
    lines = F.array().cast("array<string>")
    for name, wanted_mood, wanted_group, texts in sorted(X.REPLY_LINES, key=lambda r: (r[1] != "*", r[2] != "*")):
        options = F.array(*[fill(t, persona) for t in texts])
        if name == X.INTENT_DEFAULT:
            options = F.concat(options, extra)
        fits = F.col(intent_name) == name
        if wanted_mood != "*":
            fits = fits & (mood == wanted_mood)
        if wanted_group != "*":
            fits = fits & (group == wanted_group)
        lines = F.when(fits, options).otherwise(lines)
    return pick(lines, uniform(seed, "reply", *keys))


def suggest(df: DataFrame, n: int = 4, seed: int = 0, key: str = "npc_id") -> Column:
    """`n` suggested questions: the fixed ones plus those the record earns, in
    a seeded order."""
    values = {"weapon": F.lower("weapon")}
    base = [fill(t, values) for t in X.SUGGESTIONS]
    base.append(F.when(F.col("emotional_state").isin(X.GUARDED_MOODS), F.lit(X.GUARDED_SUGGESTION)))
    base.append(F.when(F.size("notes") > 0, F.lit(X.NOTES_SUGGESTION)))
    drawn = F.transform(F.array_compact(F.array(*base)), lambda s: F.struct(
        shuffle_key(seed, "suggest", F.col(key), s).alias("draw"), s.alias("text")))
    return F.slice(F.transform(F.array_sort(drawn), lambda s: s["text"]), 1, n)

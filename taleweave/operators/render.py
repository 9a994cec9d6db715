"""Stories, persona prompts and completion requests as text columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taleweave.functions import lexicon as X
from taleweave.functions.draws import pick, uniform
from taleweave.functions.records import draft_text, locked_json
from taleweave.functions.text import fill, traits_text
from taleweave.operators import relational as R

MESSAGES = "array<struct<role:string,content:string>>"


def _or(df: DataFrame, field: str, default: str) -> Column:
    """Column with the site's default text for a missing value."""
    return F.coalesce(F.col(field), F.lit(default)) if field in df.columns else F.lit(default)


def _traits(df: DataFrame) -> Column:
    return F.col("extra_traits") if "extra_traits" in df.columns else F.create_map().cast("map<string,string>")


def render_story(df: DataFrame, seed: int, key: str = "npc_id", out: str = "story") -> DataFrame:
    """Background story from one of four templates, chosen by a seeded draw."""
    background = _or(df, "background", X.STORY_DEFAULTS["background"])
    values = {
        "name": F.col("name"), "race": F.col("race"), "primary_class": F.col("primary_class"),
        "background": background, "background_lower": F.lower(background),
        "alignment_sentence": R.lookup(_or(df, "alignment", "True Neutral"), X.ALIGNMENT_SENTENCES, ""),
        "traits": traits_text(_traits(df)),
        **{f: _or(df, f, X.STORY_DEFAULTS[f]) for f in ("emotional_state", "goal", "quirk", "secret")},
    }
    opening = pick(F.array(*[fill(t, values) for t in X.STORY_TEMPLATES]), uniform(seed, "story", key))
    more = F.when(F.size(_traits(df)) > 0, fill(X.STORY_TRAITS, values)).otherwise("")
    return df.withColumn(out, F.concat(opening, fill(X.STORY_TAIL, values), more))


def recent_notes(notes="notes", n: int = 3) -> Column:
    """Last `n` notes joined, or a fixed text when there are none."""
    size = F.size(notes)
    tail = F.slice(notes, F.greatest(size - n, F.lit(0)) + 1, F.lit(n))
    return F.when(size > 0, F.array_join(tail, "; ")).otherwise(X.NO_NOTES)


def persona_prompt(df: DataFrame) -> Column:
    values = {f: F.col(f) for f in ("name", "race", "primary_class", "story")}
    values.update({f: _or(df, f, d) for f, d in X.PERSONA_DEFAULTS.items()})
    values["tone"] = R.lookup(values["alignment"], X.ALIGNMENT_TONES, X.TONE_DEFAULT)
    values["mannerism"] = R.lookup("primary_class", X.CLASS_MANNERISMS, X.MANNERISM_DEFAULT)
    traits = _traits(df)
    values["traits"] = F.when(F.size(traits) > 0, traits_text(traits)).otherwise(X.NO_TRAITS)
    values["recent_notes"] = recent_notes() if "notes" in df.columns else F.lit(X.NO_NOTES)
    return fill(X.PERSONA_TEMPLATE, values)


def message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def messages(persona: Column, turns: Column, said: Column, shown: int = 10) -> Column:
    """System prompt, the last turns, then the new input. A role other than
    assistant becomes user."""
    tail = F.slice(turns, F.greatest(F.size(turns) - shown, F.lit(0)) + 1, F.lit(shown))
    spoken = F.transform(tail, lambda t: F.struct(
        F.when(t["role"] == "assistant", "assistant").otherwise("user").alias("role"), t["content"].alias("content")))
    return F.concat(
        F.array(message("system", persona)).cast(MESSAGES), spoken.cast(MESSAGES),
        F.array(message("user", said)).cast(MESSAGES))


def completion_request(prompt: Column, fixed_fields: list[str]) -> Column:
    """Messages that ask a model to fill what is not fixed yet."""
    values = {"prompt": prompt, "locked": locked_json(fixed_fields), "draft": draft_text()}
    return F.array(message("system", F.lit(X.COMPLETION_SYSTEM)), message("user", fill(X.COMPLETION_USER, values)))

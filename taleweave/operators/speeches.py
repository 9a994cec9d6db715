"""Speeches and labelled examples mined from a corpus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from taleweave.functions import lexicon as X
from taleweave.functions.draws import shuffle_key
from taleweave.functions.text import col, norm_speaker, one_line_end, squeeze, strip, syllables
from taleweave.operators import ordering

# Unicode keeps this code point free for internal use; a text that holds it
# anyway loses it before it is used as a separator.
MARK = "\ufdd0"


def is_header(c, max_words: int = 4) -> Column:
    """Whether a stripped line announces a speaker."""
    line = col(c)
    letters = F.length(F.regexp_replace(line, "[^A-Za-z]", ""))
    capitals = F.length(F.regexp_replace(line, "[^A-Z]", ""))
    titled = ~F.regexp_like(line, F.lit("(^|[^A-Za-z])[a-z]|[A-Za-z][A-Z]"))
    return (
        F.regexp_like(line, F.lit(X.SPEAKER_PATTERN))
        & F.regexp_like(line, F.lit("[A-Z]"))
        & (F.size(F.split(line, " +")) <= max_words)
        & ~norm_speaker(line).isin(X.SPEAKER_STOP_WORDS)
        & (titled | (capitals.cast("double") / letters > 0.8))
    )


def clean_lines(lines) -> Column:
    """Lines without stage directions, white space squeezed, blanks dropped."""
    spoken = F.filter(col(lines), lambda l: ~F.regexp_like(l, F.lit(r"^[\[(]")))
    return F.filter(F.transform(spoken, squeeze), lambda l: l != "")


def long_enough(speech, min_chars: int) -> Column:
    return F.length(strip(F.translate(col(speech), "\n", " "))) >= min_chars


def parse_speeches(docs: DataFrame, key="doc_id", text: str = "text", min_chars: int = 40) -> DataFrame:
    """Speaker, lines and text of every speech, numbered inside its document.

    A speech runs from a header line to the next header or blank line. Each
    line is rewritten once: a header becomes a mark and the speaker, a blank
    line a mark alone. Splitting the rejoined text at the marks yields the
    segments, so a document is parsed inside its own row with no shuffle and
    linear work.
    """
    keys = [key] if isinstance(key, str) else list(key)
    clean = F.replace(one_line_end(text), F.lit(MARK), F.lit(""))

    def rewrite(line):
        return F.when(line == "", F.lit(MARK)).when(
            is_header(line), F.concat(F.lit(MARK), norm_speaker(line))).otherwise(line)

    marked = F.transform(F.transform(F.split(clean, "\n"), lambda i: strip(i)), rewrite)
    segments = F.transform(F.split(F.array_join(marked, "\n"), MARK), lambda segment, n: F.struct(
        n.alias("speech_no"), segment.alias("segment")))
    # what precedes the first mark has no speaker, nor has what follows a blank
    spoken = F.filter(segments, lambda s: (s["speech_no"] > 0) & (s["segment"] != "")
                      & ~F.startswith(s["segment"], F.lit("\n")))
    # one value per lambda, so nothing is computed twice
    parts = F.transform(spoken, lambda s: F.struct(
        s["speech_no"].alias("speech_no"), F.split(s["segment"], "\n").alias("parts")))
    cleaned = F.transform(parts, lambda s: F.struct(
        s["speech_no"].alias("speech_no"), F.get(s["parts"], F.lit(0)).alias("speaker"),
        clean_lines(F.slice(s["parts"], F.lit(2), F.size(s["parts"]))).alias("lines")))
    full = F.transform(cleaned, lambda s: F.struct(
        s["speech_no"].alias("speech_no"), s["speaker"].alias("speaker"), s["lines"].alias("lines"),
        F.array_join(s["lines"], "\n").alias("speech_text"), F.size(s["lines"]).alias("num_lines")))
    kept = F.filter(full, lambda s: (s["num_lines"] > 0) & long_enough(s["speech_text"], min_chars))
    return docs.select(*keys, F.inline(kept))


def top_n_frequent(df: DataFrame, value: str, first_seen: list[str], n: int = 10) -> DataFrame:
    """Most frequent values; ties go to the value seen first.

    Two hash aggregations: per (value, leading order column), then per value.
    """
    lead, minor = first_seen
    per_doc = df.groupBy(value, lead).agg(F.count("*").alias("_c"), F.min(minor).alias("_m"))
    totals = per_doc.groupBy(value).agg(
        F.sum("_c").alias("n"), F.min(lead).alias("first_" + lead), F.min_by("_m", lead).alias("first_" + minor))
    return totals.orderBy(F.desc("n"), "first_" + lead, "first_" + minor).limit(n)


def format_example(task: str, passage, label) -> Column:
    mark, answer, end = X.TASK_MARKS[task], X.ANSWER_MARK, X.END_MARK
    return F.concat(F.lit(mark + " "), col(passage), F.lit(f" {answer} "), col(label), F.lit(f" {end}"))


def speaker_examples(speeches: DataFrame, top: DataFrame, per_speaker: int = 80, seed: int = 0,
                     dedup: bool = False, key: str = "doc_id") -> DataFrame:
    """Task A: name the speaker. Keeps the top speakers (a semi join) and a
    seeded choice of at most `per_speaker` speeches each."""
    kept = speeches.join(top.select("speaker"), "speaker", "left_semi")
    if dedup:
        kept = ordering.keep_first(kept, ["speaker", "speech_text"], [key, "speech_no"])
    kept = ordering.cap_per_key(
        kept, "speaker", shuffle_key(seed, "speaker", key, "speech_no"), [key, "speech_no"], per_speaker)
    return kept.select(
        F.lit("A").alias("task"), F.col("speaker").alias("label"),
        F.col("speech_text").alias("input_text"),
        format_example("A", "speech_text", "speaker").alias("text"),
        "num_lines", key, "speech_no")


def classify_speech(lines, verse_lines=(3, 8), verse_chars=(18, 65), verse_syllables=(8, 12),
                    prose_chars: int = 38, prose_syllables: int = 12) -> Column:
    """VERSE, PROSE or null for an array of cleaned lines."""
    lines = col(lines)
    n = F.size(lines)
    measured = F.transform(lines, lambda l: F.struct(
        F.length(strip(l)).alias("chars"), syllables(l).alias("syllables"),
        F.regexp_like(l, F.lit(r"^\p{IsLowercase}")).alias("lower")))

    def count_if(array, test):
        return F.size(F.filter(array, test))

    def judge(m):
        short = count_if(m, lambda x: x["chars"].between(*verse_chars))
        metre = count_if(m, lambda x: x["syllables"].between(*verse_syllables))
        lower = count_if(m, lambda x: x["lower"])
        verse = n.between(*verse_lines) & (short >= n - 1) & (metre >= F.greatest(F.lit(2), n - 1)) & (lower <= 1)
        wide = count_if(m, lambda x: x["chars"] >= prose_chars)
        heavy = count_if(m, lambda x: x["syllables"] >= prose_syllables)
        later = count_if(F.slice(m, F.lit(2), F.size(m)), lambda x: x["lower"])
        prose = (n >= 3) & (wide >= n - 1) & (
            (heavy >= n - 1) | (later >= F.greatest(F.lit(1), F.floor(n / 2).cast("int"))))
        return F.when(verse, "VERSE").when(prose, "PROSE")

    # measured once: the array is bound to one lambda variable
    return F.get(F.transform(F.array(measured), judge), F.lit(0))


def verse_prose_examples(speeches: DataFrame, per_class: int = 350, key: str = "doc_id", **limits) -> DataFrame:
    """Task B: verse or prose. De-duplicates by text in corpus order, then
    keeps the first `per_class` examples of each class."""
    labelled = speeches.withColumn("label", classify_speech("lines", **limits)).where(F.col("label").isNotNull())
    passage = F.when(F.col("label") == "VERSE", F.col("speech_text")).otherwise(F.array_join("lines", " "))
    examples = labelled.withColumn("input_text", passage).select(
        F.lit("B").alias("task"), "label", "input_text",
        format_example("B", "input_text", "label").alias("text"),
        "speaker", "num_lines", key, "speech_no")
    unique = ordering.keep_first(examples, ["label", "text"], [key, "speech_no"])
    return ordering.first_n(unique, "label", [key, "speech_no"], per_class)


def split_fixed(df: DataFrame, n_train: int = 500, n_test: int = 100, seed: int = 0, key=("doc_id", "speech_no")) -> DataFrame:
    """Seeded shuffle, then the first `n_train` rows train and the next `n_test` test."""
    drawn = df.withColumn("_draw", shuffle_key(seed, "split", *key))
    head = drawn.orderBy("_draw", *key).limit(n_train + n_test)
    # the window sees n_train + n_test rows at most
    rank = F.row_number().over(W.orderBy("_draw", *key))
    return (
        head.withColumn("position", rank)
        .withColumn("split", F.when(F.col("position") <= n_train, "train").otherwise("test"))
        .drop("_draw")
    )


def shuffled(df: DataFrame, key, seed: int = 0, purpose: str = "shuffle") -> DataFrame:
    """Rows in a seeded random order (a distributed range sort)."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.withColumn("_draw", shuffle_key(seed, purpose, *keys)).orderBy("_draw", *keys).drop("_draw")


def union_examples(*frames: DataFrame) -> DataFrame:
    """Union of example tables over the superset of their columns."""
    merged = frames[0]
    for other in frames[1:]:
        merged = merged.unionByName(other, allowMissingColumns=True)
    return merged

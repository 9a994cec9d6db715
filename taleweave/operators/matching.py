"""Dictionary matching: exact containment and fuzzy similarity as joins."""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from taleweave.functions.text import col, norm_phrase
from taleweave.operators import relational as R

TOKEN = r"(?U)(\w+)"
#: First words of a dictionary up to which runs are looked at before the join.
FIRST_WORDS = 2000
#: Bytes of a text that goes along with its runs, and terms up to which the
#: dictionary is small beside any table of texts, so that runs need no shuffle.
CARRIED_BYTES, FEW_TERMS = 4096, 50_000


def words_of(c) -> Column:
    return F.regexp_extract_all(F.lower(col(c)), F.lit(TOKEN), F.lit(1))


def _once(value: Column, use) -> Column:
    """Apply `use` to a value that is computed once: a lambda variable holds it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def windows(tokens: Column, widths, firsts: list[str] | None = None) -> Column:
    """Distinct runs of neighbouring tokens of the given widths, space-joined;
    only those that begin with one of `firsts`, if given."""
    def of_width(t: Column, w: int) -> Column:
        starts = F.filter(F.sequence(F.lit(1), F.greatest(F.size(t), F.lit(1))), lambda i: fits(t, i, w))
        return F.transform(starts, lambda i: F.array_join(F.slice(t, i, F.lit(w)), " "))

    def fits(t: Column, i: Column, w: int) -> Column:
        inside = i + F.lit(w - 1) <= F.size(t)
        return inside if firsts is None else inside & F.get(t, i - 1).isin(firsts)

    return _once(tokens, lambda t: F.array_distinct(F.flatten(F.array(*[of_width(t, w) for w in widths]))))


# --- containment -------------------------------------------------------------

def _keyed_terms(terms: DataFrame) -> tuple[DataFrame, list[int], list[str] | None, bool]:
    """Dictionary with the word run each term is looked up by, run widths, the
    first words of runs, or None if they are too many for a filter, and whether
    the terms are few."""
    keyed = R.settle(
        terms.select("field", "term").distinct()
        .withColumn("_words", words_of("term"))
        .withColumn("_run", F.array_join("_words", " "))
        .withColumn("_width", F.size("_words"))
        # a term of one plain word needs no further check once its run is found
        .withColumn("_plain", F.regexp_like(F.lower("term"), F.lit(r"(?U)^\w+$")))
        .withColumn("_first", F.get("_words", F.lit(0))).drop("_words"))
    widths = keyed.where("_width > 0").agg(F.collect_set("_width").alias("w")).first()["w"]
    few = keyed.where("_width > 0").limit(FEW_TERMS + 1).count() <= FEW_TERMS
    firsts = [r["_first"] for r in keyed.where("_width > 0").select("_first").distinct().limit(FIRST_WORDS + 1).collect()]
    return keyed.drop("_width", "_first"), sorted(widths) or [1], firsts if len(firsts) <= FIRST_WORDS else None, few


def _whole_words(text: str, term: str) -> Column:
    found = F.regexp_like(text, F.concat(F.lit(r"(?U)(?<!\w)\Q"), F.lower(term), F.lit(r"\E(?!\w)")))
    return F.when(F.col("_plain"), True).otherwise(found)


def match_dictionary(docs: DataFrame, terms: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Longest dictionary term of each field found as whole words in each text.

    `terms` has (field, term). Texts are cut into word runs as long as the
    longest term and joined to the dictionary on the run, which costs text
    length and not text x dictionary; the pattern check then settles
    punctuation (`Half-Elf` against `half elf`): in place for short texts, while
    of long ones only the hits that need it meet their text again. Equal lengths go to the alphabetically first
    term. `key` names a text. Returns (key, field, value).
    """
    keyed, widths, firsts, few = _keyed_terms(terms)
    lowered = docs.select(key, F.lower(F.col(text)).alias("_text"))
    # runs that begin with no term's first word are not shuffled
    runs = F.explode(windows(words_of("_text"), widths, firsts)).alias("_run")
    carried = CARRIED_BYTES if few and firsts is not None else 0
    # short texts go with their runs to the dictionary, and are checked there
    short = lowered.where(F.octet_length("_text") <= carried).select(key, "_text", runs).join(keyed, "_run")
    holds = F.col("_plain") | (F.col(key).isNotNull() & _whole_words("_text", "term"))
    # longer ones stay behind, and only the hits that need it meet them
    longer = lowered.where(F.octet_length("_text") > carried)
    hits = longer.select(key, runs).join(keyed, "_run")
    unsure = hits.where(~F.col("_plain")).select(key, "field", "term", "_plain")
    checked = unsure.join(longer, key).where(_whole_words("_text", "term"))
    sure = hits.where("_plain").select(key, "field", "term").unionByName(checked.select(key, "field", "term"))
    sure = sure.unionByName(short.where(holds).select(key, "field", "term"))
    best = F.min(F.struct((-F.length("term")).alias("size"), F.col("term").alias("term")))
    return sure.groupBy(key, "field").agg(best.alias("_best")).select(
        key, "field", F.col("_best.term").alias("value"))


def spell(rows: DataFrame, terms: DataFrame, by: list[str], field: str = "field", value: str = "value",
          out: str = "known") -> DataFrame:
    """Adds the longest dictionary term inside each row's own value, or null.

    One pass over the rows: word runs are looked up by (field, run) in a left
    join and folded back per row. `by` identifies a row.
    """
    keyed, widths, firsts, _ = _keyed_terms(terms)
    keyed = keyed.withColumnRenamed("field", field)
    runs = rows.withColumn("_text", F.lower(value)) \
        .withColumn("_run", F.explode_outer(windows(words_of("_text"), widths, firsts)))
    joined = runs.join(keyed, [field, "_run"], "left")
    hit = F.when(_whole_words("_text", "term"),
                 F.struct((-F.length("term")).alias("size"), F.col("term").alias("term")))
    others = [c for c in rows.columns if c not in by]
    folded = joined.groupBy(*by).agg(*[F.first(c).alias(c) for c in others], F.min(hit).alias("_best"))
    return folded.select(*rows.columns, F.col("_best.term").alias(out))


# --- similarity --------------------------------------------------------------

@F.pandas_udf(T.DoubleType())
def seq_ratio(left: pd.Series, right: pd.Series) -> pd.Series:
    """Sequence-matcher ratio of two text columns; the order of sides matters."""
    matcher, last, out = SequenceMatcher(None), None, []
    for a, b in zip(left, right):
        if b != last:  # the matcher indexes its second side
            matcher.set_seq2(b)
            last = b
        matcher.set_seq1(a)
        out.append(matcher.ratio())
    return pd.Series(out)


def phrase_candidates(c, max_words: int = 4, lengths: tuple[int, int] = (1, 1 << 30)) -> Column:
    """All runs of 1 to `max_words` words plus the whole phrase, of the given
    lengths in characters."""
    tokens = F.regexp_extract_all(F.lower(col(c)), F.lit(r"([a-z0-9']+)"), F.lit(1))
    every = _once(tokens, lambda t: F.concat(windows(t, range(1, max_words + 1)), F.array(F.array_join(t, " "))))
    return F.array_distinct(F.filter(every, lambda p: F.length(p).between(*lengths)))


def _grams(phrase: Column, size: int) -> Column:
    """Character n-grams numbered by occurrence, so repeats count."""
    runs = F.regexp_extract_all(phrase, F.lit("(?s)(?=(" + "." * size + "))"), F.lit(1))
    return _once(runs, lambda r: F.transform(r, lambda g, i: F.concat(
        g, F.lit("#"), F.size(F.filter(F.slice(r, F.lit(1), i), lambda h: h == g)).cast("string"))))


def fuzzy_pairs(phrases: DataFrame, options: DataFrame) -> DataFrame:
    """Candidate pairs (phrase, option, cutoff) that can pass the cut-off.

    `phrases` has (phrase); `options` has (option, cutoff). With lengths a, b
    and M matched characters the ratio is 2M / (a + b), so a ratio above c
    needs M > c(a + b) / 2 shared characters. Matched blocks are kept apart by
    unmatched characters, so it also needs more than (1.5c - 1)(a + b) - 1
    shared bigrams, and at least one when c >= 0.8. Either count drives an
    exact prefix filter: two phrases that share t grams must also share one
    among the (count - t + 1) rarest of each under one common order. Frequent
    grams stay out of the join, and no true pair is lost. Bigrams are used
    from 0.8 up, single characters below.
    """
    bounds = options.agg(F.min("cutoff").alias("c"), F.max(F.length("option")).alias("n")).first()
    lowest, longest = float(bounds["c"] or 1.0), int(bounds["n"] or 0)
    size = 2 if lowest >= 0.8 else 1
    order = R.settle(
        options.select(F.explode(_grams(F.col("option"), size)).alias("gram"))
        .groupBy("gram").agg(F.count("*").alias("df")))
    slack = F.lit(1e-9)

    def needed(length: Column, cutoff: Column) -> Column:
        # a passing partner has at least length * c / (2 - c) characters
        partner = F.ceil(length * cutoff / (2 - cutoff) - slack)
        if size == 2:
            bound = F.floor((1.5 * cutoff - 1) * (length + partner) - 1 - slack)
        else:
            bound = F.ceil(cutoff * (length + partner) / 2 - slack)
        return F.greatest(F.lit(1), bound.cast("int"))

    def prefixes(frame, name):
        rows = frame.select(name, "cutoff", F.length(name).alias("_length"),
                            F.explode(_grams(F.col(name), size)).alias("gram"))
        ranked = rows.join(order, "gram", "left").withColumn("df", F.coalesce("df", F.lit(0)))
        limit = F.col("_length") - (size - 1) - needed(F.col("_length"), F.col("cutoff")) + 1
        # a phrase has one row per gram and phrases are short: the window is small
        place = F.row_number().over(W.partitionBy(name, "cutoff").orderBy("df", "gram"))
        return ranked.withColumn("_place", place).where(F.col("_place") <= limit)

    # no passing partner is longer than this
    reachable = phrases.where(F.length("phrase") <= longest * (2 - lowest) / lowest + 1)
    left = prefixes(reachable.withColumn("cutoff", F.lit(lowest)), "phrase") \
        .select("phrase", F.col("_length").alias("_a"), "gram")
    right = prefixes(options, "option").select("option", "cutoff", F.col("_length").alias("_b"), "gram")
    a, b = F.col("_a"), F.col("_b")
    close = 2 * F.least(a, b) > (F.col("cutoff") - slack) * (a + b)
    return left.join(right, "gram").where(close).select("phrase", "option", "cutoff").distinct()


def score_phrases(phrases: DataFrame, options: DataFrame) -> DataFrame:
    """(phrase, option, score): equal phrases score 1 by a join and skip the
    similarity step; the rest must score above the cut-off."""
    exact = phrases.join(options.withColumn("phrase", F.col("option")), "phrase") \
        .select("phrase", "option", "cutoff", F.lit(1.0).alias("score"))
    scored = fuzzy_pairs(phrases, options).where(F.col("phrase") != F.col("option")) \
        .withColumn("score", seq_ratio("phrase", "option")).where(F.col("score") > F.col("cutoff"))
    return exact.unionByName(scored)


def fuzzy_match(docs: DataFrame, terms: DataFrame, key: str = "doc_id", text: str = "text",
                min_length: int = 4, max_words: int = 4) -> DataFrame:
    """Best fuzzy term of each field in each text: (key, field, value, score).

    `terms` has (field, term, cutoff). Phrases are de-duplicated over all texts
    before they are scored. Ties go to the longer term, then alphabetically.
    """
    options = terms.select("field", "term", "cutoff", norm_phrase("term").alias("option")).where("option <> ''")
    bounds = options.agg(F.min("cutoff").alias("c"), F.max(F.length("option")).alias("n")).first()
    lowest, longest = float(bounds["c"] or 1.0), int(bounds["n"] or 0)
    # no longer phrase can pass a cut-off, so none is made
    lengths = (max(1, min_length), int(longest * (2 - lowest) / max(lowest, 1e-9) + 1))
    said = docs.select(key, F.explode(phrase_candidates(text, max_words, lengths)).alias("phrase"))
    scored = R.settle(score_phrases(said.select("phrase").distinct(), options.select("option", "cutoff").distinct()))
    hits = said.join(scored, "phrase").join(options, ["option", "cutoff"])
    return _best_term(hits, [key, "field"], keep_score=True)


def _best_term(hits: DataFrame, by: list[str], keep_score: bool = False) -> DataFrame:
    """Best (score, longest, alphabetical) term per group."""
    rank = F.struct((-F.col("score")).alias("score"), (-F.length("term")).alias("size"), F.col("term").alias("term"))
    best = hits.groupBy(*by).agg(F.min(rank).alias("_best"))
    score = [(-F.col("_best.score")).alias("score")] if keep_score else []
    return best.select(*by, F.col("_best.term").alias("value"), *score)


def match_value(values: DataFrame, terms: DataFrame, cutoff: float) -> DataFrame:
    """Loose match of a short value to a dictionary: (field, given, value).

    `values` has (field, given); `terms` has (field, term). Three steps, each
    on what the last one left: equal phrases, containment either way (longest
    term first), similarity at or above the cut-off.
    """
    # distinct short values: each step is kept, so later steps do not redo it
    asked = R.settle(values.select("field", "given").distinct().withColumn("_v", norm_phrase("given")).where("_v <> ''"))
    known = R.settle(terms.select("field", "term").distinct().withColumn("_o", norm_phrase("term")))
    # the last of equal phrases wins, as when a mapping is filled in order
    equal = R.settle(
        asked.join(known.withColumnRenamed("_o", "_v"), ["field", "_v"])
        .groupBy("field", "given").agg(F.max("term").alias("value")))
    rest = asked.join(equal, ["field", "given"], "left_anti")
    inside = R.settle(_contained(rest, known))
    rest = R.settle(rest.join(inside, ["field", "given"], "left_anti"))
    found = equal.unionByName(inside)
    if rest.isEmpty():
        return found
    options = known.where("_o <> ''").select(F.col("_o").alias("option"), F.lit(cutoff - 1e-9).alias("cutoff")).distinct()
    scored = score_phrases(rest.select(F.col("_v").alias("phrase")).distinct(), options)
    near = rest.withColumnRenamed("_v", "phrase").join(scored, "phrase") \
        .join(known.withColumnRenamed("_o", "option"), ["field", "option"])
    return found.unionByName(_best_term(near, ["field", "given"]))


def _contained(values: DataFrame, known: DataFrame) -> DataFrame:
    """Longest term that contains the value or is contained in it.

    Both directions are equi-joins on character runs: a short phrase is a
    substring of a long one exactly when it equals one of its runs of that
    length. Values and terms are short, and both tables are distinct.
    """
    def runs(name, widths):
        text = F.col(name)
        starts = F.transform(F.sequence(F.lit(1), F.length(text)), lambda i: F.transform(
            F.filter(widths, lambda w: w <= F.length(text) - i + 1), lambda w: text.substr(i, w)))
        return F.explode(F.array_distinct(F.flatten(starts))).alias("_run")

    def lengths(frame, name):
        # no run is longer than the longest term, so the set is small
        sizes = frame.where(F.length(name).between(1, longest)).agg(F.collect_set(F.length(name)).alias("n"))
        return F.array(*[F.lit(n) for n in sorted(sizes.first()["n"])]).cast("array<int>")

    longest = known.agg(F.coalesce(F.max(F.length("_o")), F.lit(0)).alias("n")).first()["n"]
    inner = values.select("field", "given", runs("_v", lengths(known, "_o"))).join(
        known.select("field", "term", F.col("_o").alias("_run")), ["field", "_run"])
    outer = known.where("_o <> ''").select("field", "term", runs("_o", lengths(values, "_v"))).join(
        values.select("field", "given", F.col("_v").alias("_run")), ["field", "_run"])
    both = inner.select("field", "given", "term").unionByName(outer.select("field", "given", "term"))
    return _best_term(both.withColumn("score", F.lit(1.0)), ["field", "given"])

"""I-Match document fingerprints, and the half-edited texts that test them.

Only terms within a band of inverse document frequency count. The lexicon of
such terms is randomised several times: subset 0 is the whole lexicon, the
others keep a term with a falling chance. A document's distinct terms of a
subset are sorted and hashed; the fingerprint is the list of these hashes.
Subsets that keep few terms survive edits of long texts, subsets that keep many
tell short texts apart. Everything is built from column expressions.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from taleweave.llm.common import settled, tree_search, whole_text

#: Band of idf = ln(documents / documents with the term). The upper end bounds
#: the lexicon: at most exp(HIGH_IDF) times the mean distinct terms of a document.
LOW_IDF, HIGH_IDF = 2.0, 7.5
#: One in so many terms of the lexicon is in each randomised subset.
SUBSETS = (1, 8, 16, 32, 32, 64, 64, 64, 128, 128, 128, 128, 256, 256, 256, 256, 512, 512, 512, 1024)
#: Slots of the lexicon table; a code is looked up in one slot.
SLOTS = 65_536
#: Documents in a range of the order of ids, and ranges at most.
RANGE_ROWS, MOST_RANGES = 2_000, 2048
_EMPTY = "0" * 16


def terms(text: Column) -> Column:
    """Distinct lower-case words of a text, as 64-bit codes."""
    words = F.filter(F.split(F.lower(text), "[\\x20\\x09-\\x0D]+"), lambda t: t != "")
    return F.array_distinct(F.transform(words, lambda t: F.xxhash64(t)))


def lexicon(docs: DataFrame, text: str = "text", low: float = LOW_IDF, high: float = HIGH_IDF) -> DataFrame:
    """(code) of the terms whose idf lies within [low, high]. Document
    frequencies cover all rows, repeated texts too."""
    n = docs.count()
    counted = docs.select(F.explode(terms(whole_text(text))).alias("code")).groupBy("code").agg(F.count("*").alias("df"))
    return counted.where(F.log(F.lit(float(max(n, 1))) / F.col("df")).between(low, high)).select("code")


def lookup_table(codes: DataFrame) -> Column:
    """The lexicon as a literal struct: where each slot starts, and the codes
    in order of slots. The upper end of the band bounds what is collected."""
    held = np.array([r["code"] for r in codes.collect()], np.int64)
    slot = np.mod(held, SLOTS)
    held = held[np.lexsort([held, slot])]
    starts = np.concatenate([[0], np.cumsum(np.bincount(slot, minlength=SLOTS))])

    def literal(values) -> Column:
        # one parsed text instead of one expression per value
        parsed = F.split(F.lit(",".join(map(str, values.tolist()))), ",").cast("array<bigint>")
        return parsed if len(values) else F.array().cast("array<bigint>")

    return F.struct(literal(starts).alias("starts"), literal(held).alias("codes"))


def _fingerprint(text: Column, table: Column, subsets) -> Column:
    def in_band(c: Column) -> Column:
        slot = F.pmod(c, F.lit(SLOTS)).cast("int")
        start = F.get(table["starts"], slot)
        size = F.get(table["starts"], slot + 1) - start
        return (size > 0) & F.array_contains(
            F.slice(table["codes"], (start + 1).cast("int"), size.cast("int")), c)

    def digest(codes: Column) -> Column:
        return F.when(F.size(codes) > 0, F.lpad(F.hex(F.xxhash64(codes)), 16, "0")).otherwise(F.lit(_EMPTY))

    def subset(codes: Column, k: int) -> Column:
        return F.filter(codes, lambda c: F.pmod(F.xxhash64(F.lit(k), c), F.lit(subsets[k])) == 0)

    def whole(codes: Column) -> Column:
        """Terms in and out of the band, sorted; bound once by a lambda variable."""
        return F.transform(F.array(F.array_sort(codes)), lambda e: F.struct(
            F.filter(e, in_band).alias("band"), e.alias("every")))

    def listed(t: Column) -> Column:
        others = [F.lit(_EMPTY)] * (len(subsets) - 1)
        return F.when(
            F.size(t["band"]) > 0,
            F.concat_ws("-", digest(t["band"]), *[digest(subset(t["band"], k)) for k in range(1, len(subsets))])
        ).otherwise(F.concat_ws("-", F.lpad(F.hex(F.xxhash64(F.lit("all"), t["every"])), 16, "0"), *others))

    return F.get(F.transform(whole(terms(text)), listed), F.lit(0))


def fingerprints(texts: list[Column], table: Column, subsets=SUBSETS) -> Column:
    """Array of the fingerprints of some texts of a row: for each subset the
    hash of its sorted terms, joined by dashes. A text without a term in the
    band is taken by all its terms, under subset 0 alone."""
    # the table is bound once, so the plan holds one copy of it
    bound = F.transform(F.array(table), lambda t: F.transform(
        F.array(*texts), lambda text: _fingerprint(text, t, subsets)))
    return F.get(bound, F.lit(0))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal hashes among the subsets that at least one of two
    fingerprints fills; 0 to 1."""
    pairs = F.arrays_zip(F.split(a, "-").alias("a"), F.split(b, "-").alias("b"))
    filled = F.size(F.filter(pairs, lambda p: (p["a"] != _EMPTY) | (p["b"] != _EMPTY)))
    equal = F.size(F.filter(pairs, lambda p: (p["a"] == p["b"]) & (p["a"] != _EMPTY)))
    return F.when(filled > 0, equal / filled).otherwise(F.lit(0.0))


def id_cuts(docs: DataFrame, key: str) -> list[int]:
    """Key values that cut the ascending order into even ranges."""
    n = docs.count()
    ranges = min(MOST_RANGES, max(1, n // RANGE_ROWS))
    if ranges == 1:
        return []
    shares = [i / ranges for i in range(1, ranges)]
    found = docs.select(F.percentile_approx(F.col(key).cast("long"), shares, 20 * ranges).alias("c")).first()["c"]
    return sorted({c for c in found or [] if c is not None})


def with_next(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, text, n_chars, next_text, range, place, ghost): every row with the
    text of the next one in ascending order of the key, the last with the first.

    The order is cut into ranges; the first row of a range is sent to the range
    before it as well, as a ghost. Null keys come first; equal keys follow
    their texts' digests. One shuffle of the texts.
    """
    base = docs.select(F.col(key).alias("doc_id"), whole_text(text).alias("text"))
    base = base.withColumn("tie", F.md5("text"))
    cuts = id_cuts(docs, key)
    last = len(cuts)
    place = tree_search(lambda c: F.coalesce(F.col("doc_id").cast("long") < F.lit(c), F.lit(True)), cuts).cast("int")
    ranged = base.withColumn("range", place)
    # one row for each range that has rows: its first row
    heads = ranged.groupBy("range").agg(F.min(F.struct("doc_id", "tie")).alias("head")).collect()
    heads = sorted((r["range"], r["head"]["doc_id"], r["head"]["tie"]) for r in heads)
    copies = [F.struct("range", F.lit(0).alias("lap"), F.lit(False).alias("ghost"))]
    for i, (at, head, tie) in enumerate(heads):
        goes_to = heads[i - 1][0]
        copies.append(F.when(
            (F.col("range") == at) & F.col("doc_id").eqNullSafe(F.lit(head).cast("long")) & (F.col("tie") == tie),
            F.struct(F.lit(goes_to).alias("range"), F.lit(1).alias("lap"), F.lit(True).alias("ghost"))))
    sent = ranged.withColumn("to", F.explode(F.filter(F.array(*copies), lambda c: c.isNotNull())))
    sent = sent.select("doc_id", "text", "tie", "to.range", "to.lap", "to.ghost").repartition("range")
    order = Window.partitionBy("range").orderBy("lap", "doc_id", "tie")
    return sent.select(
        "*", F.row_number().over(order).alias("place"), F.lead("text").over(order).alias("next_text"),
        F.char_length("text").alias("n_chars"))


def edited_text(text: str = "text", other: str = "next_text") -> Column:
    """The last floor(n/2) code points of a text, replaced by as many of the
    first code points of another, or by all it has."""
    half = F.floor(F.char_length(text) / 2).cast("int")
    return F.concat(F.left(F.col(text), F.char_length(text) - half), F.left(F.coalesce(F.col(other), F.lit("")), half))


def fingerprint_edits(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its fingerprint, that of its edited text, and how
    alike they and the next document's fingerprint are.

    Null texts are empty. A single document is its own next one. Rows that
    repeat key and text are kept, one row each. Other columns are ignored.
    """
    table = lookup_table(settled(lexicon(docs, text), "lexicon"))
    rows = with_next(docs, key, text).withColumn("edited", edited_text())
    printed = rows.select(
        "range", "place", "ghost", "doc_id", F.col("n_chars").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprints([F.col("text"), F.col("edited")], table).alias("both"))
    printed = printed.select("*", F.col("both")[0].alias("fingerprint"), F.col("both")[1].alias("edited_fingerprint"))
    order = Window.partitionBy("range").orderBy("place")
    printed = printed.withColumn("next_fingerprint", F.lead("fingerprint").over(order))
    return printed.where(~F.col("ghost")).select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"))

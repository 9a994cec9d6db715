"""Corpus to token datasets: vocabularies, encoding, positional splits, blocks."""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from taleweave.functions.draws import uniform
from taleweave.functions.text import col
from taleweave.operators import ordering

MAX_TOKEN_ID = 65_535
CODE_POINTS = 0x110000


def normalise_line_ends(c) -> Column:
    return F.regexp_replace(col(c), "\r\n?", "\n")


# --- vocabulary --------------------------------------------------------------

def char_set(docs: DataFrame, text: str = "text", extra: str = "") -> DataFrame:
    """Distinct characters. Each row is reduced to its own distinct characters
    before the explode, so a document contributes tens of rows, not thousands."""
    own = F.array_distinct(F.split(F.col(text), ""))
    chars = docs.select(F.explode(own).alias("token"))
    if extra:
        more = F.array(*[F.lit(ch) for ch in sorted(set(extra))])
        chars = chars.unionByName(docs.sparkSession.range(1).select(F.explode(more).alias("token")))
    return chars.where(F.col("token") != "").distinct()


def number_tokens(tokens: DataFrame, first_id: int = 0) -> DataFrame:
    """Dense ids in code-point order. The input is a distinct character table,
    which Unicode bounds at about 1.1 million rows."""
    rank = F.row_number().over(W.orderBy("token"))
    return tokens.select("token", (rank - 1 + first_id).cast("int").alias("id"))


def char_vocab(docs: DataFrame, text: str = "text", extra: str = "") -> DataFrame:
    return number_tokens(char_set(docs, text, extra))


def extend_vocab(base: DataFrame, tokens: DataFrame) -> DataFrame:
    """Base vocabulary plus new tokens; base ids never move."""
    size = base.agg((F.max("id") + 1).alias("n")).first()["n"] or 0
    fresh = tokens.select("token").distinct().join(base, "token", "left_anti")
    return base.select("token", F.col("id").cast("int").alias("id")).unionByName(number_tokens(fresh, size))


def new_tokens(tokens: DataFrame, base: DataFrame) -> DataFrame:
    """Set difference of two token tables."""
    return tokens.select("token").distinct().exceptAll(base.select("token").distinct())


def corpus_stats(docs: DataFrame, text: str = "text") -> DataFrame:
    """Documents, characters and vocabulary size of a corpus, one row."""
    size = docs.agg(F.count("*").alias("documents"),
                    F.coalesce(F.sum(F.length(text)), F.lit(0)).cast("long").alias("characters"))
    vocabulary = char_set(docs, text).agg(F.count("*").alias("vocabulary"))
    return size.join(vocabulary)  # one row each


# --- encoding ----------------------------------------------------------------

def _lookup_arrays(vocab: DataFrame) -> tuple[list[str], list[int]]:
    """Vocabulary on the driver: characters, so at most one for each code point.
    Whether ids fit the 16 bits of a stored dataset is checked on writing."""
    rows = vocab.select("token", "id").orderBy("id").limit(CODE_POINTS + 1).collect()
    if len(rows) > CODE_POINTS:
        raise ValueError("more tokens than characters")
    return [r["token"] for r in rows], [r["id"] for r in rows]


def encode(c, vocab: DataFrame, oov: str = "fail") -> Column:
    """Array of ids of a text's characters.

    Ids are read from an array indexed by code point, so each character costs
    one lookup. `oov="fail"` raises on an unknown character, `"skip"` drops it.
    """
    tokens, ids = _lookup_arrays(vocab)
    points = [ord(t) for t in tokens]
    low, high = (min(points), max(points)) if points else (0, 0)
    dense: list[int | None] = [None] * (high - low + 1)
    for point, token_id in zip(points, ids):
        dense[point - low] = token_id
    # one literal that the optimiser folds, instead of one node per code point
    table = F.from_json(F.lit("[" + ",".join("null" if i is None else str(i) for i in dense) + "]"), "array<int>")
    if oov == "skip":
        known = F.transform(F.split(col(c), ""), lambda ch: F.get(table, F.ascii(ch) - F.lit(low)))
        return F.filter(known, lambda i: i.isNotNull())
    unknown = F.raise_error(F.lit("character outside the vocabulary")).cast("int")
    looked = F.transform(F.split(col(c), ""), lambda ch: F.coalesce(F.get(table, F.ascii(ch) - F.lit(low)), unknown))
    return F.when(col(c) == "", F.array().cast("array<int>")).otherwise(looked)


def decode(c, vocab: DataFrame) -> Column:
    """Text of an array of ids."""
    tokens, ids = _lookup_arrays(vocab)
    by_id = {i: t for i, t in zip(ids, tokens)}
    # one literal that the optimiser folds, instead of one node per token
    names = F.from_json(F.lit(json.dumps([by_id.get(i, "") for i in range(max(ids, default=-1) + 1)])), "array<string>")
    return F.array_join(F.transform(col(c), lambda i: F.get(names, i)), "")


# --- positional split --------------------------------------------------------

def split_position(docs: DataFrame, order="doc_id", fraction: float = 0.9,
                   text: str = "text") -> DataFrame:
    """Cut the corpus at `floor(characters * fraction)` in document order.

    Only the cut is searched for; documents away from it get their split from
    one comparison, and the straddling document is cut with `substring`.
    """
    return prefix_splits(docs, order, [fraction], text).withColumn(
        "split", F.when(F.col("piece") == 0, "train").otherwise("val")).drop("piece")


def prefix_splits(docs: DataFrame, order, fractions: list[float], text: str = "text") -> DataFrame:
    """Cut the corpus at several fractions; `piece` i lies before cut i."""
    length = F.length(text).cast("long")
    tree = ordering.SumTree(docs, order, length)
    cuts = tree.cuts([math.floor(tree.total * f) for f in fractions])
    cut = ordering.pieces(docs, order, length, cuts)
    part = F.col(text).substr((F.col("piece_from") + 1).cast("int"),
                              (F.col("piece_to") - F.col("piece_from")).cast("int"))
    whole = (F.col("piece_from") == 0) & (F.col("piece_to") == length)
    return cut.withColumn(text, F.when(whole, F.col(text)).otherwise(part))


def prefix_lengths(total: int, fractions: list[float]) -> list[int]:
    """Tokens of each prefix subset: at least one."""
    return [max(1, math.floor(total * f)) for f in fractions]


def prefix_fraction(tokens: DataFrame, order, fraction: float, ids: str = "ids") -> DataFrame:
    """Leading part of a token dataset: `floor(tokens * fraction)`, at least one."""
    size = F.size(ids).cast("long")
    tree = ordering.SumTree(tokens, order, size)
    cut = ordering.pieces(tokens, order, size, tree.cuts(prefix_lengths(tree.total, [fraction])))
    return (
        cut.where(F.col("piece") == 0)
        .withColumn(ids, F.slice(ids, 1, F.col("piece_to").cast("int")))
        .drop("piece", "piece_from", "piece_to")
    )


def encode_split(docs: DataFrame, vocab: DataFrame, order="doc_id", fraction: float = 0.9,
                 text: str = "text") -> DataFrame:
    """Token dataset: split by position, then encode. `start` is the offset of
    the piece inside its document."""
    split = split_position(docs, order, fraction, text)
    keys = [order] if isinstance(order, str) else list(order)
    return split.select(*keys, "split", F.col("piece_from").alias("start"),
                        encode(text, vocab).alias("ids"))


# --- blocks ------------------------------------------------------------------

def place_tokens(tokens: DataFrame, order, keys=(), ids: str = "ids") -> DataFrame:
    """Adds `at`, the offset of a row's first token in its corpus (per key)."""
    return ordering.running_total(tokens, order, F.size(ids).cast("long"), keys, "at")


def make_blocks(tokens: DataFrame, block: int, order, keys=(), ids: str = "ids", stride: int | None = None) -> DataFrame:
    """Windows (x, y) of `block` tokens, y one token ahead, over the whole
    corpus (per key): (keys, block, x, y). One starts every `stride` tokens,
    `block` by default. They cross documents, so only a tail shorter than
    `block + 1` tokens is left over for each key.

    A block inside one row is cut there; only the parts of blocks that cross
    rows are brought together, at most `block + 1` tokens for each.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    placed = place_tokens(tokens, order, keys, ids)
    size, at, width = F.size(ids).cast("long"), F.col("at"), F.lit(block).cast("long")
    step = F.lit(stride or block).cast("long")
    # blocks b of which this row holds tokens: b * step <= position <= b * step + width
    first = F.greatest(F.lit(0).cast("long"), F.floor((at - width + step - 1) / step))
    last = F.floor((at + size - 1) / step)
    begin = F.greatest(at, F.col("block") * step)
    end = F.least(at + size, F.col("block") * step + width + 1)
    held = placed.where(size > 0).withColumn("block", F.explode(F.when(first <= last, F.sequence(first, last))))
    held = held.where(end > begin).select(
        *keys, "block", begin.alias("from"),
        F.slice(ids, (begin - at + 1).cast("int"), (end - begin).cast("int")).alias("part"))
    whole = held.where(F.size("part") == block + 1).select(*keys, "block", F.col("part").alias("t"))
    crossing = held.where(F.size("part") <= block).groupBy(*keys, "block").agg(
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("from", "part"))), lambda p: p["part"])).alias("t"))
    full = whole.unionByName(crossing.where(F.size("t") == block + 1))
    return full.select(*keys, "block", F.slice("t", 1, block).alias("x"), F.slice("t", 2, block).alias("y"))


def draw_blocks(tokens: DataFrame, block: int, draws: int, seed: int, order, key: str, ids: str = "ids") -> DataFrame:
    """Windows at seeded random positions of the corpus of each key, every
    position alike: (key, draw, start, x, y). A key with fewer than
    `block + 1` tokens has none.

    Rows are cut into cells of `block + 1` tokens, and a window meets the two
    cells it lies in by an equi-join.
    """
    placed = place_tokens(tokens, order, [key], ids)
    width = F.lit(block + 1).cast("long")
    room = tokens.groupBy(key).agg(F.sum(F.size(ids)).alias("n")).where(F.col("n") > block)
    drawn = room.withColumn("draw", F.explode(F.sequence(F.lit(0), F.lit(draws - 1))))
    drawn = drawn.withColumn("start", F.floor(uniform(seed, "block", key, "draw") * (F.col("n") - block)))
    drawn = drawn.select(key, "draw", "start", F.explode(F.array_distinct(F.array(
        F.floor(F.col("start") / width), F.floor((F.col("start") + block) / width)))).alias("cell"))
    size, at = F.size(ids).cast("long"), F.col("at")
    cells = placed.where(size > 0).withColumn("cell", F.explode(F.sequence(
        F.floor(at / width), F.floor((at + size - 1) / width))))
    begin, end = F.greatest(at, F.col("cell") * width), F.least(at + size, F.col("cell") * width + width)
    cells = cells.select(key, "cell", begin.alias("from"),
                         F.slice(ids, (begin - at + 1).cast("int"), (end - begin).cast("int")).alias("part"))
    parts = F.array_sort(F.collect_list(F.struct("from", "part")))
    met = drawn.join(cells, [key, "cell"]).groupBy(key, "draw", "start").agg(parts.alias("p"))
    joined = F.flatten(F.transform("p", lambda p: p["part"]))
    skip = (F.col("start") - F.get("p", F.lit(0))["from"]).cast("int")
    return met.select(key, "draw", "start", F.slice(joined, skip + 1, F.lit(block)).alias("x"),
                      F.slice(joined, skip + 2, F.lit(block)).alias("y"))


# --- merging -----------------------------------------------------------------

def merge_corpora(*sources: DataFrame, order: str = "doc_id", text: str = "text",
                  separator: str = "\n\n") -> DataFrame:
    """Union of sources in list order, adding the separator to the last
    document of every source but the final one, so offsets count it. Of
    documents that share the last key, one has it."""
    merged = None
    for number, source in enumerate(sources):
        part = source.select(F.lit(number).alias("source_no"), F.col(order), F.col(text))
        if number < len(sources) - 1:
            part = ordering.with_last(part, order, "_last").withColumn(text, F.when(
                F.col("_last"), F.concat(F.coalesce(text, F.lit("")), F.lit(separator))).otherwise(F.col(text))).drop("_last")
        merged = part if merged is None else merged.unionByName(part)
    return merged

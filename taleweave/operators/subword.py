"""Byte-level sub-word vocabularies: learn merges, encode documents.

A word is kept as text with one `<hex>` group per symbol, starting from its
UTF-8 bytes. Merging a pair is one string replacement, left to right and
without overlaps, so learning stays inside the JVM.

The words lie in the shared folder, one row each. A round reads them, writes
those that its merges change, and adds the change to the counts of pairs; words
without a merged pair are neither written nor counted again.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from taleweave.operators.corpus import MAX_TOKEN_ID
from taleweave.session import working_dir

UNKNOWN = "[UNK]"
# fixed value: how a text is cut into words before merging
WORD_PATTERN = (
    r"('s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+)"
)
TOP_PAIRS = 256
#: Texts whose ids are laid out at a time.
SLICE = 500
#: Rounds whose merges are applied on reading before the words are written anew.
LOGS = 4
WORDS = "word string, n long, symbols string"
CHANGES = "word string, n long, before string, after string"


def words(text) -> Column:
    """Words of a text, each with the space before it; a leading space is
    added when the text starts without one."""
    text = F.col(text) if isinstance(text, str) else text
    padded = F.when(F.startswith(text, F.lit(" ")), text).otherwise(F.concat(F.lit(" "), text))
    return F.regexp_extract_all(padded, F.lit(WORD_PATTERN), F.lit(1))


def symbols(word) -> Column:
    """`<hex>` groups of the bytes of a word."""
    word = F.col(word) if isinstance(word, str) else word
    return F.regexp_replace(F.hex(F.encode(word, "UTF-8")), "(..)", "<$1>")


def word_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    counted = docs.select(F.explode(words(text)).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    return counted.select("word", symbols("word").alias("symbols"), "n")


def _merge(column: Column, pairs: list[tuple[str, str]]) -> Column:
    for left, right in pairs:
        column = F.replace(column, F.lit(f"<{left}><{right}>"), F.lit(f"<{left}{right}>"))
    return column


def pairs_of(symbols) -> Column:
    """Adjacent pairs of a word's symbols, as `<hex>><hex>` without the ends."""
    # the look-ahead leaves the right symbol in place to open the next pair
    return F.regexp_extract_all(symbols, F.lit("<(?=([0-9A-F]+><[0-9A-F]+)>)"), F.lit(1))


def pair_changes(changed: DataFrame) -> DataFrame:
    """(pair, n): how the counts of pairs change with words (n, before, after)."""
    def signed(symbols, sign):
        return F.transform(pairs_of(symbols), lambda p: F.struct(p.alias("pair"), (F.col("n") * sign).alias("n")))

    each = changed.select(F.explode(F.concat(signed("after", 1), signed("before", -1))).alias("p"))
    return each.groupBy("p.pair").agg(F.sum("p.n").alias("n")).where("n <> 0")


class PairIndex:
    """Words and the counts of their pairs, in the shared folder.

    A round writes the changed words alone, once, and the few counts of pairs;
    the words as a whole are written every LOGS rounds, without those that are
    down to one symbol.
    """

    def __init__(self, counted: DataFrame):
        self.spark = counted.sparkSession
        self.base = self._save(counted.select("word", "n", "symbols"), "words")
        self.pending: list[tuple[str, str]] = []  # merges since the words were written
        self.fresh: list[str] = []  # what each of their rounds changed
        each = self._words().select("n", F.explode(pairs_of("symbols")).alias("pair"))
        self.counts = self._save(each.groupBy("pair").agg(F.sum("n").alias("n")), "pair-counts")

    def _save(self, df: DataFrame, name: str) -> str:
        path = working_dir(self.spark, name)
        df.write.parquet(path)
        return path

    def _read(self, paths: list[str]) -> DataFrame:
        return self.spark.read.schema(CHANGES).parquet(*paths)

    def _words(self) -> DataFrame:
        """(word, n, symbols) of the words as they are now."""
        words = self.spark.read.schema(WORDS).parquet(self.base)
        return words.withColumn("symbols", _merge(F.col("symbols"), self.pending))

    def pair_counts(self) -> DataFrame:
        """(pair, n) of the words as they are now."""
        return self.spark.read.schema("pair string, n long").parquet(self.counts).where("n > 0")

    def words_with(self, pairs: list[tuple[str, str]]) -> DataFrame:
        """(word, n, symbols) of the words that hold one of a few pairs."""
        return self._words().where(_merge(F.col("symbols"), pairs) != F.col("symbols"))

    def merge(self, pairs: list[tuple[str, str]]) -> None:
        """Merge pairs without a common symbol, in the words that hold them."""
        words = self.words_with(pairs)
        changed = words.select("word", "n", F.col("symbols").alias("before"), _merge(F.col("symbols"), pairs).alias("after"))
        self.fresh.append(self._save(changed, "changes"))
        every = self.pair_counts().unionByName(pair_changes(self._read(self.fresh[-1:])))
        self.counts = self._save(every.groupBy("pair").agg(F.sum("n").alias("n")).where("n > 0"), "pair-counts")
        self.pending += pairs
        if len(self.fresh) >= LOGS:
            self._gather()

    def _gather(self) -> None:
        self.base = self._save(self._words().where(F.contains("symbols", F.lit("><"))), "words")
        self.pending, self.fresh = [], []


def safe_prefix(ranked: list[tuple[str, str, int]]) -> list[tuple[str, str, int]]:
    """Leading pairs that one-at-a-time learning would also take next.

    Pairs without a common symbol do not change each other's counts, and a
    pair that a merge creates is no more frequent than the ranked pair it
    comes from. So the list may be taken up to the first pair that shares a
    symbol with one taken before; pairs tied with that one are left for the
    next round.
    """
    taken: list[tuple[str, str, int]] = []
    used: set[str] = set()
    for a, b, n in ranked:
        if {a, b} & used:
            kept = [p for p in taken if p[2] > n]
            return kept or taken[:1]
        taken.append((a, b, n))
        used |= {a, b}
    # the list was cut off: the next pair is unknown, so stay above its count
    return [p for p in taken if p[2] > ranked[-1][2]] or taken[:1]


def learn_merges(docs: DataFrame, vocab_size: int = 2000, min_freq: int = 2,
                 text: str = "text") -> tuple[list[str], list[tuple[str, str, int]]]:
    """(alphabet, merges in order). Learning is a loop by nature: a round brings
    back a bounded list of the top pairs and changes the words that hold the
    merged ones. All state lies in the shared folder."""
    spark = docs.sparkSession
    path = working_dir(spark, "words")
    word_counts(docs, text).write.parquet(path)
    counted = spark.read.schema("word string, symbols string, n long").parquet(path)
    alphabet = sorted(r["s"] for r in counted.select(
        F.explode(F.regexp_extract_all("symbols", F.lit("<([0-9A-F]+)>"), F.lit(1))).alias("s")).distinct().collect())
    merges: list[tuple[str, str, int]] = []
    index = PairIndex(counted)
    a, b = (F.split_part("pair", F.lit("><"), F.lit(i)).alias(n) for i, n in ((1, "a"), (2, "b")))
    while 1 + len(alphabet) + len(merges) < vocab_size:
        top = (
            index.pair_counts().where(F.col("n") >= min_freq).select(a, b, "n")
            .orderBy(F.desc("n"), "a", "b").limit(TOP_PAIRS).collect()
        )
        if not top:
            break
        chosen = safe_prefix([(r["a"], r["b"], r["n"]) for r in top])
        chosen = chosen[: vocab_size - 1 - len(alphabet) - len(merges)]
        merges += chosen
        if 1 + len(alphabet) + len(merges) < vocab_size:
            index.merge([(a_, b_) for a_, b_, _ in chosen])
    return alphabet, merges


def learn_bpe(docs: DataFrame, vocab_size: int = 2000, min_freq: int = 2, text: str = "text") -> DataFrame:
    """Vocabulary table (id, token, left, right, pair_count); tokens in hex."""
    if vocab_size > MAX_TOKEN_ID + 1:
        raise ValueError(f"token ids must not pass {MAX_TOKEN_ID}")
    alphabet, merges = learn_merges(docs, vocab_size, min_freq, text)
    rows = [(0, UNKNOWN, None, None, None)]
    rows += [(i + 1, s, None, None, None) for i, s in enumerate(alphabet)]
    rows += [(len(alphabet) + 1 + i, a + b, a, b, int(n)) for i, (a, b, n) in enumerate(merges)]
    # at most 65,536 rows by the check above
    return docs.sparkSession.createDataFrame(rows, "id int, token string, left string, right string, pair_count long")


def encode_word(symbols_of_word: list[str], ranks: dict[tuple[str, str], int]) -> list[str]:
    """Apply merges to one word, best rank first."""
    parts, last = list(symbols_of_word), len(ranks)
    while len(parts) > 1:
        pairs = list(zip(parts, parts[1:]))
        found = list(map(ranks.get, pairs, repeat(last)))
        rank = min(found)
        if rank == last:
            break
        best = pairs[found.index(rank)]
        merged, i = [], 0
        while i < len(parts):
            if i + 1 < len(parts) and (parts[i], parts[i + 1]) == best:
                merged.append(parts[i] + parts[i + 1])
                i += 2
            else:
                merged.append(parts[i])
                i += 1
        parts = merged
    return parts


class WordEncoder:
    """Encodes many words together: in each round every word that is not done
    merges its pair of best rank, as `encode_word` does for one word."""

    def __init__(self, ids: dict[str, int], ranks: dict[tuple[str, str], int]):
        self.bytes = np.array([ids.get(f"{b:02X}", 0) for b in range(256)], np.int64)
        # a pair is learned only of tokens that are in the vocabulary
        codes = {ids[a] << 32 | ids[b]: (rank, ids[a + b]) for (a, b), rank in ranks.items()}
        self.codes = np.array(sorted(codes), np.int64)
        self.ranks, self.merged = np.array([codes[c] for c in self.codes.tolist()], np.int64).reshape(-1, 2).T

    def encode(self, words: list[str]) -> list[bytes]:
        """32-bit ids of each word."""
        raw = [w.encode("utf-8") for w in words]
        word = np.repeat(np.arange(len(raw)), np.fromiter(map(len, raw), np.int64, len(raw)))
        symbols, done = self.bytes[np.frombuffer(b"".join(raw), np.uint8)], []
        while len(symbols) and len(self.codes):
            code = symbols[:-1] << 32 | symbols[1:]
            place = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
            at = np.flatnonzero((self.codes[place] == code) & (word[:-1] == word[1:]))
            if not len(at):
                break
            rank = self.ranks[place[at]]
            first = np.flatnonzero(np.diff(word[at], prepend=-1))
            best = np.repeat(np.minimum.reduceat(rank, first), np.diff(first, append=len(at)))
            at = at[rank == best]
            # of pairs that overlap, which are equal, every other one from the left
            run = np.flatnonzero(np.diff(at, prepend=-2) != 1)
            at = at[(np.arange(len(at)) - np.repeat(run, np.diff(run, append=len(at)))) % 2 == 0]
            symbols[at] = self.merged[place[at]]
            stays = np.ones(len(symbols), bool)
            stays[at + 1] = False
            open_ = np.zeros(len(raw), bool)
            open_[word[at]] = True
            ends = ~open_[word]
            done.append((word[ends], symbols[ends]))
            stays &= ~ends
            word, symbols = word[stays], symbols[stays]
        word = np.concatenate([*[w for w, _ in done], word])
        order = np.argsort(word, kind="stable")
        flat = np.concatenate([*[s for _, s in done], symbols])[order].astype(np.int32).tobytes()
        stops = (4 * np.cumsum(np.bincount(word, minlength=len(raw)))).tolist()
        return [flat[i:j] for i, j in zip([0, *stops], stops)]


def _laid_out(texts: pa.Array, ids_of: Callable[[list[str]], list[bytes]]) -> pa.Array:
    """Ids of texts given as lists of words; null for null."""
    listed = texts.flatten().dictionary_encode()
    ids = ids_of(listed.dictionary.to_pylist())
    lengths = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
    flat, starts = np.frombuffer(b"".join(ids), np.int32), np.cumsum(lengths) - lengths
    words = listed.indices.to_numpy(zero_copy_only=False)
    size = lengths[words]
    ends = np.cumsum(size)
    values = flat[np.repeat(starts[words] - (ends - size), size) + np.arange(size.sum())]
    counts = pc.fill_null(pc.list_value_length(texts), 0).to_numpy(zero_copy_only=False)
    offsets = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int32()), mask=texts.is_null())


def bpe_encode(docs: DataFrame, vocab: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Token ids of every document: (key, ids).

    Words are cut in the JVM; the Arrow step looks up each distinct word of a
    batch once, merges those that its task has not met, and lays the ids end to
    end, so documents stay in place and no word rows are shuffled. The
    vocabulary is at most 65,536 rows.
    """
    rows = vocab.select("id", "token", "left", "right").orderBy("id").limit(MAX_TOKEN_ID + 2).collect()
    if len(rows) > MAX_TOKEN_ID + 1:
        raise ValueError(f"token ids must not pass {MAX_TOKEN_ID}")
    ids = {r["token"]: r["id"] for r in rows}
    ranks = {(r["left"], r["right"]): i for i, r in enumerate(r for r in rows if r["left"] is not None)}
    model = docs.sparkSession.sparkContext.broadcast((ids, ranks))

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = WordEncoder(*model.value)
        memo: dict[str, bytes] = {}

        def ids_of(words: list[str]) -> list[bytes]:
            fresh = [w for w in words if w not in memo]
            made = dict(zip(fresh, encoder.encode(fresh)))
            if len(memo) < 500_000:  # bounds the memory of a task, not the result
                memo.update(made)
            return [made[w] if w in made else memo[w] for w in words]

        for batch in batches:
            made = [_laid_out(batch.slice(i, SLICE), ids_of) for i in range(0, len(batch), SLICE)]
            yield pa.concat_arrays(made) if made else pa.array([], pa.list_(pa.int32()))

    return docs.select(key, encode(words(text)).alias("ids"))


def bpe_decode(ids, vocab: DataFrame) -> Column:
    """Text of an array of ids: tokens are hex of bytes, so join and unhex."""
    rows = vocab.select("id", "token").orderBy("id").limit(MAX_TOKEN_ID + 2).collect()
    # one literal that the optimiser folds, instead of one node per token
    names = F.from_json(F.lit(json.dumps(["" if r["token"] == UNKNOWN else r["token"] for r in rows])), "array<string>")
    joined = F.array_join(F.transform(F.col(ids), lambda i: F.get(names, i)), "")
    return F.decode(F.unhex(joined), "UTF-8")

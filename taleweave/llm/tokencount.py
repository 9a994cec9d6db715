"""Unigram token counts by dynamic programming over a trie of the words.

The words to count arrive sorted, which walks their trie depth first: only the
path to the current word is held, and the forward scores of a prefix are
computed once for all words that share it. The last node of a word holds its
terminal count.

The vocabulary file holds ranks, not probabilities; a piece of rank r gets the
probability of Zipf's law, 1 / (r H). Scores are whole micro-nats, so sums do
not depend on their order.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taleweave.llm import wordtable as wt

#: What stands for the space before a word in the pieces.
WORD_START = "▁"
_SUMS = ["n_words", "n_tokens", "score"]
_COUNTED = "tag long, more long, n_words long, n_tokens long, score long"


def piece_scores(path: str) -> tuple[dict[str, int], list[int]]:
    """Micro-nats of every piece that stands for text, and of every byte."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    usable = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
    ranked = sorted(usable, key=lambda i: (-model.get_score(i), i))
    total = math.log(sum(1 / (r + 1) for r in range(len(ranked))))
    pieces, in_bytes = {}, [0] * 256
    for r, i in enumerate(ranked):
        score = round(-1e6 * (math.log(r + 1) + total))
        if model.is_byte(i):
            in_bytes[int(model.id_to_piece(i)[1:-1], 16)] = score
        else:
            pieces[model.id_to_piece(i)] = score
    return pieces, in_bytes


class TrieScores:
    """Forward scores along the path of the current word."""

    def __init__(self, pieces: dict[str, int], in_bytes: list[int]):
        self.pieces, self.in_bytes = pieces, in_bytes
        self.longest = max(map(len, pieces), default=1)
        self.word, self.best, self.count = "", [0], [0]

    def terminal(self, word: str) -> tuple[int, int]:
        """(tokens, score) of the best segmentation; ties to fewer tokens."""
        old, best, count, pieces = self.word, self.best, self.count, self.pieces
        shared, most = 0, min(len(old), len(word))
        while shared < most and old[shared] == word[shared]:
            shared += 1
        del best[shared + 1:], count[shared + 1:]
        for end in range(shared + 1, len(word) + 1):
            # a character of no piece falls back to its bytes
            one = pieces.get(word[end - 1])
            if one is None:
                raw = word[end - 1].encode()
                top, n = best[end - 1] + sum(self.in_bytes[b] for b in raw), count[end - 1] + len(raw)
            else:
                top, n = best[end - 1] + one, count[end - 1] + 1
            for start in range(end - 2, max(-1, end - self.longest - 1), -1):
                score = pieces.get(word[start:end])
                if score is not None:
                    score += best[start]
                    if score > top or (score == top and count[start] + 1 < n):
                        top, n = score, count[start] + 1
            best.append(top)
            count.append(n)
        self.word = word
        return count[-1], best[-1]


def _count_words(model):
    """Arrow step over rows sorted by word: counts for every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = TrieScores(*model.value)
        for batch, run_of, words in wt.runs(batches, "word"):
            ends = np.array([trie.terminal(WORD_START + w) for w in words.to_pylist()], np.int64).reshape(-1, 2)
            often = batch.column("n").to_numpy(zero_copy_only=False).astype(np.int64)
            tokens, scores = often * ends[run_of, 0], often * ends[run_of, 1]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in wt.TAGS], pa.array(often), pa.array(tokens), pa.array(scores)],
                names=[*wt.TAGS, *_SUMS])

    return run


def _count_frequent(listed, values):
    """Arrow step: the share of each document that frequent words give."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, table = wt.worker_value(listed, wt.word_codes), values.value
        for batch in batches:
            out = []
            for raw in wt.raw_texts(batch.column("text")):
                found = np.fromiter((c for c in map(codes.get, raw.split()) if c is not None), np.int64)
                out.append((len(found), *table[found].sum(axis=0).tolist()))
            sums = np.array(out, np.int64).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[batch.column(c) for c in wt.TAGS],
                 *[pa.array(np.ascontiguousarray(sums[:, i])) for i in range(3)]],
                names=["doc_id", *wt.TAGS, *_SUMS])

    return run


def count_tokens(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_words, n_tokens, score): words split at ASCII white space,
    tokens of their best unigram segmentations, and the sum of the scores in
    micro-nats. `path` names a sentencepiece file that every machine has.

    A null text is empty: no words, no tokens, score 0. The key may be of any
    type; rows that share an id are counted apart, and those that repeat id
    and text give one row each. Other columns are ignored. An empty table
    gives an empty result.
    """
    spark = docs.sparkSession
    rows = wt.keyed(docs, key, text)
    kind = rows.schema["doc_id"].dataType.simpleString()
    model = spark.sparkContext.broadcast(piece_scores(path))
    words = wt.frequent_words(rows)
    # the list is of bounded size; its words are counted over a trie as well
    listed = pa.table({
        "tag": pa.array(range(len(words)), pa.int64()), "more": pa.array([0] * len(words), pa.int64()),
        "n": pa.array([1] * len(words), pa.int32()), "word": pa.array(words, pa.binary()).cast(pa.string())})
    table = np.zeros((len(words), 2), np.int64)
    if words:
        counted = spark.createDataFrame(listed).repartitionByRange("word").sortWithinPartitions("word").mapInArrow(
            _count_words(model), _COUNTED).select("tag", "n_tokens", "score").toArrow()
        at = counted.column("tag").to_numpy()
        table[at, 0], table[at, 1] = counted.column("n_tokens").to_numpy(), counted.column("score").to_numpy()
    shared, values = spark.sparkContext.broadcast(words), spark.sparkContext.broadcast(table)
    rare = rows.select(*wt.TAGS, "text").mapInArrow(wt.rare_rows(shared), wt.RARE)
    # ranges of words, so that a task's words share prefixes
    rare = rare.repartitionByRange("word").sortWithinPartitions("word").mapInArrow(_count_words(model), _COUNTED)
    own = rows.mapInArrow(_count_frequent(shared, values), f"doc_id {kind}, {_COUNTED}")
    every = own.withColumn("rows", F.lit(1)).unionByName(
        rare.select(F.lit(None).cast(kind).alias("doc_id"), "*", F.lit(0).alias("rows")))
    summed = every.groupBy(*wt.TAGS).agg(
        F.first("doc_id", ignorenulls=True).alias("doc_id"), F.sum("rows").alias("rows"), *[F.sum(c).alias(c) for c in _SUMS])
    # rows that repeat id and text have been summed together
    each = [F.expr(f"{c} div rows").alias(c) for c in _SUMS]
    return summed.select("doc_id", F.explode(F.sequence(F.lit(1).cast("long"), "rows")), *each).drop("col")

"""Distinct words of a corpus, each worked on once and joined back.

Frequent words are few: a list of bounded size is broadcast, with what was
computed for each. All other words travel: one row per document and distinct
word is shuffled by word and sorted, so equal words stand together and the work
is done once for each. The list decides which way a word goes, never what comes
out; it may come from a sample.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taleweave.llm.common import whole_text

#: Bounds of the broadcast list, and documents it is drawn from, about.
FREQUENT_WORDS, FREQUENT_BYTES, SAMPLE_DOCS = 1 << 18, 8 << 20, 20_000
#: ASCII white space; bytes.split() cuts at the same characters.
WORDS = "[\\x20\\x09-\\x0D]+"


#: Columns that tell rows apart: 128 bits of a digest of id and text, so that
#: very many rows may share an id.
TAGS = ["tag", "more"]


def keyed(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(doc_id, tag, more, text), the id in its own type."""
    body, own = whole_text(text), F.col(key)
    return docs.select(
        own.alias("doc_id"), F.xxhash64(own, body).alias("tag"), F.xxhash64(F.lit(1), own.isNull(), own, body).alias("more"),
        body.alias("text"))


def frequent_words(rows: DataFrame) -> list[bytes]:
    """The most frequent words of a sample of the documents, most frequent
    first, within the bounds."""
    count = rows.count()
    sample = rows if count <= SAMPLE_DOCS else rows.sample(SAMPLE_DOCS / count, 17)
    counted = sample.select(F.explode(F.split("text", WORDS)).alias("word")).where(
        (F.col("word") != "") & (F.octet_length("word") <= 1024)).groupBy("word").count()
    top = counted.where("count > 1").orderBy(F.desc("count"), "word").limit(FREQUENT_WORDS)
    listed, size = [], 0
    for r in top.toLocalIterator():
        word = r["word"].encode()
        size += len(word)
        if size > FREQUENT_BYTES:
            break
        listed.append(word)
    return listed


_built: dict = {}


def worker_value(shared, build: Callable):
    """What `build` makes of a broadcast value, once per Python worker."""
    at = (shared._jbroadcast.id() if getattr(shared, "_jbroadcast", None) else id(shared), build.__name__)
    if at not in _built:
        _built.clear()
        _built[at] = (shared, build(shared.value))
    return _built[at][1]


def word_codes(words: list[bytes]) -> dict[bytes, int]:
    return {w: i for i, w in enumerate(words)}


def split_codes(raw: bytes, codes: dict[bytes, int]) -> tuple[np.ndarray, list[bytes]]:
    """Code of each word of a text, and its distinct words without a code; the
    i-th of them has the code -1 - i."""
    words = raw.split()
    found = np.fromiter(map(codes.get, words, repeat(-1)), np.int32, len(words))
    missing = np.flatnonzero(found < 0)
    if not len(missing):
        return found, []
    own: dict[bytes, int] = {}
    found[missing] = [-1 - own.setdefault(words[i], len(own)) for i in missing.tolist()]
    return found, list(own)


def raw_texts(column: pa.Array) -> Iterator[bytes]:
    for text in column.cast(pa.binary()):
        yield text.as_py()


def rare_rows(shared):
    """Arrow step: (tag, more, n, word) for the words that are not in the list,
    each with how often its document has it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = worker_value(shared, word_codes)
        for batch in batches:
            tags = [batch.column(c) for c in TAGS]
            rows, often, words = [], [], []
            for i, raw in enumerate(raw_texts(batch.column("text"))):
                found, own = split_codes(raw, codes)
                rows.append(np.full(len(own), i))
                often.append(np.bincount(-1 - found[found < 0], minlength=len(own)))
                words += own
                if len(words) > 200_000:
                    yield _rare_batch(tags, rows, often, words)
                    rows, often, words = [], [], []
            if words:
                yield _rare_batch(tags, rows, often, words)

    return run


def _rare_batch(tags, rows, often, words):
    at = pa.array(np.concatenate(rows))
    return pa.RecordBatch.from_arrays(
        [*[t.take(at) for t in tags], pa.array(np.concatenate(often), pa.int32()), pa.array(words, pa.binary()).cast(pa.string())],
        names=[*TAGS, "n", "word"])


RARE = "tag long, more long, n int, word string"


def runs(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray, pa.Array]]:
    """For each batch sorted by a column: the batch, for each row the number of
    its run of equal values, and the value of each run."""
    for batch in batches:
        encoded = batch.column(column).dictionary_encode()
        yield batch, encoded.indices.to_numpy(zero_copy_only=False), encoded.dictionary

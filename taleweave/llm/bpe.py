"""Sub-word encoding through a distinct-word table, and decoding by a join.

Texts are split at ASCII white space, which no token crosses, and each distinct
word is encoded once. The most frequent words are encoded first and broadcast
(see `wordtable`). The others travel: documents are taken in blocks, and the
words of a block that are not in the list are sent, packed, to buckets by a hash
of the word. A bucket encodes each of its words once and sends the ids back
to the blocks. There they meet the documents, which travel as compressed word
codes instead of texts, and all ids are put in order by position.
"""

from __future__ import annotations

import hashlib
import json
import os
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taleweave.llm import wordtable as wt
from taleweave.llm.common import slices

#: Words of a block, bytes of text for each bucket of words, words put in order
#: at a time, and words encoded at a time.
BLOCK_WORDS, BUCKET_BYTES, _CHUNK, _BATCH = 250_000, 64 << 20, 120_000, 2048
_PART = "block long, bucket int, rare int, ids array<bigint>, sizes array<int>, payload binary"


class _Words:
    """The list of frequent words with their ids laid end to end."""

    def __init__(self, value):
        self.starts, self.sizes, self.ids = value


def load_tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def encode_words(tokenizer, words: list[str]) -> list[list[int]]:
    out: list[list[int]] = []
    for i in range(0, len(words), _BATCH):
        found = tokenizer.encode_batch_fast(words[i:i + _BATCH], add_special_tokens=False)
        out += [e.ids for e in found]
    return out


def _encode_frequent(spark, words: list[bytes], path: str):
    """The same encoding for the words of the list, in parts on the executors."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = load_tokenizer(path)
        for batch in batches:
            ids = encode_words(tokenizer, batch.column("word").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("code"), pa.array([np.asarray(x, np.int32).tobytes() for x in ids], pa.binary())],
                names=["code", "ids"])

    listed = pa.table({"code": pa.array(range(len(words)), pa.int32()), "word": pa.array(words, pa.binary()).cast(pa.string())})
    rows = spark.createDataFrame(listed).mapInArrow(run, "code int, ids binary").toArrow().sort_by("code")
    ids = rows.column("ids").combine_chunks()
    sizes = pc.binary_length(ids).to_numpy(zero_copy_only=False).astype(np.int64) // 4
    flat = np.frombuffer(b"".join(ids.to_pylist()), np.int32)
    return np.cumsum(sizes) - sizes, sizes, flat


def _squeeze(values: np.ndarray) -> bytes:
    """32-bit numbers as compressed byte planes."""
    planes = np.ascontiguousarray(values.astype(np.uint32)).view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=3).compress(planes.tobytes())


def _expand(payload: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(payload), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view(np.uint32).ravel().astype(np.int64)


def _rows_of(batch: pa.RecordBatch) -> Iterator[tuple]:
    """Rows of a batch as Python values, one at a time: a row may be large."""
    for i in range(batch.num_rows):
        yield tuple(c[i].as_py() for c in batch.columns)


def _parts(block, bucket, rare, ids, sizes, payload) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(block, pa.int64()), pa.array(bucket, pa.int32()), pa.array(rare, pa.int32()),
         pa.array(ids, pa.list_(pa.int64())), pa.array(sizes, pa.list_(pa.int32())), pa.array(payload, pa.binary())],
        names=["block", "bucket", "rare", "ids", "sizes", "payload"])


def _blocks(batches: Iterator[pa.RecordBatch], codes: dict[bytes, int], buckets: int):
    """Blocks of documents: their name, ids, word counts, codes, and the words
    without a code with their buckets, in ascending order of these. The i-th of
    the words has the code len(codes) + i.

    The name is a digest of the documents, so blocks made twice get the same one.
    """
    for batch in batches:
        ids = batch.column("doc_id").to_pylist()
        tags = list(zip(*[batch.column(c).to_pylist() for c in wt.TAGS]))
        start, words, sizes = 0, [], []
        for i, raw in enumerate(wt.raw_texts(batch.column("text"))):
            found = raw.split()
            words += found
            sizes.append(len(found))
            if len(words) < BLOCK_WORDS and i < len(ids) - 1:
                continue
            coded = np.fromiter((codes.get(w, -1) for w in words), np.int64, len(words))
            missing = np.flatnonzero(coded < 0)
            own: dict[bytes, int] = {}
            first = np.array([own.setdefault(words[m], len(own)) for m in missing.tolist()], np.int64)
            bucket = np.array([zlib.crc32(w) % buckets for w in own], np.int64)
            order = np.argsort(bucket, kind="stable")
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            coded[missing] = len(codes) + place[first] if len(missing) else 0
            rare = list(own)
            named = repr(list(zip(ids[start:i + 1], tags[start:i + 1]))).encode()
            name = int.from_bytes(hashlib.blake2b(named, digest_size=8).digest(), "little", signed=True)
            yield name, ids[start:i + 1], sizes, coded, [rare[o] for o in order.tolist()], bucket[order]
            start, words, sizes = i + 1, [], []


def _documents(shared, buckets: int):
    """Arrow step: a row for each block, with its documents as word codes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = wt.worker_value(shared, wt.word_codes)
        for name, ids, sizes, coded, rare, _ in _blocks(batches, codes, buckets):
            yield _parts([name], [-1], [len(rare)], [ids], [sizes], [_squeeze(coded)])

    return run


def _rare_words(shared, buckets: int):
    """Arrow step: a row for each block and bucket, with the block's words of it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = wt.worker_value(shared, wt.word_codes)
        for name, _, _, _, rare, bucket in _blocks(batches, codes, buckets):
            used, starts = np.unique(bucket, return_index=True)
            ends = [*starts[1:].tolist(), len(rare)]
            packed = [zlib.compress(b"\n".join(rare[i:j]), 6) for i, j in zip(starts.tolist(), ends)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(used), name)), pa.array(used, pa.int32()), pa.array(packed, pa.binary())],
                names=["block", "bucket", "words"])

    return run


def _encode_distinct(tokenizer, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Number of ids of each word, and all ids end to end. No more than a batch
    of words is ever held as Python values."""
    sizes, flat = [np.zeros(0, np.int64)], [np.zeros(0, np.uint32)]
    for i in range(0, len(words), _BATCH):
        found = encode_words(tokenizer, words.slice(i, _BATCH).cast(pa.large_string()).to_pylist())
        sizes.append(np.fromiter(map(len, found), np.int64, len(found)))
        flat.append(np.fromiter(chain.from_iterable(found), np.uint32, int(sizes[-1].sum())))
    return np.concatenate(sizes), np.concatenate(flat)


def _rare_ids(path: str):
    """Arrow step over rows sorted by bucket: every distinct word of a bucket is
    encoded once; each block gets the ids of its words, in their order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = load_tokenizer(path)
        bucket, rows = None, []

        def close() -> Iterator[pa.RecordBatch]:
            asked = [pa.array(zlib.decompress(packed).split(b"\n"), pa.large_binary()) for _, packed in rows]
            counts = list(map(len, asked))
            listed = pa.concat_arrays(asked).dictionary_encode()
            del asked
            places = listed.indices.to_numpy(zero_copy_only=False)
            lengths, flat = _encode_distinct(tokenizer, listed.dictionary)
            starts = np.cumsum(lengths) - lengths
            for (block, _), stop, n in zip(rows, np.cumsum(counts).tolist(), counts):
                own = places[stop - n:stop]
                size = lengths[own]
                ends = np.cumsum(size)
                ids = flat[np.repeat(starts[own] - (ends - size), size) + np.arange(size.sum())]
                yield _parts([block], [bucket], [n], [None], [None], [_squeeze(np.concatenate([size.astype(np.uint32), ids]))])

        for batch in batches:
            for block, b, packed in _rows_of(batch.select(["block", "bucket", "words"])):
                if b != bucket:
                    if rows:
                        yield from close()
                    bucket, rows = b, []
                rows.append((block, packed))
        if rows:
            yield from close()

    return run


def _gather(frequent: _Words, ids: list, sizes: np.ndarray, codes: np.ndarray, rare: tuple) -> Iterator[pa.RecordBatch]:
    """Token ids of the documents of a block, some documents at a time."""
    known = len(frequent.starts)
    word_ends = np.cumsum(sizes)
    for start, stop in slices(sizes.tolist(), _CHUNK):
        part = codes[word_ends[start] - sizes[start]:word_ends[stop - 1]]
        listed = part < known
        size, at = np.empty((2, len(part)), np.int64)
        for where, (begins, lengths) in ((listed, (frequent.starts, frequent.sizes)), (~listed, rare[:2])):
            own = part[where] if where is listed else part[where] - known
            size[where], at[where] = lengths[own], begins[own]
        ends = np.cumsum(size)
        places = np.repeat(at - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)
        far = np.repeat(~listed, size)
        values = np.empty(len(places), np.int32)
        values[~far], values[far] = frequent.ids[places[~far]], rare[2][places[far]]
        offsets = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(sizes[start:stop])])]
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids[start:stop], pa.int64()),
             pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int32()))],
            names=["doc_id", "ids"])


def _in_order(shared, finish):
    """Arrow step over rows sorted by block and bucket: a block's documents
    come first (once per repeat), then the ids of its rarer words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = wt.worker_value(shared, _Words)
        finisher = finish() if finish else None
        block, times, head, found, seen = None, 0, None, [], set()

        def close() -> Iterator[pa.RecordBatch]:
            sizes = np.concatenate([f[0] for f in found]) if found else np.zeros(0, np.int64)
            ids = np.concatenate([f[1] for f in found]) if found else np.zeros(0, np.int64)
            if head is None or len(sizes) != head[0]:
                raise ValueError("the input changed between two reads; pass a table")
            rare = (np.cumsum(sizes) - sizes, sizes, ids)
            codes = _expand(head[3])
            for _ in range(times):
                for made in _gather(frequent, head[1], np.array(head[2], np.int64), codes, rare):
                    yield finisher(made) if finisher else made

        for batch in batches:
            for name, bucket, rare, ids, sizes, payload in _rows_of(batch):
                if name != block:
                    if block is not None:
                        yield from close()
                    block, times, head, found, seen = name, 0, None, [], set()
                if bucket < 0:
                    times, head = times + 1, (rare, ids, sizes, payload)
                elif bucket not in seen:  # a repeated block brings the same words again
                    seen.add(bucket)
                    values = _expand(payload)
                    found.append((values[:rare], values[rare:]))
        if block is not None:
            yield from close()

    return run


def _encoded(docs: DataFrame, path: str, key: str, text: str, schema: str, finish=None) -> DataFrame:
    spark = docs.sparkSession
    rows = wt.keyed(docs.withColumn(key, F.col(key).cast("long")), key, text)
    words = wt.frequent_words(rows)
    listed = spark.sparkContext.broadcast(words)
    ids = spark.sparkContext.broadcast(_encode_frequent(spark, words, path) if words else (
        np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("s")).first()["s"]
    buckets = max(16, size // BUCKET_BYTES)
    rare = rows.mapInArrow(_rare_words(listed, buckets), "block long, bucket int, words binary").repartition(
        "bucket").sortWithinPartitions("bucket").mapInArrow(_rare_ids(path), _PART)
    parts = rows.mapInArrow(_documents(listed, buckets), _PART).unionByName(rare)
    together = parts.repartition("block").sortWithinPartitions("block", "bucket")
    return together.mapInArrow(_in_order(ids, finish), schema)


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids): token ids of every row's whole text, as the tokenizer
    file at `path` gives them without added special tokens. The file must lie
    at that path on every machine.

    The key is a whole number. A null text is empty and has no ids. Rows that
    repeat id and text give one row each. Other columns are ignored. An empty table gives an empty result.
    The input is read more than once and must be the same each time, as a
    table is; if it is not, an error says so.
    """
    return _encoded(docs, path, key, text, "doc_id long, ids array<int>")


def encode_decode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids, text): `decode` of `encode`, with both in one Arrow step."""
    shared = docs.sparkSession.sparkContext.broadcast(piece_table(path))

    def finish():
        pieces = pa.array(shared.value, pa.string())
        return lambda batch: _decoded(batch, "doc_id", "ids", pieces)

    return _encoded(docs, path, key, text, "doc_id long, ids array<int>, text string", finish)


def piece_table(path: str) -> list[str | None]:
    """Piece of every id, as the tokenizer file lists them."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    pieces = {i: p for p, i in spec["model"]["vocab"].items()}
    pieces |= {t["id"]: t["content"] for t in spec["added_tokens"]}
    return [pieces.get(i) for i in range(max(pieces, default=-1) + 1)]


def _decoded(batch: pa.RecordBatch, key: str, ids: str, pieces: pa.Array) -> pa.RecordBatch:
    """The join of ids to pieces: positions into the piece table."""
    lists = batch.column(ids)
    flat = lists.flatten()
    known = pc.fill_null(pc.and_(pc.greater_equal(flat, 0), pc.less(flat, len(pieces))), False)
    found = pieces.take(pc.if_else(known, flat, None))
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    if found.null_count:
        kept = np.concatenate([[0], np.cumsum(found.is_valid().to_numpy(zero_copy_only=False))])
        offsets, found = kept[offsets], found.drop_null()
    texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), found), " ")
    return pa.RecordBatch.from_arrays([batch.column(key), lists, texts], names=[key, ids, "text"])


def decode(encoded: DataFrame, path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(key, ids, text): the pieces of the ids, joined by one space, as for a
    tokenizer without a decoder. Ids without a piece are left out; null ids
    give an empty text. The piece table is as long as the vocabulary, and is
    broadcast."""
    shared = encoded.sparkSession.sparkContext.broadcast(piece_table(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pa.array(shared.value, pa.string())
        for batch in batches:
            yield _decoded(batch, key, ids, pieces)

    kind = dict(encoded.dtypes)[key]
    return encoded.select(key, ids).mapInArrow(run, f"{key} {kind}, {ids} array<int>, text string")

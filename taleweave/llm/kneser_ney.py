"""Interpolated modified Kneser-Ney bigram model.

Counting: tasks hash the words of their texts and send sorted, compressed runs
of (hash, count) to buckets of the hash range; each bucket is merged and
written to the shared folder as sorted hash arrays. A word's place in these
arrays is its number; a bigram is a mixed pair of numbers, counted likewise.
Context totals and continuation counts go to dense arrays by word number.

Scoring: workers memory-map the arrays, so the model is not held in memory, and
look up each distinct word and bigram of a run of texts once, in sorted order.
Buckets grow in number with the corpus, not in size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taleweave.llm.arrays import merge, open_array, pack, unpack, write_array
from taleweave.llm.common import slices, whole_text
from taleweave.session import working_dir

#: Bytes of text for each bucket, bytes hashed at a time, tokens of a run, and
#: word numbers of a dense array.
BUCKET_BYTES, CHUNK_BYTES, RUN_TOKENS, DENSE = 32 << 20, 3 << 20, 3_000_000, 1 << 20
_U = np.uint64
#: Number of the end token's hash; a word hashes to it with chance 2^-64.
END = _U(0x5BD1E9955BD1E995)
_TABLE = np.random.Generator(np.random.PCG64(20)).integers(1, 2 ** 64, 256, dtype=np.uint64) | _U(1)
_BASE = _U(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads them evenly."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def unmix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(31)) ^ (x >> _U(62))) * _U(pow(0x94D049BB133111EB, -1, 2 ** 64))
    x = (x ^ (x >> _U(27)) ^ (x >> _U(54))) * _U(pow(0xBF58476D1CE4E5B9, -1, 2 ** 64))
    return x ^ (x >> _U(30)) ^ (x >> _U(60))


def hash_words(texts: pa.Array, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of some texts, A-Z in lower case if asked for, and
    the number of words of each text."""
    raw = texts.cast(pa.large_binary())
    offsets = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset:raw.offset + len(raw) + 1]
    data = np.frombuffer(raw.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
    offsets = offsets - offsets[0]
    if not len(data):
        return np.zeros(0, _U), np.zeros(len(texts), np.int64)
    if lower:
        data = data + ((data >= 65) & (data <= 90)).astype(np.uint8) * np.uint8(32)
    solid = (data != 32) & ((data < 9) | (data > 13))
    first = np.zeros(len(data), bool)
    first[offsets[:-1][offsets[:-1] < len(data)]] = True
    first[1:] |= ~solid[:-1]
    first[0] = True
    first &= solid
    begins = np.flatnonzero(first)
    if not len(begins):
        return np.zeros(0, _U), np.zeros(len(texts), np.int64)
    own = np.flatnonzero(first[solid])
    sizes = np.diff(own, append=np.count_nonzero(solid))
    place = np.arange(own[-1] + sizes[-1], dtype=np.int32) - np.repeat(own.astype(np.int32), sizes)
    powers = np.cumprod(np.full(sizes.max(), _BASE, _U), dtype=_U)
    hashes = np.add.reduceat(_TABLE[data[solid]] * powers[place], own)
    counts = np.diff(np.searchsorted(begins, offsets))
    return mix(hashes + sizes.astype(_U)), counts


def with_ends(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of all texts, each closed by the end token, and their numbers."""
    counts = counts + 1
    tokens = np.empty(counts.sum(), _U)
    ends = np.cumsum(counts) - 1
    inner = np.ones(len(tokens), bool)
    inner[ends] = False
    tokens[inner], tokens[ends] = hashes, END
    return tokens, counts


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    for batch in batches:
        lengths = pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False)
        for start, stop in slices(lengths.tolist(), CHUNK_BYTES):
            part = batch.slice(start, stop - start)
            yield part, *with_ends(*hash_words(part.column("text")))


def _send(keys: np.ndarray, counts: np.ndarray, bits: int) -> pa.RecordBatch:
    """One row per bucket: the top bits of the ascending keys name it."""
    cuts = np.searchsorted(keys, np.arange(1 << bits, dtype=_U) << _U(64 - bits))
    bounds = [*cuts.tolist(), len(keys)]
    rows = [(b, pack([keys[i:j], counts[i:j]])) for b, (i, j) in enumerate(zip(bounds, bounds[1:])) if j > i]
    return _rows(rows)


def _rows(rows: list[tuple[int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([b for b, _ in rows], pa.int32()), pa.array([p for _, p in rows], pa.binary())],
        names=["bucket", "payload"])


_SENT = "bucket int, payload binary"


def _by_bucket(batches: Iterator[pa.RecordBatch], columns: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    """Merged contents of each bucket of rows sorted by bucket. Runs are merged
    as they come, so no more than the bucket itself is held."""
    bucket, parts, held = None, [], 0
    for batch in batches:
        for b, payload in zip(batch.column("bucket").to_pylist(), batch.column("payload")):
            if b != bucket:
                if parts:
                    yield bucket, merge(parts)
                bucket, parts, held = b, [], 0
            parts.append(unpack(payload.as_py(), columns))
            held += len(parts[-1][0])
            if held > 2 * RUN_TOKENS and held > 2 * len(parts[0][0]):
                parts = [merge(parts)]
                held = len(parts[0][0])
    if parts:
        yield bucket, merge(parts)


@dataclass
class Model:
    """Where a model lies, and its few totals."""

    path: str
    bits: int
    word_starts: list[int]  # first word number of each bucket of the word arrays
    words: int
    tokens: int
    discounts: list[list[float]]  # for continuation counts and for bigram counts: 0, D1, D2, D3+
    continuations: int
    taken: float  # what discounting takes from the continuation counts


class SortedHashes:
    """Buckets of one kind of sorted hash arrays, mapped when first used."""

    def __init__(self, path: str, kind: str, bits: int, empty: set[int]):
        self.path, self.kind, self.bits, self.empty, self.open = path, kind, bits, empty, {}

    def find(self, keys: np.ndarray) -> Iterator[tuple[int, slice, np.ndarray, np.ndarray]]:
        """For ascending keys: bucket, the keys' range, their places, found."""
        if not len(keys):
            return
        numbers = (keys >> _U(64 - self.bits)).astype(np.int64)
        for b in np.unique(numbers).tolist():
            if b in self.empty:
                continue
            if b not in self.open:
                self.open[b] = [open_array(f"{self.path}/{self.kind}-{b}-{part}.npy") for part in ("key", "count")]
            held = self.open[b][0]
            at = slice(*np.searchsorted(numbers, [b, b + 1]).tolist())
            places = np.searchsorted(held, keys[at])
            inside = np.minimum(places, len(held) - 1)
            yield b, at, inside, held[inside] == keys[at]

    def counts(self, keys: np.ndarray) -> np.ndarray:
        out = np.zeros(len(keys), np.int64)
        for b, at, places, found in self.find(keys):
            out[at] = np.where(found, self.open[b][1][places], 0)
        return out


class Words(SortedHashes):
    def __init__(self, model: Model):
        sizes = np.diff([*model.word_starts, model.words])
        super().__init__(model.path, "word", model.bits, set(np.flatnonzero(sizes == 0).tolist()))
        self.starts = model.word_starts

    def numbers(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number (-1: unknown) and count of ascending word hashes."""
        number, count = np.full(len(hashes), -1), np.zeros(len(hashes), np.int64)
        for b, at, places, found in self.find(hashes):
            number[at] = np.where(found, places + self.starts[b], -1)
            count[at] = np.where(found, self.open[b][1][places], 0)
        return number, count


def _pair_keys(numbers: np.ndarray, lengths: np.ndarray, begin: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the contexts of all tokens, and mixed keys of the pairs."""
    before = np.empty_like(numbers)
    before[1:] = numbers[:-1]
    before[np.cumsum(lengths) - lengths] = begin
    return before, mix((before.astype(_U) << _U(32)) | (numbers.astype(_U) & _U(0xFFFFFFFF)))


def _count_words(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for _, tokens, _ in _chunks(batches):
            held.append(tokens)
            size += len(tokens)
            if size > RUN_TOKENS:
                yield _send(*np.unique(np.concatenate(held), return_counts=True), bits)
                held, size = [], 0
        if held:
            yield _send(*np.unique(np.concatenate(held), return_counts=True), bits)

    return run


def _write_words(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, (keys, counts) in _by_bucket(batches, 2):
            write_array(f"{path}/word-{b}-key.npy", keys)
            write_array(f"{path}/word-{b}-count.npy", counts.astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array([b], pa.int32()), pa.array([len(keys)]), pa.array([int(counts.sum())])],
                names=["bucket", "entries", "total"])

    return run


def _count_pairs(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(model)
        held, size = [], 0
        for _, tokens, lengths in _chunks(batches):
            distinct, which = np.unique(tokens, return_inverse=True)
            held.append(_pair_keys(words.numbers(distinct)[0][which], lengths, model.words)[1])
            size += len(tokens)
            if size > RUN_TOKENS:
                yield _send(*np.unique(np.concatenate(held), return_counts=True), model.bits)
                held, size = [], 0
        if held:
            yield _send(*np.unique(np.concatenate(held), return_counts=True), model.bits)

    return run


def _write_pairs(path: str):
    """Arrow step: write the bigrams of a bucket; send what they add to their
    contexts and to their words, by range of word numbers. Bucket -1 carries
    how many bigrams occur once to four times."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, (keys, counts) in _by_bucket(batches, 2):
            write_array(f"{path}/pair-{b}-key.npy", keys)
            write_array(f"{path}/pair-{b}-count.npy", counts.astype(np.uint32 if counts.max() < 2 ** 32 else np.uint64))
            often = [(counts == k).astype(np.int64) for k in (1, 2)] + [(counts > 2).astype(np.int64)]
            pairs = unmix(keys)
            none = np.zeros(len(keys), np.int64)
            adds = merge([
                [pairs >> _U(32), counts.astype(np.int64), *often, none],
                [pairs & _U(0xFFFFFFFF), none, none, none, none, none + 1]])
            cuts = np.searchsorted(adds[0], np.arange(0, int(adds[0][-1]) + DENSE, DENSE).astype(_U))
            rows = [(i, pack([c[x:y] for c in adds])) for i, (x, y) in enumerate(zip(cuts, [*cuts[1:], len(adds[0])])) if y > x]
            seen = np.array([np.count_nonzero(counts == k) for k in (1, 2, 3, 4)])
            yield _rows([*rows, (-1, pack([np.arange(4), seen]))])

    return run


def _write_dense(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def tell(kind, seen, total):
            return pa.RecordBatch.from_arrays(
                [pa.array([kind]), pa.array([[int(x) for x in seen]], pa.list_(pa.int64())), pa.array([int(total)])],
                names=["kind", "seen", "total"])

        def sorted_parts():
            for batch in batches:
                for b, p in zip(batch.column("bucket").to_pylist(), batch.column("payload")):
                    yield b, p.as_py()

        bucket, dense = None, None

        def close():
            for i, name in enumerate(("total", "once", "twice", "more", "before")):
                write_array(f"{path}/dense-{bucket}-{name}.npy", dense[i])
            before = dense[4]
            return tell("word", [np.count_nonzero(before == k) for k in (1, 2, 3, 4)], before.sum())

        for b, payload in sorted_parts():
            if b < 0:
                yield tell("pair", unpack(payload, 2)[1], 0)
                continue
            if b != bucket:
                if bucket is not None:
                    yield close()
                bucket, dense = b, np.zeros((5, DENSE), np.int64)
            numbers, *columns = unpack(payload, 6)
            at = (numbers - _U(b * DENSE)).astype(np.int64)
            for i, c in enumerate(columns):
                dense[i, at] += c.astype(np.int64)
        if bucket is not None:
            yield close()

    return run


def discounts(seen: list[int]) -> list[float]:
    """[0, D1, D2, D3+] from how many n-grams occur once to four times. Where
    these are too few for the formula: 0.5, 1, 1.5."""
    n1, n2, n3, n4 = seen
    if min(seen) == 0:
        return [0.0, 0.5, 1.0, 1.5]
    y = n1 / (n1 + 2 * n2)
    found = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
    return [0.0, *[min(max(d, 0.0), float(k)) for k, d in enumerate(found, 1)]]


def train(docs: DataFrame, text: str = "text") -> Model:
    """Count the whole texts of the given rows and write the model."""
    spark = docs.sparkSession
    rows = docs.select(whole_text(text).alias("text"))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("s")).first()["s"]
    bits = max(3, (size // BUCKET_BYTES).bit_length())
    path = working_dir(spark, "model")

    def dealt(df: DataFrame) -> DataFrame:
        return df.repartition(1 << bits, "bucket").sortWithinPartitions("bucket")

    counted = dealt(rows.mapInArrow(_count_words(bits), _SENT)).mapInArrow(
        _write_words(path), "bucket int, entries long, total long").collect()  # one row per bucket
    entries = {r["bucket"]: r["entries"] for r in counted}
    sizes = [entries.get(b, 0) for b in range(1 << bits)]
    starts = [int(x) for x in np.cumsum([0, *sizes[:-1]])]
    words, tokens = sum(sizes), sum(r["total"] for r in counted)
    if words >= 2 ** 32 - 1:
        raise ValueError("word numbers have 32 bits")
    model = Model(path, bits, starts, words, tokens, [], 0, 0.0)
    sent = dealt(rows.mapInArrow(_count_pairs(model), _SENT)).mapInArrow(_write_pairs(path), _SENT)
    told = dealt(sent).mapInArrow(_write_dense(path), "kind string, seen array<bigint>, total long").collect()

    def seen(kind):
        return [sum(r["seen"][k] for r in told if r["kind"] == kind) for k in range(4)]

    model.discounts = [discounts(seen("word")), discounts(seen("pair"))]
    model.continuations = sum(r["total"] for r in told)
    once, twice = seen("word")[:2]
    # every word follows something
    model.taken = float(np.dot(model.discounts[0][1:], [once, twice, words - once - twice]))
    return model


class Scorer:
    """Probabilities from the mapped arrays of a model."""

    def __init__(self, model: Model):
        self.model, self.words = model, Words(model)
        self.pairs = SortedHashes(model.path, "pair", model.bits, set())
        self.dense: dict = {}

    def look(self, name: str, numbers: np.ndarray) -> np.ndarray:
        """Values of a dense array at word numbers; 0 for unknown ones."""
        out = np.zeros(len(numbers), np.int64)
        if not self.model.tokens:
            return out
        block = numbers // DENSE
        for b in np.unique(block[numbers >= 0]).tolist():
            if (b, name) not in self.dense:
                self.dense[b, name] = open_array(f"{self.model.path}/dense-{b}-{name}.npy")
            at = np.flatnonzero(block == b)
            out[at] = self.dense[b, name][numbers[at] - b * DENSE]
        return out

    def unigram(self, numbers: np.ndarray) -> np.ndarray:
        """Continuation probability, interpolated with the uniform one over all
        words and one unknown word."""
        m = self.model
        even = 1 / (m.words + 1)
        if not m.continuations:
            return np.full(len(numbers), even)
        before = self.look("before", numbers)
        cut = np.array(m.discounts[0])[np.minimum(before, 3)]
        return np.maximum(before - cut, 0) / m.continuations + m.taken / m.continuations * even

    def score(self, tokens: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Log10 probability, base score and known tokens of each text."""
        m = self.model
        distinct, which = np.unique(tokens, return_inverse=True)
        number, count = self.words.numbers(distinct)
        single = self.unigram(number)
        base = np.log10((count + 0.1) / (m.tokens + 0.1 * (m.words + 1)))
        before, keys = _pair_keys(number[which], lengths, m.words)
        pairs, place, back = np.unique(keys, return_index=True, return_inverse=True)
        context, word = before[place], which[place]
        known = (context >= 0) & (number[word] >= 0)
        often = np.zeros(len(pairs), np.int64)
        often[known] = self.pairs.counts(pairs[known])
        total = self.look("total", context)
        cuts = m.discounts[1]
        kept = sum(cuts[k] * self.look(n, context) for k, n in enumerate(("once", "twice", "more"), 1))
        share = np.maximum(total, 1)
        chance = np.where(
            total > 0,
            np.maximum(often - np.array(cuts)[np.minimum(often, 3)], 0) / share + kept / share * single[word],
            single[word])
        first = np.cumsum(lengths) - lengths
        return (np.add.reduceat(np.log10(chance)[back], first), np.add.reduceat(base[which], first),
                np.add.reduceat((count > 0).astype(np.int64)[which], first))


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_tokens, n_known, train_tokens, base_score, score) of every row's
    whole text; a null text is empty and has the end token alone."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for part, tokens, lengths in _chunks(batches):
            found, base, known = scorer.score(tokens, lengths)
            yield pa.RecordBatch.from_arrays(
                [part.column("key"), pa.array(lengths), pa.array(known), pa.array(np.full(len(lengths), model.tokens)),
                 pa.array(base), pa.array(found)],
                names=[key, "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    kind = dict(docs.dtypes)[key]
    return docs.select(F.col(key).alias("key"), whole_text(text).alias("text")).mapInArrow(
        run, f"{key} {kind}, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def held_out(key: str = "doc_id", parts: int = 10):
    """Rows whose crc32 of the key as text leaves no remainder; a null key counts as empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))) % parts == 0


def perplexity_scores(docs: DataFrame, key: str = "doc_id", text: str = "text", parts: int = 10) -> DataFrame:
    """Train on the rows that are not held out, and score all rows.

    Repeated rows count as often as they occur. Without training rows every
    word is unknown and the model is uniform. Other columns are ignored.
    """
    out = held_out(key, parts)
    model = train(docs.where(~out), text)
    scored = score(docs, model, key, text)
    return scored.withColumn("held_out", out)

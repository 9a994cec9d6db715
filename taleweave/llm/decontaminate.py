"""Benchmark passages in documents, found by an Aho-Corasick automaton.

Items of a benchmark are cut into windows of words. One automaton over all
windows, whose letters are word numbers, reads the words of a document once and
names every window that ends at a word; the words of the window are hit, and
their places are kept as offsets in the original text.

Documents are not shuffled: the automaton goes to them. Its size is bounded: a
benchmark with more windows is dealt into parts by window and item, and the
documents are read once for each part.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taleweave.llm.common import settled, whole_text
from taleweave.llm.wordtable import worker_value

#: Words of a window.
WINDOW = 10
#: Bounds of one automaton: (window, item) pairs and bytes of windows.
PART_PAIRS, PART_BYTES = 1 << 17, 16 << 20
#: A-Z in lower case; every other ASCII character but 0-9 and a-z is a space.
#: Bytes of non-ASCII characters are letters.
_LETTERS = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_SPANS = "array<struct<start:bigint,stop:bigint>>"


def item_windows(benchmark: DataFrame, key: str = "item_id", text: str = "text", size: int = WINDOW) -> DataFrame:
    """(window, item): distinct windows of each item, words joined by spaces;
    an item of fewer words, but not none, is one window."""
    lower = F.translate(whole_text(text), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = F.regexp_extract_all(lower, F.lit("([^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+)"), F.lit(1))
    rows = benchmark.select(F.col(key).cast("string").alias("item"), words.alias("words")).where(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - size + 1, F.lit(1)))
    return rows.select("item", "words", F.explode(starts).alias("start")).select(
        F.array_join(F.slice("words", F.col("start"), size), " ").alias("window"), "item").distinct()


def _automaton(pairs: list[tuple[bytes, str | None]]):
    """Word numbers, the automaton over them, and for each window its number
    of words and its items. A window in many items is one pattern."""
    import ahocorasick

    codes: dict[bytes, int] = {}
    windows: dict[tuple, int] = {}
    items: list[set] = []
    for window, item in pairs:
        pattern = tuple(codes.setdefault(w, len(codes) + 1) for w in window.split(b" "))
        at = windows.setdefault(pattern, len(items))
        if at == len(items):
            items.append(set())
        if item is not None:
            items[at].add(item)
    found = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
    for pattern, at in windows.items():
        found.add_word(pattern, at)
    found.make_automaton()
    return codes, found, np.array([len(p) for p in windows], np.int64), items


def _word_places(raw: bytes, letters: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every word, in characters of the text."""
    is_letter = np.frombuffer(letters, np.uint8) != 32
    edges = np.flatnonzero(np.diff(is_letter, prepend=False, append=False))
    # bytes 10xxxxxx continue a character
    chars = np.concatenate([[0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)])
    return chars[edges[::2]], chars[edges[1::2]]


def scan_text(raw: bytes, automaton) -> tuple[int, np.ndarray, set]:
    """Number of words, which words are hit (or none), and the items."""
    codes, found, lengths, items = automaton
    words = raw.translate(_LETTERS).split()
    if not len(lengths):
        return len(words), np.zeros(0, bool), set()
    ends, names = [], []
    for end, name in found.iter(tuple(map(codes.get, words, repeat(0)))):
        ends.append(end)
        names.append(name)
    if not ends:
        return len(words), np.zeros(0, bool), set()
    ends = np.array(ends, np.int64) + 1
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, ends - lengths[names], 1)
    np.add.at(change, ends, -1)
    return len(words), np.cumsum(change[:-1]) > 0, set().union(*(items[n] for n in set(names)))


def _scan(shared, last: bool):
    """Arrow step: hits of a part joined to those of earlier parts. The last
    one lets go of the text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = worker_value(shared, _automaton)
        for batch in batches:
            counts, totals, spans, named = [], [], [], []
            totals_before, hits, items = (batch.column(c).to_pylist() for c in ("n_hit", "hits", "items"))
            for text, total, before, known in zip(batch.column("_text").cast(pa.binary()), totals_before, hits, items):
                raw = text.as_py()
                n, hit, own = scan_text(raw, automaton)
                if len(hit):
                    starts, stops = _word_places(raw, raw.translate(_LETTERS))
                    for s in before:
                        hit |= (starts >= s["start"]) & (stops <= s["stop"])
                    edges = np.flatnonzero(np.diff(hit, prepend=False, append=False))
                    before = [{"start": int(starts[a]), "stop": int(stops[b - 1])} for a, b in zip(edges[::2], edges[1::2])]
                    total = int(hit.sum())
                counts.append(n)
                totals.append(total)
                spans.append(before)
                named.append(sorted(own.union(known)))
            out = {"row": batch.column("row"), "n_words": pa.array(counts, pa.int64()), "n_hit": pa.array(totals, pa.int64()),
                   "hits": pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))),
                   "items": pa.array(named, pa.list_(pa.string()))}
            if not last:
                out["_text"] = batch.column("_text")
            yield pa.RecordBatch.from_arrays(list(out.values()), names=list(out))

    return run


def _parts(windows: DataFrame) -> list[DataFrame]:
    """Pairs dealt by digest so that each part is within the bounds."""
    pairs, size = windows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("window")), F.lit(0))).first()
    n = max(-(-pairs // PART_PAIRS), -(-size // PART_BYTES))
    if n <= 1:
        return [windows]
    # a quarter of room for uneven digests
    n += n // 4 + 1
    dealt = windows.withColumn("part", F.pmod(F.xxhash64("window", "item"), F.lit(n)))
    return [dealt.where(F.col("part") == i).drop("part") for i in range(n)]


def contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id",
                 item_text: str = "text", size: int = WINDOW, keep: Sequence[str] | None = None) -> DataFrame:
    """(row, n_words, n_hit, hits, items): the given columns (or `keep` of
    them) as one struct; the number of words and of those in an occurrence of a
    window; maximal runs of hit words as [start, stop) in characters of the
    text; ids of items with an occurring window, as strings in order.

    A null text has no words. Items are told apart by id, so repeated ones
    count once; an item without an id hits words but is not named. Empty
    tables give no rows, or no hits. Columns of any name stay in `row`.
    """
    spark = docs.sparkSession
    windows = settled(item_windows(benchmark, item, item_text, size), "windows")
    rows = docs.select(
        F.struct(*(docs.columns if keep is None else keep)).alias("row"), whole_text(text).alias("_text"),
        F.lit(0).cast("long").alias("n_hit"), F.array().cast(_SPANS).alias("hits"),
        F.array().cast("array<string>").alias("items"))
    kind = rows.schema["row"].dataType.simpleString()
    parts = _parts(windows)
    for i, part in enumerate(parts):
        pairs = part.toArrow()  # within PART_PAIRS and PART_BYTES
        pairs = list(zip((w.as_py().encode() for w in pairs.column("window")), pairs.column("item").to_pylist()))
        shared, last = spark.sparkContext.broadcast(pairs), i == len(parts) - 1
        found = f"row {kind}, n_words long, n_hit long, hits {_SPANS}, items array<string>"
        rows = rows.select("row", "_text", "n_hit", "hits", "items").mapInArrow(
            _scan(shared, last), found if last else f"{found}, _text string")
        if not last:
            rows = settled(rows, "scanned")
    return rows

"""Vector codes from product codebooks, searched as Orchard does.

A vector becomes whole numbers and is cut into equal parts; each part is
replaced by the number of its codebook's nearest entry. For every entry a list
of all entries is kept, sorted by distance to it. A search walks the list of
its best entry so far, jumps to the list of an entry that is better, marks what
it has measured, and stops beyond twice its distance: by the triangle
inequality nothing further down can be as near.

A codebook is a few entries whatever the table, so it travels with the tasks;
rounds send one row of sums for each entry and task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taleweave.llm.common import settled
from taleweave.llm.topk import whole_weights

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024.0
#: Neighbours measured at a time, rows searched together, and entries that a
#: search may start from.
STRIDE, ROWS, PIVOTS = 16, 1024, 16
#: Whole components beyond this could overflow a distance; they are refused.
LARGEST = 1 << 24
#: Labels whose sums are broadcast: the most frequent ones, of a fixed number.
FREQUENT_LABELS = 1000


class Orchard:
    """Nearest entry of one codebook, ties to the lower number."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries.astype(np.int64)
        n = len(entries)
        self.norms = (self.entries ** 2).sum(axis=1)
        between = np.stack([((self.entries - e) ** 2).sum(axis=1) for e in self.entries])
        self.lists = np.argsort(between, axis=1, kind="stable")
        # rows end in a stop, so that a stride never runs past a list
        self.apart = np.pad(np.take_along_axis(between, self.lists, axis=1), ((0, 0), (0, STRIDE)),
                            constant_values=np.iinfo(np.int64).max)
        self.lists = np.pad(self.lists, ((0, 0), (0, STRIDE)))
        self.pivots = np.unique(np.linspace(0, n - 1, min(n, PIVOTS)).astype(np.int64))

    def search(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and squared distance of the nearest entry of each row."""
        rows = np.arange(len(vectors))
        norms = (vectors ** 2).sum(axis=1)
        marked = np.zeros((len(vectors), len(self.entries)), bool)
        first = norms[:, None] - 2 * (vectors @ self.entries[self.pivots].T) + self.norms[self.pivots]
        marked[:, self.pivots] = True
        start = first.argmin(axis=1)
        best, dist = self.pivots[start], first[rows, start]
        place = np.zeros(len(vectors), np.int64)
        live = rows
        while len(live):
            at = place[live][:, None] + np.arange(STRIDE)
            near = self.apart[best[live][:, None], at] <= 4 * dist[live][:, None]
            names = self.lists[best[live][:, None], at]
            i, j = np.nonzero(near & ~marked[live[:, None], names])
            who, which = live[i], names[i, j]
            marked[who, which] = True
            found = norms[who] - 2 * np.einsum("ij,ij->i", vectors[who], self.entries[which]) + self.norms[which]
            # the best of each row's stride: the least distance, then number
            order = np.lexsort((which, found, who))
            who, which, found = who[order], which[order], found[order]
            head = np.flatnonzero(np.diff(who, prepend=-1))
            who, which, found = who[head], which[head], found[head]
            better = (found < dist[who]) | ((found == dist[who]) & (which < best[who]))
            who, which, found = who[better], which[better], found[better]
            place[live] += STRIDE
            best[who], dist[who], place[who] = which, found, 0  # jump to the better entry's list
            jumped = np.zeros(len(vectors), bool)
            jumped[who] = True
            live = live[near.all(axis=1) | jumped[live]]
        return best, dist


def _matrix(lists: pa.Array, width: int) -> np.ndarray:
    """Rows of whole numbers, short ones padded with zeros."""
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    if len(flat) and (flat.max() > LARGEST or flat.min() < -LARGEST):
        raise ValueError(f"components beyond {LARGEST} after scaling have no exact distances here")
    out = np.zeros((len(sizes), width), np.int64)
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _searched(batches: Iterator[pa.RecordBatch], books) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    """Pieces of batches with their parts (rows, parts, width), codes and
    squared distances (rows, parts)."""
    searches, width = [], books.value.shape[2]
    for batch in batches:
        if batch.num_rows and not searches:
            searches = [Orchard(b) for b in books.value]
        for start in range(0, batch.num_rows, ROWS):
            piece = batch.slice(start, ROWS)
            parts = _matrix(piece.column("w"), PARTS * width).reshape(piece.num_rows, PARTS, width)
            found = [s.search(np.ascontiguousarray(parts[:, p])) for p, s in enumerate(searches)]
            yield piece, parts, np.stack([f[0] for f in found], axis=1), np.stack([f[1] for f in found], axis=1)


def _sums(books):
    """Arrow step: for every entry used, the number of its parts and their sum."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, entries, width = books.value.shape
        count, total = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, width), np.int64)
        for _, cut, codes, _ in _searched(batches, books):
            for p in range(parts):
                np.add.at(total[p], codes[:, p], cut[:, p])
                count[p] += np.bincount(codes[:, p], minlength=entries)
        p, e = np.nonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(p * entries + e), pa.array(count[p, e]), pa.array(total[p, e].tolist(), pa.list_(pa.int64()))],
            names=["entry", "n", "total"])

    return run


def _codes(books):
    """Arrow step: code and error of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, _, codes, dists in _searched(batches, books):
            yield pa.RecordBatch.from_arrays(
                [piece.column("key"), piece.column("label"),
                 pa.array([bytes(c).hex() for c in codes.astype(np.uint8)], pa.string()), pa.array(dists.sum(axis=1))],
                names=["key", "label", "code", "error"])

    return run


def _step(books: np.ndarray, rows: DataFrame) -> np.ndarray:
    """One round: every entry becomes the floor of the mean of its parts."""
    shared = rows.sparkSession.sparkContext.broadcast(books)
    found = rows.select("w").mapInArrow(_sums(shared), "entry long, n long, total array<long>")
    # partial sums of the tasks: at most PARTS * ENTRIES entries come back
    summed = found.select("entry", "n", F.posexplode("total").alias("at", "x")).groupBy("entry", "at").agg(
        F.sum("n").alias("n"), F.sum("x").alias("x"))
    got = summed.toPandas()
    shared.unpersist()
    out = books.copy().reshape(-1, books.shape[2])
    out[got["entry"], got["at"]] = got["x"] // got["n"]
    return out.reshape(books.shape)


def train(rows: DataFrame, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks (PARTS, entries, width) of rows (key, w), from the least keys
    on; rows of equal or null keys (last) follow their components."""
    width = rows.agg(F.max(F.size("w"))).first()[0]
    width = -(-width // PARTS)
    seeds = rows.select("key", "w").orderBy(F.asc_nulls_last("key"), "w").limit(ENTRIES).toArrow()
    lists = seeds.column("w").combine_chunks().cast(pa.list_(pa.int64()))
    books = _matrix(lists, PARTS * width).reshape(len(lists), PARTS, width).transpose(1, 0, 2).copy()
    for _ in range(rounds if width else 0):
        books = _step(books, rows)
    return books


def books_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def vector_rows(vectors: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """(key, label, w) of the vectors that take part."""
    finite = F.forall(F.col(vector), lambda x: x.isNotNull() & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    return vectors.where(F.coalesce(finite, F.lit(False))).select(
        F.col(key).alias("key"), F.col(label).alias("label"), whole_weights(vector, SCALE).alias("w"))


def _label_errors(coded: DataFrame) -> DataFrame:
    """Adds `label_error`. The most frequent labels, a fixed number of rows,
    are broadcast, so that no hot label is shuffled."""
    sums = settled(coded.groupBy(F.col("label").alias("name")).agg(
        F.sum("error").alias("label_error"), F.count(F.lit(1)).alias("n")), "label-errors")
    frequent = sums.orderBy(F.desc("n"), "name").limit(FREQUENT_LABELS).select("name", "label_error")
    own = F.col("label").eqNullSafe(F.col("name"))
    if sums.count() <= FREQUENT_LABELS:
        return coded.join(F.broadcast(frequent), own).drop("name")
    frequent = settled(frequent, "frequent-labels")
    rest = coded.join(F.broadcast(frequent), own, "left_anti").join(sums.drop("n"), own)
    return coded.join(F.broadcast(frequent), own).unionByName(rest).drop("name")


def encode(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label",
           rounds: int = ROUNDS) -> DataFrame:
    """(key, code, error, label_error, codebooks_sha256).

    Vectors that are null or hold a null or non-finite component are left out.
    Shorter vectors, and lengths that PARTS does not divide, count as padded
    with zeros. Rows of one key are rows of their own; null labels are one
    label. Components beyond LARGEST after scaling stop the job with an error.
    An empty table has no rows. Only the named columns are read.
    """
    rows = settled(vector_rows(vectors, key, vector, label), "vectors")
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    if rows.isEmpty():
        books = np.zeros((PARTS, 0, 0), np.int64)
    else:
        books = train(rows, rounds)
    shared = rows.sparkSession.sparkContext.broadcast(books)
    coded = settled(rows.mapInArrow(_codes(shared), f"key {kinds['key']}, label {kinds['label']}, code string, error long"), "codes")
    return _label_errors(coded).select(
        F.col("key").alias(key), "code", "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256"))

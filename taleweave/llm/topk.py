"""Exact top-k inner-product search by term-at-a-time accumulation.

A vector is a sparse row: its terms are the positions of its non-zero
weights. Rows are dealt into blocks by a digest, as many blocks as the number
of rows asks for; a block turns into postings, one list of (row, weight) per
term. A block of queries walks the terms, scatters query weight times posting
weight into dense score arrays, and keeps each query's k best of the block by
partition selection. The k best per block are merged with a window.

Candidate blocks are dealt to tasks, a few to each. A task reads the query
blocks one by one from the shared folder, so they are not copied for each
candidate block, by a shuffle or by the driver. Where candidate blocks are few,
each goes to several tasks, which read different files of query blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from taleweave.llm.common import settled

#: Rows of a candidate block and of a query block, about.
BLOCK_ROWS = 4096
QUERY_ROWS = 1024
#: Tasks that there are at least if blocks suffice, and candidate blocks of a
#: task, about, where there are more.
TASKS, TASK_BLOCKS = 256, 4
#: Scores that are worked on together, so that they stay in the cache.
SCORES = 1 << 17
_BLOCK = "block int, ids binary, starts binary, rows binary, weights binary, kind string"
_FOUND = "query_id long, vec_id long, score long"


def whole_weights(vector: str, scale: float) -> Column:
    """floor(scale * x) of every component, computed in doubles."""
    return F.transform(F.col(vector), lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))


def usable(key: str, vector: str) -> Column:
    """Rows that take part: a key, a vector, and only finite components."""
    finite = F.forall(F.col(vector), lambda x: x.isNotNull() & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    return F.col(key).isNotNull() & F.coalesce(finite, F.lit(False))


def _postings(block: int, ids: np.ndarray, lists: pa.Array) -> pa.RecordBatch:
    """A block as lists by term: where each term starts, row numbers, weights
    in the narrowest whole type."""
    order = np.argsort(ids, kind="stable")
    lists = lists.take(pa.array(order))
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    row = np.repeat(np.arange(len(ids)), sizes)
    term = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    some = np.flatnonzero(flat)
    some = some[np.argsort(term[some], kind="stable")]
    starts = np.searchsorted(term[some], np.arange(sizes.max(initial=0) + 1))
    weights = flat[some]
    top = max(int(weights.max(initial=0)), -int(weights.min(initial=0)))
    kind = next(k for k in ("i1", "i2", "i4", "i8") if top <= np.iinfo(k).max)
    arrays = (ids[order], starts.astype(np.int32), row[some].astype(np.int32 if len(ids) > 1 << 15 else np.int16), weights.astype(kind))
    return pa.RecordBatch.from_arrays(
        [pa.array([block], pa.int32()), *[pa.array([a.tobytes()], pa.binary()) for a in arrays], pa.array([kind])],
        names=["block", "ids", "starts", "rows", "weights", "kind"])


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow step over rows (block, id, w) sorted by block: a row per block."""
    held: list[pa.RecordBatch] = []

    def close() -> pa.RecordBatch:
        rows = pa.Table.from_batches(held).combine_chunks()
        return _postings(
            held[0].column("block")[0].as_py(), rows.column("id").to_numpy(), rows.column("w").combine_chunks())

    for batch in batches:
        blocks = batch.column("block").to_numpy()
        for part in np.split(np.arange(len(blocks)), np.flatnonzero(np.diff(blocks)) + 1):
            if not len(part):
                continue
            if held and held[0].column("block")[0].as_py() != blocks[part[0]]:
                yield close()
                held = []
            held.append(batch.slice(int(part[0]), len(part)))
    if held:
        yield close()


def blocks_of(df: DataFrame, size: int) -> tuple[DataFrame, int]:
    """Blocks of the distinct rows (id, w), and how many blocks there may be:
    it follows from the number of rows alone."""
    rows = settled(df.distinct(), "vectors")
    count = max(1, -(-rows.count() // size))
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("id", "w"), F.lit(count)).cast("int"))
    packed = dealt.repartition("block").sortWithinPartitions("block").select("block", "id", "w").mapInArrow(_pack, _BLOCK)
    return settled(packed, "blocks"), count


def _best(scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the earlier place."""
    if len(scores) <= k:
        return np.arange(len(scores))
    bar = np.partition(scores, len(scores) - k)[len(scores) - k]
    above = np.flatnonzero(scores > bar)
    return np.concatenate([above, np.flatnonzero(scores == bar)[: k - len(above)]])


class _Block:
    def __init__(self, batch: pa.RecordBatch, i: int):
        def read(name, kind):
            return np.frombuffer(batch.column(name)[i].as_py(), kind)

        self.ids, self.starts = read("ids", np.int64), read("starts", np.int32)
        self.rows = read("rows", np.int32 if len(self.ids) > 1 << 15 else np.int16)
        self.weights = read("weights", batch.column("kind")[i].as_py())

    def term(self, t: int) -> tuple[np.ndarray, np.ndarray]:
        a, b = self.starts[t], self.starts[t + 1]
        return self.rows[a:b], self.weights[a:b].astype(np.int64)


def _stored(paths: list[str]) -> Iterator[_Block]:
    """The blocks in files of the shared folder, one at a time."""
    for path in paths:
        store, name = fs.FileSystem.from_uri(path)
        with store.open_input_file(name) as f:
            for batch in pq.ParquetFile(f, buffer_size=1 << 20).iter_batches(batch_size=1):
                if batch.num_rows:
                    yield _Block(batch, 0)


def _filled(rows: np.ndarray, weights: np.ndarray, size: int) -> np.ndarray:
    if len(rows) == size:  # all rows in order
        return weights
    every = np.zeros(size, np.int64)
    every[rows] = weights
    return every


def _scores(asked: _Block, block: _Block) -> Iterator[tuple[int, np.ndarray]]:
    """Rows of scores of a query block, some at a time, with the first's number."""
    size = max(1, SCORES // max(1, len(block.ids)))
    terms = range(min(len(asked.starts), len(block.starts)) - 1)
    added = np.empty((size, len(block.ids)), np.int64)
    for low in range(0, len(asked.ids), size):
        scores = np.zeros((min(size, len(asked.ids) - low), len(block.ids)), np.int64)
        for t in terms:
            q_rows, q_weights = asked.term(t)
            first, last = np.searchsorted(q_rows, [low, low + len(scores)])
            q_rows, q_weights = q_rows[first:last] - low, q_weights[first:last]
            rows, weights = block.term(t)
            if not len(q_rows) or not len(rows):
                continue
            if 2 * len(rows) < len(block.ids):
                scores[np.ix_(q_rows, rows)] += np.multiply.outer(q_weights, weights)
                continue
            # a term of most rows: the others weigh nothing
            weights = _filled(rows, weights, len(block.ids))
            if 2 * len(q_rows) < len(scores):
                scores[q_rows] += np.multiply.outer(q_weights, weights)
            else:
                scores += np.multiply.outer(_filled(q_rows, q_weights, len(scores)), weights, out=added[:len(scores)])
        yield low, scores


def _accumulate(k: int, paths: list[str], parts: int):
    """Arrow step over candidate blocks (with `part`, the share of the files
    of query blocks that they meet): the k best of each query row."""
    def pair(asked: _Block, block: _Block) -> list[np.ndarray]:
        out = ([], [], [])
        for low, scores in _scores(asked, block):
            for row, line in enumerate(scores, low):
                own, names = asked.ids[row], block.ids
                first, last = np.searchsorted(names, [own, own + 1]) if own < np.iinfo(np.int64).max else (
                    np.searchsorted(names, own), len(names))
                if last > first:
                    line, names = np.delete(line, slice(first, last)), np.delete(names, slice(first, last))
                best = _best(line, k)
                out[0].append(np.full(len(best), row))
                out[1].append(names[best])
                out[2].append(line[best])
        return [np.concatenate(c) for c in out]

    def best_of(asked: _Block, blocks: list[_Block]) -> list[np.ndarray]:
        row, names, scores = (np.concatenate(c) for c in zip(*[pair(asked, b) for b in blocks]))
        order = np.lexsort((names, ~scores, row))
        row, names, scores = row[order], names[order], scores[order]
        kept = np.arange(len(row)) - np.searchsorted(row, row) < k
        return [asked.ids[row[kept]], names[kept], scores[kept]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part = batch.column("part").to_numpy()
            for p in np.unique(part):
                blocks = [_Block(batch, int(i)) for i in np.flatnonzero(part == p)]
                for asked in _stored(paths[p::parts]):
                    found = best_of(asked, blocks)
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in found], names=["query_id", "vec_id", "score"])

    return run


def top_k(queries: DataFrame, candidates: DataFrame, k: int, key: str = "vec_id", vector: str = "embedding",
          scale: float = 256.0) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k candidates of highest
    integer inner product, ties to the smaller key; all of them if fewer.

    Rows without a key, and vectors that are null or hold a null or
    non-finite component, take no part. A candidate under the query's own key
    is not a candidate for it. Repeated equal rows count once. Shorter
    vectors count as padded with zeros. Other columns are ignored.
    """
    def rows(df):
        return df.where(usable(key, vector)).select(
            F.col(key).cast("long").alias("id"), whole_weights(vector, scale).alias("w"))

    paths = sorted(blocks_of(rows(queries), QUERY_ROWS)[0].inputFiles())
    blocks, count = blocks_of(rows(candidates), BLOCK_ROWS)
    parts = max(1, min(len(paths), -(-TASKS // count)))
    dealt = blocks.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    tasks = min(count * parts, max(TASKS, -(-count * parts // TASK_BLOCKS)))
    dealt = dealt.repartition(tasks, "block", "part")
    found = dealt.mapInArrow(_accumulate(k, paths, parts), _FOUND)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.select("query_id", "rank", "vec_id", "score")

"""Near-duplicate classes by ProbMinHash, banding and verification.

A text is a weighted set of shingles of five words; a shingle that occurs n
times weighs 1 + ln n. Each shingle is a Poisson process whose rate is its weight:
arrivals fall on random places of the signature, and a place keeps the shingle
that arrives first. A process stops at the first arrival that is later than
all places' current ones. Two signatures agree in a place with the
probability Jaccard similarity of the weighted sets.

Equal texts are one node. Nodes that share a band are candidates: all nodes of a
bucket against its least one first, and, where a bucket still holds several
components, all nodes of different components against each other: pair by pair
in a small bucket, by blocks of nodes in a large one.
Candidates are verified on their whole texts, and the links give the classes,
so every two similar texts that share a band are in one class.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from taleweave.llm.common import settled, slices, whole_text
from taleweave.llm.components import components
from taleweave.llm.kneser_ney import hash_words, mix

#: Words of a shingle, least similarity, bands, and places of a band. A pair at
#: the least similarity shares no band with a chance of (1 - 0.8^5)^26 = 3e-5.
WORDS, SIMILARITY, BANDS, PLACES = 5, 0.8, 26, 5
#: Bytes of text sketched at a time, members of a centre verified together,
#: and, in the second round, nodes of a bucket that are listed pair by pair.
CHUNK_BYTES, TOGETHER, SMALL = 1 << 20, 64, 8
#: Nodes and bytes of text of a block of a larger bucket, about, and shingles
#: of a matrix product. They change no result.
BLOCK_NODES, BLOCK_BYTES, SLICE = 256, 2 << 20, 2048
_U = np.uint64
_ODD = [_U(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63)]


def shingles(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of some texts: text number, hash, weight, in that
    order. A text of one to four words is a single shingle."""
    hashes, counts = hash_words(texts, lower=False)
    starts = np.cumsum(counts) - counts
    made = np.maximum(counts - WORDS + 1, np.minimum(counts, 1))
    row = np.repeat(np.arange(len(counts)), made)
    at = np.arange(made.sum()) - np.repeat(np.cumsum(made) - made, made) + starts[row]
    value = np.zeros(len(at), _U)
    left = (starts + counts)[row] - at
    for i in range(WORDS):
        inside = left > i
        value[inside] += hashes[at[inside] + i] * _ODD[i]
    value = mix(value)
    order = np.lexsort([value, row])
    row, value = row[order], value[order]
    first = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (value[1:] != value[:-1])])) if len(row) else order
    often = np.diff(first, append=len(row))
    return row[first], value[first], 1 + np.log(often)


def signatures(rows: np.ndarray, values: np.ndarray, weights: np.ndarray, texts: int, places: int) -> np.ndarray:
    """ProbMinHash signature of each text; rows of texts without shingles stay 0."""
    arrival = np.full(texts * places, np.inf)
    winner = np.zeros(texts * places, _U)
    time = np.zeros(len(rows))
    active = np.arange(len(rows))
    round_no = 0
    while len(active):
        round_no += 1
        draw = mix(values[active] + _U(round_no * int(_ODD[0]) % 2 ** 64))
        time[active] -= np.log(((draw >> _U(11)).astype(np.float64) + 0.5) * 2.0 ** -53) / weights[active]
        place = (mix(draw + _ODD[1]) % _U(places)).astype(np.int64)
        cell = rows[active] * places + place
        now = time[active]
        np.minimum.at(arrival, cell, now)
        won = now == arrival[cell]
        winner[cell[won]] = values[active[won]]
        latest = arrival.reshape(texts, places).max(axis=1)
        active = active[now < latest[rows[active]]]
    return winner.reshape(texts, places)


def band_keys(found: np.ndarray) -> np.ndarray:
    """One key per band; different bands have different keys."""
    parts = found.reshape(len(found), BANDS, PLACES)
    keys = np.broadcast_to(np.arange(1, BANDS + 1, dtype=_U) * _ODD[4], parts.shape[:2]).copy()
    for i in range(PLACES):
        keys = mix(keys + parts[:, :, i] * _ODD[i])
    return keys


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lengths = pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False)
        for start, stop in slices(lengths.tolist(), CHUNK_BYTES):
            part = batch.slice(start, stop - start)
            rows, values, weights = shingles(part.column("text"))
            keys = band_keys(signatures(rows, values, weights, len(part), BANDS * PLACES)).view(np.int64)
            some = np.isin(np.arange(len(part)), rows)
            offsets = np.concatenate([[0], np.cumsum(np.where(some, BANDS, 0))])
            bands = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(keys[some].ravel()))
            yield pa.RecordBatch.from_arrays([part.column("node"), bands], names=["node", "bands"])


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Probability Jaccard of two weighted sets (ascending hashes, weights):
    sum over common elements of 1 / sum of max(a_e / a_d, b_e / b_d)."""
    common, in_a, in_b = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    if not len(common):
        return 0.0
    x, y = a[1][in_a], b[1][in_b]
    order = np.argsort(y / x, kind="stable")
    x, y = x[order], y[order]
    ratio = y / x
    # elements up to the ratio count by a, later ones by b; those in one text alone always count
    last = np.searchsorted(ratio, ratio, side="right")
    below = np.concatenate([[0], np.cumsum(x)])[last] + (a[1].sum() - x.sum())
    above = y.sum() - np.concatenate([[0], np.cumsum(y)])[last] + (b[1].sum() - y.sum())
    return float((1 / (below / x + above / y)).sum())


def _verify(least: float):
    """Arrow step over rows sorted by group and kind: the text of the centre,
    then the texts to compare with it; keeps the pairs that are similar."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, centre = None, None
        for batch in batches:
            lengths = pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False)
            for start, stop in slices(lengths.tolist(), CHUNK_BYTES):
                part = batch.slice(start, stop - start)
                rows, values, weights = shingles(part.column("text"))
                cuts = np.searchsorted(rows, np.arange(len(part) + 1))
                links = []
                for i, (c, chunk, node) in enumerate(zip(*[part.column(n).to_pylist() for n in ("centre", "chunk", "node")])):
                    own = (values[cuts[i]:cuts[i + 1]], weights[cuts[i]:cuts[i + 1]])
                    if (c, chunk) != group:
                        group, centre = (c, chunk), own  # the centre comes first
                    elif node != c and similarity(centre, own) >= least:
                        links.append((c, node))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([u for u, _ in links], pa.string()), pa.array([v for _, v in links], pa.string())],
                    names=["u", "v"])

    return run


def verified(pairs: DataFrame, texts: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """The candidate pairs (centre, node) whose whole texts are similar, as links (u, v).

    A centre's members are dealt to chunks; its text goes to each of them, so
    a large group is shared by many tasks.
    """
    sized = pairs.groupBy("centre").agg(F.ceil(F.count("*") / F.lit(TOGETHER)).cast("int").alias("chunks"))
    chunk = F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int")
    members = pairs.join(sized, "centre").select("centre", chunk.alias("chunk"), "node", F.lit(1).alias("kind"))
    centres = sized.select(
        "centre", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), F.col("centre").alias("node"),
        F.lit(0).alias("kind"))
    rows = members.unionByName(centres).join(texts, "node")
    rows = rows.repartition("centre", "chunk").sortWithinPartitions("centre", "chunk", "kind")
    return rows.select("centre", "chunk", "node", "text").mapInArrow(_verify(least), "u string, v string")


def most_similar(a: np.ndarray, b: np.ndarray, a_common: np.ndarray, b_common: np.ndarray) -> np.ndarray:
    """Upper bounds of `similarity` of texts a (rows) and b (columns), from their
    whole weights and the weights of their common shingles in a and in b.

    A term 1 / (A / a_e + rest of B / b_e), at most, is concave and grows in
    proportion with (a_e, b_e), so the sum of the terms is at most the term of
    the sums. It is exact where all weights are equal.
    """
    a_all, b_all = a[:, None], b[None, :]
    with np.errstate(divide="ignore", invalid="ignore"):
        one = 1 / (a_all / a_common + (b_all - b_common) / b_common)
        two = 1 / ((a_all - a_common) / a_common + b_all / b_common)
    return np.where((a_common > 0) & (b_common > 0), np.minimum(one, two), 0.0)


class _Block:
    """Nodes that a worker compares: side, component, and weighted shingles."""

    def __init__(self):
        self.nodes, self.sides, self.names, self.values, self.weights = [], [], [], [], []

    def add(self, part: pa.RecordBatch) -> None:
        rows, values, weights = shingles(part.column("text"))
        cuts = np.searchsorted(rows, np.arange(len(part) + 1))
        for i in range(len(part)):
            self.values.append(values[cuts[i]:cuts[i + 1]].copy())
            self.weights.append(weights[cuts[i]:cuts[i + 1]].copy())
        self.nodes += part.column("node").to_pylist()
        self.sides += part.column("side").to_pylist()
        self.names += part.column("component").to_pylist()

    def bounds(self, ids, some: np.ndarray, others: np.ndarray, wide: int, totals: np.ndarray) -> np.ndarray:
        """Upper bounds of the similarities of two runs of nodes."""
        a_common, b_common = np.zeros((2, len(some), len(others)))
        for first in range(0, wide, SLICE):
            def dense(run):
                out = np.zeros((len(run), min(SLICE, wide - first)))
                for at, i in enumerate(run):
                    lo, hi = np.searchsorted(ids[i][0], [first, first + SLICE])
                    out[at, ids[i][0][lo:hi] - first] = ids[i][1][lo:hi]
                return out
            a, b = dense(some), dense(others)
            a_common += a @ (b > 0).T
            b_common += (a > 0).astype(float) @ b.T
        return most_similar(totals[some], totals[others], a_common, b_common)

    def links(self, least: float) -> list[tuple[str, str]]:
        """Similar pairs that join all components which similar pairs join: of
        one side where there is one, else of different sides."""
        parent = {name: name for name in self.names}

        def root(name):
            while parent[name] != name:
                parent[name] = name = parent[parent[name]]
            return name

        if len(parent) < 2:
            return []
        # shingles of several nodes get numbers; the others count in the totals alone
        every, often = np.unique(np.concatenate(self.values), return_counts=True)
        shared = every[often > 1]
        ids = []
        for values, weights in zip(self.values, self.weights):
            at = np.searchsorted(shared, values)
            known = np.isin(values, shared, assume_unique=True)
            ids.append((at[known], weights[known]))
        totals = np.array([w.sum() for w in self.weights])
        sides = np.array(self.sides)
        one = sides.min() == sides.max()
        left = np.arange(len(sides)) if one else np.flatnonzero(sides == sides.min())
        right = left if one else np.flatnonzero(sides == sides.max())
        found = []
        for i in range(0, len(left), BLOCK_NODES):
            for j in range(i if one else 0, len(right), BLOCK_NODES):
                some, others = left[i:i + BLOCK_NODES], right[j:j + BLOCK_NODES]
                near = self.bounds(ids, some, others, len(shared), totals) >= least - 1e-9
                for x, y in zip(*(side.tolist() for side in np.nonzero(near))):
                    u, v = int(some[x]), int(others[y])
                    a, b = root(self.names[u]), root(self.names[v])
                    if a != b and similarity((self.values[u], self.weights[u]), (self.values[v], self.weights[v])) >= least:
                        parent[a] = b
                        found.append((self.nodes[u], self.nodes[v]))
        return found


def _compare(least: float):
    """Arrow step over rows sorted by (bucket, i, j): compares the nodes of
    blocks i and j of a bucket, and keeps links between components."""
    def out(block):
        links = block.links(least)
        return pa.RecordBatch.from_arrays(
            [pa.array([u for u, _ in links], pa.string()), pa.array([v for _, v in links], pa.string())], names=["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, block = None, None
        for batch in batches:
            keys = list(zip(*[batch.column(n).to_pylist() for n in ("bucket", "i", "j")]))
            lengths = pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False).tolist()
            edges = [0, *[k for k in range(1, len(keys)) if keys[k] != keys[k - 1]], len(keys)]
            for first, last in zip(edges, edges[1:]):
                if first == last:
                    continue
                if keys[first] != group:
                    if block is not None:
                        yield out(block)
                    group, block = keys[first], _Block()
                for start, stop in slices(lengths[first:last], CHUNK_BYTES):
                    block.add(batch.slice(first + start, stop - start))
        if block is not None:
            yield out(block)

    return run


def block_links(dealt: DataFrame, texts: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """Links (u, v) that join all components of a bucket which similar texts
    join, from rows (bucket, node, component, blocks).

    A bucket's nodes are dealt to blocks, and every two blocks meet in one
    task: a bucket of n nodes makes n rows for each of its blocks, not for
    each of its nodes.
    """
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    met = dealt.withColumn("own", own).select(
        "bucket", "node", "component", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    met = met.select("bucket", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "node",
                     "component", F.col("own").alias("side"))
    rows = met.join(texts, "node").repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
    return rows.select("bucket", "i", "j", "node", "component", "side", "text").mapInArrow(
        _compare(least), "u string, v string")


def link_classes(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """(node, component) of the distinct texts that have a similar one, from rows (node, text)."""
    sketched = settled(docs.mapInArrow(_sketch, "node string, bands array<long>").dropDuplicates(["node"]), "sketch")
    banded = sketched.select("node", F.explode("bands").alias("bucket"))
    centres = banded.groupBy("bucket").agg(F.min("node").alias("centre"), F.count("*").alias("size")).where("size > 1")
    rows = settled(banded.join(centres, "bucket"), "buckets")
    pairs = settled(rows.where("node <> centre").select("centre", "node").distinct(), "pairs")
    named = pairs.select("node").unionByName(pairs.select(F.col("centre").alias("node"))).distinct()
    texts = settled(docs.join(named, "node", "left_semi").dropDuplicates(["node"]), "texts")
    links = settled(verified(pairs, texts, least), "links")
    linked = settled(components(links), "linked")

    # second round: buckets that still hold several components
    sizes = texts.select("node", F.octet_length("text").cast("long").alias("bytes"))
    placed = rows.join(linked, "node", "left").join(sizes, "node").withColumn("component", F.coalesce("component", "node"))
    blocks = F.ceil(F.greatest(F.count("*") / F.lit(BLOCK_NODES), F.sum("bytes") / F.lit(BLOCK_BYTES))).cast("int")
    mixed = placed.groupBy("bucket").agg(
        F.min("component").alias("a"), F.max("component").alias("b"), F.count("*").alias("n"),
        blocks.alias("blocks")).where("a <> b")
    dealt = placed.join(mixed.select("bucket", "n", "blocks"), "bucket")
    held = F.struct("node", "component")
    # small buckets: every pair of nodes of different components
    lists = dealt.where(F.col("n") <= SMALL).groupBy("bucket").agg(F.collect_list(held).alias("l"))
    every = lists.select(F.explode(F.flatten(F.transform("l", lambda a: F.transform(
        F.filter("l", lambda b: (a["node"] < b["node"]) & (a["component"] != b["component"])),
        lambda b: F.struct(a["node"].alias("a"), b["node"].alias("b")))))).alias("p")).select("p.*")
    apart = every.select(F.col("a").alias("centre"), F.col("b").alias("node")).distinct()
    more = apart.join(pairs, ["centre", "node"], "left_anti")
    links = links.unionByName(settled(verified(more, texts, least), "more-links"))
    # large ones: every two blocks of nodes
    large = dealt.where(F.col("n") > SMALL).select("bucket", "node", "component", "blocks")
    links = links.unionByName(settled(block_links(large, texts, least), "block-links"))
    return components(links)


def near_duplicates(docs: DataFrame, least: float = SIMILARITY, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, node, class_id, stays) for every row: `class_id` is the least id
    of the row's class, and one row of every class stays.

    A class is a set of texts connected by similarities of at least `least`.
    Equal texts are of one class; null and empty texts are equal to each
    other, and texts of white space alone only to their equals. A null id
    comes after all others. Of rows that repeat id and text one stays at most.
    Other columns are ignored. An empty table gives an empty result.
    """
    body = whole_text(text)
    rows = docs.select(F.col(key).alias("doc_id"), F.md5(body).alias("node"), body.alias("text"))
    linked = link_classes(rows.select("node", "text"), least)
    narrow = rows.select("doc_id", "node").join(linked, "node", "left")
    narrow = narrow.withColumn("component", F.coalesce("component", "node"))
    first = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "node")
    heads = narrow.groupBy("component").agg(F.min(first).alias("head"))
    placed = narrow.join(heads, "component")
    stays = F.col("doc_id").eqNullSafe(F.col("head.doc_id")) & (F.col("node") == F.col("head.node"))
    # only rows that repeat the head's id and text share a window of any size
    repeat = F.row_number().over(Window.partitionBy("node", "doc_id").orderBy("component")) == 1
    return placed.select("doc_id", "node", F.col("head.doc_id").alias("class_id"), (stays & repeat).alias("stays"))

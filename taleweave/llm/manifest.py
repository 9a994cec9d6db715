"""Merkle manifest of a table as a persistent path-copying tree.

Rows become leaves; per group they are numbered in order, and runs of WIDTH
digests become their parent until one is left, the group's subroot. Subroots
are the leaves of one more tree, up to the root.

The tree is cut into aligned blocks of WIDTH**depth nodes. A block is one row
and one task's work: its inner nodes are built once, and each tampered leaf is
a version that copies its ancestors and shares all other nodes. Roots of blocks
are the leaves of the next blocks up, until each group has one node. On the way
down every block gets its steps, the untouched siblings between it and the
root, so that versions and proofs of its leaves continue without the blocks
above. A block's steps are a few digests for each level; nothing else is sent
to leaves.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from taleweave.llm.common import settled, whole_text

#: Children of a node, and levels of a block: 4,096 nodes.
WIDTH, DEPTH = 8, 4
_STEP = "array<struct<before:string, after:string>>"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def leaf_digest(*values: Column) -> Column:
    """SHA-256 of the values: `-` for null, else byte count, `:`, text."""
    parts = [F.coalesce(F.concat(F.octet_length(v.cast("string")).cast("string"), F.lit(":"), v.cast("string")), F.lit("-"))
             for v in values]
    return F.sha2(F.concat(*parts), 256)


def parent(children: Sequence[str]) -> str:
    return hashlib.sha256("".join(children).encode()).hexdigest()


class Version:
    """A tree after one change: its own copies of the ancestors, all other
    nodes those of the base."""

    __slots__ = ("base", "at", "copies")

    def __init__(self, base: PathTree, at: int, copies: list[str]):
        self.base, self.at, self.copies = base, at, copies

    @property
    def root(self) -> str:
        return self.copies[-1]

    def node(self, level: int, i: int) -> str:
        return self.copies[level] if i == self.at // WIDTH ** level else self.base.levels[level][i]


class PathTree:
    """Inner nodes of a block. A tree of fixed depth has that many levels above
    its leaves, even over a single node; else it ends at one node."""

    def __init__(self, leaves: list[str], depth: int | None = None):
        self.levels = [leaves]
        while len(self.levels) - 1 < depth if depth is not None else len(self.levels[-1]) > 1:
            last = self.levels[-1]
            self.levels.append([parent(last[i:i + WIDTH]) for i in range(0, len(last), WIDTH)])

    @property
    def root(self) -> str:
        return self.levels[-1][0]

    def siblings(self, at: int) -> list[tuple[str, str]]:
        """For each level, the digests before and after the node above a leaf."""
        steps = []
        for nodes in self.levels[:-1]:
            first = at - at % WIDTH
            steps.append(("".join(nodes[first:at]), "".join(nodes[at + 1:first + WIDTH])))
            at //= WIDTH
        return steps

    def changed(self, at: int, digest: str) -> Version:
        """The version whose leaf `at` has another digest."""
        copies, i = [digest], at
        for nodes in self.levels[:-1]:
            first = i - i % WIDTH
            copies.append(parent(nodes[first:i] + [copies[-1]] + nodes[i + 1:first + WIDTH]))
            i //= WIDTH
        return Version(self, at, copies)


def fold(digest: str, steps: Sequence[tuple[str, str]]) -> str:
    for before, after in steps:
        digest = hashlib.sha256(f"{before}{digest}{after}".encode()).hexdigest()
    return digest


def numbered(df: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """Rows with `n`, their number in each group's order, and `size`, the rows
    of the group. Rows equal in group and order must be alike.

    Rows are sorted in ranges of (group, order), so a large group, or a large
    set of equal rows, is spread; ranges and groups only have counts joined.
    """
    keys = [group, *order]
    # equal rows are dealt by their place in the written table
    rows = settled(df, "unsorted").withColumn("_tie", F.monotonically_increasing_id())
    rows = rows.repartitionByRange(*keys, "_tie").sortWithinPartitions(*keys, "_tie").drop("_tie")
    rows = settled(rows.withColumn("_part", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id()), "sorted")
    before = Window.partitionBy("_g").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    parts = rows.groupBy(F.col(group).alias("_g"), F.col("_part").alias("_p")).agg(
        F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    parts = parts.withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0))).withColumn(
        "size", F.sum("_rows").over(Window.partitionBy("_g")))
    parts = settled(parts.drop("_rows"), "parts")
    joined = rows.join(parts, (F.col("_part") == F.col("_p")) & F.col(group).eqNullSafe(F.col("_g")))
    return joined.withColumn("n", F.expr("_at - _first + _before")).drop("_part", "_at", "_g", "_p", "_first", "_before")


def _blocks(nodes: DataFrame, values: Sequence[str], depth: int) -> DataFrame:
    """(grp, block, single, items): up to WIDTH**depth nodes in order; `single`
    if the group is this one block, which then ends at its own root."""
    size = WIDTH ** depth
    return nodes.groupBy("grp", F.expr(f"n div {size}").alias("block"), F.expr(f"size <= {size}").alias("single")).agg(
        F.array_sort(F.collect_list(F.struct("n", *values))).alias("items"))


def _tree(row: dict, depth: int) -> PathTree:
    return PathTree([i["digest"] for i in row["items"]], None if row["single"] else depth)


def _roots(depth: int):
    """Arrow step: the root of every block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.select(["single", "items"])
            roots = [_tree(rows.slice(i, 1).to_pylist()[0], depth).root for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("grp"), batch.column("block"), batch.column("single"), pa.array(roots, pa.string())],
                names=["grp", "block", "single", "digest"])

    return run


def _child_steps(depth: int):
    """Arrow step: the steps of every node of a block: its own, then the block's."""
    kind = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                tree, n = _tree(row, depth), len(row["items"])
                steps = [[{"before": a, "after": b} for a, b in tree.siblings(j)] + row["steps"] for j in range(n)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("grp").take(pa.array([i] * n, pa.int64())),
                     pa.array([r["n"] for r in row["items"]], pa.int64()), pa.array(steps, kind)],
                    names=["grp", "block", "steps"])

    return run


def _leaf_rows(depth: int):
    """Arrow step: proof and folded root of every leaf of a block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).select(["single", "items", "steps"]).to_pylist()[0]
                tree, above = _tree(row, depth), [(s["before"], s["after"]) for s in row["steps"]]
                upper, whole = "".join(a + b for a, b in above), fold(tree.root, above)
                proofs, folded = [], []
                for at, item in enumerate(row["items"]):
                    own = "".join(a + b for a, b in tree.siblings(at))
                    proofs.append(hashlib.sha256((own + upper).encode()).hexdigest())
                    version = tree.changed(at, item["tampered"] or item["digest"])
                    folded.append(fold(version.root, above))
                given, n = batch.column("items")[i].values, len(proofs)
                yield pa.RecordBatch.from_arrays(
                    [given.field("key"), given.field("digest"), given.field("grp"), pa.array([whole] * n, pa.string()),
                     pa.array(proofs, pa.string()), pa.array(folded, pa.string())],
                    names=["key", "leaf", "grp", "root", "proof_sha256", "folded_root"])

    return run


def _climb(leaves: DataFrame, depth: int) -> tuple[list[DataFrame], DataFrame]:
    """Blocks of each storey, lowest first, and the top (grp, digest) of every
    group. `leaves`: settled blocks of the lowest storey."""
    storeys, blocks = [leaves], leaves
    kind = leaves.schema["grp"].dataType.simpleString()
    tops = []
    while True:
        roots = settled(blocks.select("grp", "block", "single", "items").mapInArrow(
            _roots(depth), f"grp {kind}, block long, single boolean, digest string"), "roots")
        tops.append(roots.where("single").select("grp", "digest"))
        more = roots.where("not single")
        if more.isEmpty():
            top = tops[0]
            for t in tops[1:]:
                top = top.unionByName(t)
            return storeys, top
        # block numbers have no gaps, so they are the numbers of the next storey
        size = more.groupBy(F.col("grp").alias("_g")).agg(F.count(F.lit(1)).alias("size"))
        nodes = more.join(size, F.col("grp").eqNullSafe(F.col("_g"))).withColumn("n", F.col("block"))
        blocks = settled(_blocks(nodes, ["digest"], depth), "blocks")
        storeys.append(blocks)


def _with_steps(storeys: list[DataFrame], top: DataFrame, depth: int) -> DataFrame:
    """Blocks of the lowest storey with their steps; `top`: (grp, steps) above
    each group's top."""
    kind = top.schema["grp"].dataType.simpleString()
    lower = None
    for blocks in reversed(storeys):
        named = top.select(F.col("grp").alias("_g"), F.col("steps").alias("_top"))
        # a group's only block takes what is above the group
        single = blocks.where("single").join(named, F.col("grp").eqNullSafe(F.col("_g"))).withColumnRenamed("_top", "steps").drop("_g")
        if lower is None:
            stepped = single
        else:
            up = lower.select(F.col("grp").alias("_g"), F.col("block").alias("_b"), "steps")
            inner = blocks.where("not single").join(up, F.col("grp").eqNullSafe(F.col("_g")) & (F.col("block") == F.col("_b")))
            stepped = inner.drop("_g", "_b").unionByName(single)
        if blocks is storeys[0]:
            return stepped
        lower = settled(stepped.mapInArrow(_child_steps(depth), f"grp {kind}, block long, steps {_STEP}"), "steps")
    raise AssertionError("a tree has at least one storey")


def manifest(rows: DataFrame, key: str = "doc_id", group: str = "lang", depth: int = DEPTH) -> DataFrame:
    """(key, leaf, subroot, root, proof_sha256, folded_root, verified) of rows
    that have `digest`, and `tampered`: the digest after a change, or null.

    Leaves of a group ascend by key, null first, equal keys by digest; groups
    ascend, null first. `proof_sha256` hashes all siblings from leaf to root;
    `folded_root` is the root of the version in which only this row is
    tampered. Repeated rows are leaves of their own. An empty table has no
    rows. Only the named columns are read, so others cannot clash.
    """
    given = rows.select(F.col(key).alias("key"), F.col(group).alias("grp"), "digest", "tampered")
    key_kind, kind = given.schema["key"].dataType.simpleString(), given.schema["grp"].dataType.simpleString()
    leaves = numbered(given, "grp", ["key", "digest"])
    storeys, tops = _climb(settled(_blocks(leaves, ["digest", "key", "tampered", "grp"], depth), "leaves"), depth)
    # the groups' tops are the leaves of one more tree
    tops = settled(tops, "tops")
    ordered = numbered(tops.select(F.lit(0).alias("grp"), F.col("grp").alias("name"), "digest"), "grp", ["name"])
    upper, _ = _climb(settled(_blocks(ordered, ["digest"], depth), "tops"), depth)
    stepped = _with_steps(upper, upper[0].sparkSession.range(1).select(
        F.lit(0).alias("grp"), F.array().cast(_STEP).alias("steps")), depth)
    steps = stepped.mapInArrow(_child_steps(depth), f"grp int, block long, steps {_STEP}")
    named = ordered.select("n", "name").join(steps, F.col("n") == F.col("block")).select(
        F.col("name").alias("grp"), "steps")
    found = _with_steps(storeys, settled(named, "group-steps"), depth).select("single", "items", "steps").mapInArrow(
        _leaf_rows(depth), f"key {key_kind}, leaf string, grp {kind}, root string, proof_sha256 string, folded_root string")
    subroots = tops.select(F.col("grp").alias("_g"), F.col("digest").alias("subroot"))
    return found.join(subroots, F.col("grp").eqNullSafe(F.col("_g"))).select(
        F.col("key").alias(key), "leaf", "subroot", "root", "proof_sha256", "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"))


def document_leaves(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, digest, tampered) of documents. Where 3 divides the
    CRC-32 of the id, tampering puts A-Z of the text in lower case; null texts
    and rows without an id stay as they are."""
    def leaf(text):
        return leaf_digest(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text)

    hit = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    lower = F.translate("text", _UPPER, _LOWER)
    changed = hit & (whole_text() != F.coalesce(lower, F.lit("")))
    return docs.select("doc_id", "lang", leaf(F.col("text")).alias("digest"), F.when(changed, leaf(lower)).alias("tampered"))

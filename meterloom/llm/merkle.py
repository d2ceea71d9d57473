"""A Merkle manifest of a table, with a proof for every row, by incremental witnesses.

A row is a leaf, a source a tree. Leaves are appended in order to aligned blocks of WIDTH^DEPTH leaves. `Append` keeps
the open run of each level: a node that comes in waits there with what is known of its witness, and when its run is
complete (or closed by the end), every node of the run gets its siblings and hands what follows to the new parent. So a
leaf's witness grows with each subtree that is completed above it, and is never rebuilt.

A block is appended by one task; blocks' roots are appended in the same way, as the leaves of blocks of their own, and
so on until each tree has one root. The trees' roots are one more tree. On the way back each block's own witness stands
in front of its members (one row, not one per member) and is handed on to them.

H is the lowercase hex SHA-256 of its inputs, one after the other, digests as hex text. A leaf is H of the fields, each
`-` if null, else its UTF-8 byte count, `:` and its value. In a tree leaves ascend by key (null first), equal keys by
leaf; while several nodes remain, every WIDTH consecutive ones, the last run with fewer, become their H. Trees are
ordered by source, null first, bytewise.

Texts are read and hashed once, in the scan; what is dealt are digests. Places are counted by ranges of (source, key), so
a source with a third of all rows is spread; no task holds more than one block. Very long texts are hashed like others. A
null text, source, key or count is the field `-`; rows that repeat are leaves of their own, next to each other; an empty
table has no rows. Only the named columns are read, so others may have any name."""

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from meterloom.llm.grouped import groups
from meterloom.session import settle

WIDTH = 16
DEPTH = 2
BLOCK = WIDTH ** DEPTH
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(data: bytes) -> bytes:
    return hashlib.sha256(data).hexdigest().encode()


def leaf(*fields: Column) -> Column:
    """H of a row's fields, as 32 bytes."""
    told = [F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-")) for s in (f.cast("string") for f in fields)]
    return F.unhex(F.sha2(F.concat(*told).cast("binary"), 256))


class Node:
    """`before` and `after` are the digests of its siblings; with its parent's, and so on, they are its witness."""
    __slots__ = ("digest", "before", "after", "parent")

    def __init__(self, digest: bytes):
        self.digest, self.before, self.after, self.parent = digest, b"", b"", None

    def witness(self) -> list[tuple[bytes, bytes]]:
        steps, node = [], self
        while node.parent is not None:
            steps.append((node.before, node.after))
            node = node.parent
        return steps


class Append:
    """A tree of at most BLOCK leaves that come one by one."""

    def __init__(self):
        self.open: list[list[Node]] = [[] for _ in range(DEPTH + 1)]

    def add(self, digest: bytes) -> Node:
        node = Node(digest)
        self._put(node, 0)
        return node

    def _put(self, node: Node, level: int) -> None:
        self.open[level].append(node)
        if level < DEPTH and len(self.open[level]) == WIDTH:
            self._complete(level)

    def _complete(self, level: int) -> None:
        run, self.open[level] = self.open[level], []
        parent = Node(digest(b"".join(n.digest for n in run)))
        for i, node in enumerate(run):
            node.before, node.after, node.parent = b"".join(n.digest for n in run[:i]), b"".join(n.digest for n in run[i + 1:]), parent
        self._put(parent, level + 1)

    def close(self, height: int) -> Node:
        """Completes what is open below `height` and returns the root."""
        for level in range(height):
            if self.open[level]:
                self._complete(level)
        return self.open[height][0]


def height(size: int) -> int:
    """Levels a block of a tree of so many leaves has: all of DEPTH, unless the tree ends inside the block."""
    levels = 0
    while size > 1 and levels < DEPTH:
        size, levels = -(-size // WIDTH), levels + 1
    return levels


def fold(digest_: bytes, steps: list[tuple[bytes, bytes]]) -> bytes:
    """The root that a node and a witness lead to."""
    for before, after in steps:
        digest_ = digest(before + digest_ + after)
    return digest_


def placed(rows: DataFrame, *order: Column) -> DataFrame:
    """Adds pos, a row's place in its tree, and size, the tree's rows. Rows are dealt out by range and written; a range
    counts its own, and its start in each tree comes from the ranges' counts."""
    dealt = settle(rows.repartitionByRange(F.col("tree"), *order).withColumn("_range", F.spark_partition_id()), "leaf-ranges")
    tree = W.partitionBy("tree")
    starts = dealt.groupBy("tree", "_range").agg(F.count(F.lit(1)).alias("_n")).select(
        "tree", "_range", F.coalesce(F.sum("_n").over(tree.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_start"),
        F.sum("_n").over(tree).alias("size"))
    own = F.row_number().over(W.partitionBy("tree", "_range").orderBy(*order)) - 1
    return (dealt.withColumn("_own", own).join(starts, ["tree", "_range"])
            .withColumn("pos", (F.col("_start") + F.col("_own")).cast("long")).drop("_start", "_own", "_range"))


def _blocks(rows: DataFrame) -> DataFrame:
    """Each block's rows together and in order, seeds first."""
    return rows.repartition("tree", "block").sortWithinPartitions("tree", "block", "pos")


def _roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in groups(batches, "tree", "block"):
        size, block = rows.column("size")[0].as_py(), Append()
        for value in rows.column("digest").to_pylist():
            block.add(value.hex().encode())
        root = block.close(height(size))
        yield pa.RecordBatch.from_arrays([
            rows.column("tree").slice(0, 1), rows.column("block").slice(0, 1), pa.array([-(-size // BLOCK)], pa.int64()),
            pa.array([bytes.fromhex(root.digest.decode())], pa.binary())], ["tree", "pos", "size", "digest"])


def rise(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """nodes: (tree, pos, size, digest). Returns the levels, each the roots of the blocks of the one before, and
    (tree, digest), the root of every tree."""
    levels, tops = [nodes], None
    while True:
        members = levels[-1].select("tree", F.floor(F.col("pos") / BLOCK).alias("block"), "pos", "size", "digest")
        roots = settle(_blocks(members).mapInArrow(_roots, "tree string, pos long, size long, digest binary"), "block-roots")
        done = roots.where("size = 1").select("tree", "digest")
        tops = done if tops is None else tops.unionByName(done)
        more = roots.where("size > 1")
        if more.isEmpty():
            return levels, tops
        levels.append(more)


def _told(rows: pa.RecordBatch) -> tuple[list[str], str | None, list[Node], int]:
    """A block as it comes: the witness of the block itself and its subroot (its first row), then its members."""
    block = Append()
    nodes = [block.add(value.hex().encode()) for value in rows.column("digest").slice(1).to_pylist()]
    block.close(height(rows.column("size")[1].as_py()))
    return rows.column("steps")[0].as_py(), rows.column("subroot")[0].as_py(), nodes, rows.num_rows


def _witnesses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in groups(batches, "tree", "block"):
        above, subroot, nodes, n = _told(rows)
        steps = [[x.decode() for step in node.witness() for x in step] + above for node in nodes]
        yield pa.RecordBatch.from_arrays([rows.column("tree").slice(1), rows.column("pos").slice(1), pa.array(steps, pa.list_(pa.string())),
                                          pa.array([subroot] * (n - 1), pa.string())], ["tree", "pos", "steps", "subroot"])


def _pairs(steps: list[str]) -> list[tuple[bytes, bytes]]:
    flat = [s.encode() for s in steps]
    return list(zip(flat[::2], flat[1::2]))


def descend(levels: list[DataFrame], above: DataFrame, run, schema: str) -> DataFrame:
    """Hands witnesses down. above: (tree, steps, subroot), the witness of each tree's root. At the lowest level `run`
    makes the rows of `schema` from each block."""
    below = None
    for i in reversed(range(len(levels))):
        members = levels[i].withColumn("block", F.floor(F.col("pos") / BLOCK))
        ends_here = levels[i].where((F.col("pos") == 0) & (F.col("size") <= BLOCK)).select("tree")
        seeds = above.join(ends_here, "tree").withColumn("block", F.lit(0).cast("long"))
        if below is not None:
            seeds = seeds.unionByName(below.withColumnRenamed("pos", "block"))
        both = members.unionByName(seeds.withColumn("pos", F.lit(-1).cast("long")), allowMissingColumns=True)
        if i == 0:
            return _blocks(both).mapInArrow(run, schema)
        below = settle(_blocks(both).mapInArrow(_witnesses, "tree string, pos long, steps array<string>, subroot string"), "witnesses")


def _grown(leaves: DataFrame) -> tuple[list[DataFrame], DataFrame, str]:
    """leaves: (tree, key, digest, …). Returns the levels of all trees, (tree, steps, subroot) and the root."""
    nodes = settle(placed(leaves, F.col("key").asc_nulls_first(), F.col("digest")), "leaves")
    levels, tops = rise(nodes)
    trees = settle(tops.select(F.lit("").alias("tree"), F.col("tree").alias("key"), "digest"), "subroots")
    upper = settle(placed(trees, F.col("key"), F.col("digest")), "subroots-in-order")
    above, top = rise(upper)
    root = top.first()
    start = top.select("tree", F.array().cast("array<string>").alias("steps"), F.lit(None).cast("string").alias("subroot"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in groups(batches, "tree", "block"):
            steps, _, nodes_, _ = _told(rows)
            own = [[x.decode() for step in node.witness() for x in step] + steps for node in nodes_]
            yield pa.RecordBatch.from_arrays([rows.column("key").slice(1), pa.array(own, pa.list_(pa.string())),
                                              pa.array([node.digest.decode() for node in nodes_], pa.string())], ["tree", "steps", "subroot"])

    handed = settle(descend(above, start, run, "tree string, steps array<string>, subroot string"), "subroot-witnesses")
    return levels, handed, root["digest"].hex() if root else ""


def _leaves(documents: DataFrame, fields: tuple[str, ...], source: str, key: str, *more: Column) -> DataFrame:
    tree = F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit(""))
    return settle(documents.select(tree.alias("tree"), F.col(key).alias("key"), leaf(*[F.col(f) for f in fields]).alias("digest"), *more), "hashed")


def manifest(documents: DataFrame, fields: tuple[str, ...] = FIELDS, source: str = "source", key: str = "doc_id") -> DataFrame:
    """One row per document: key, leaf, subroot, root and its witness, `steps`: the siblings before and after its path,
    level by level, as hex text. What a reader needs to prove one document against the root."""
    levels, above, root = _grown(_leaves(documents, fields, source, key))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in groups(batches, "tree", "block"):
            steps, subroot, nodes, n = _told(rows)
            own = [[x.decode() for step in node.witness() for x in step] + steps for node in nodes]
            yield pa.RecordBatch.from_arrays([
                rows.column("key").slice(1), pa.array([node.digest.decode() for node in nodes], pa.string()),
                pa.array([subroot] * (n - 1), pa.string()), pa.array([root] * (n - 1), pa.string()), pa.array(own, pa.list_(pa.string()))],
                ["key", "leaf", "subroot", "root", "steps"])

    kind = documents.schema[key].dataType.simpleString()
    return descend(levels, above, run, f"key {kind}, leaf string, subroot string, root string, steps array<string>").withColumnRenamed("key", key)


def audit(documents: DataFrame, told: dict[str, Column], fields: tuple[str, ...] = FIELDS, source: str = "source", key: str = "doc_id") -> DataFrame:
    """Proves rows as a reader got them, `told` (field to what was read, of the same row), against the manifest of
    `documents`: key, leaf, subroot, root and proof_sha256 (H of the witness) of the manifest, folded_root, the root that
    the row as read and its witness lead to, and whether that is the root."""
    read = leaf(*[told.get(f, F.col(f)) for f in fields]).alias("read")
    levels, above, root = _grown(_leaves(documents, fields, source, key, read))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in groups(batches, "tree", "block"):
            steps, subroot, nodes, n = _told(rows)
            up = _pairs(steps)
            tail = b"".join(x for step in up for x in step)
            proofs, folded = [], []
            for node, value in zip(nodes, rows.column("read").slice(1).to_pylist()):
                own = node.witness()
                proofs.append(digest(b"".join(x for step in own for x in step) + tail).decode())
                folded.append(fold(value.hex().encode(), own + up).decode())
            yield pa.RecordBatch.from_arrays([
                rows.column("key").slice(1), pa.array([node.digest.decode() for node in nodes], pa.string()),
                pa.array([subroot] * (n - 1), pa.string()), pa.array([root] * (n - 1), pa.string()), pa.array(proofs, pa.string()),
                pa.array(folded, pa.string()), pa.array([f == root for f in folded], pa.bool_())],
                ["key", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])

    kind = documents.schema[key].dataType.simpleString()
    return descend(levels, above, run, f"key {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, "
                   "verified boolean").withColumnRenamed("key", key)

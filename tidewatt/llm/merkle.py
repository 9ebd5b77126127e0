"""Merkle manifest of a dataset: a persistent tree per source, and one over the sources.

Leaves of a source ascend by document; every FAN consecutive nodes have their digest as parent, until one is left. A
tree is worked on in aligned blocks of FAN ** LEVELS nodes, each one row that a task folds by itself; the tops of the
blocks are the nodes of the next round, so the rounds are few and no task sees a whole tree. Going back down, every
block gets its path: the siblings of its top on every level up to the root.

The tree is persistent. A leaf that has been tampered with begins a version: inside its block only its ancestors are copied,
all other nodes are shared, and above the block the version goes on along the block's path, where its row is. So each of
many versions costs one digest a level and moves no row to a common top.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatt.llm.packing import before
from tidewatt.llm.shared import prepare, small, stored

FAN = 16
LEVELS = 2
BLOCK = FAN ** LEVELS
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]

# Rows of a path table by their size in longs: a level is at most 15 digests of 64 characters.
_PATH_SIZE = "2 + 60 * size(path)"


def leaf_digest(fields: list[Column]) -> Column:
    """SHA-256 of the fields, each as its UTF-8 byte count, a colon and its text, or - where it is null."""
    texts = [c.cast("string") for c in fields]
    parts = [F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-")) for c in texts]
    return F.unhex(F.sha2(F.concat(*parts), 256))


def leaves(docs: DataFrame, found: Column) -> DataFrame:
    """(tree, doc_id, leaf, other): other is the leaf of the text as found, where it differs."""
    names = {"source": F.col("source").cast("string")}
    tree = F.coalesce(F.concat(F.lit("="), names["source"]), F.lit("-"))  # the null source first, bytewise
    rows = docs.select(*FIELDS, found.alias("found"))
    own, other = ([F.col(c) for c in FIELDS[:-1]] + [F.col(c)] for c in ("text", "found"))
    return rows.select(tree.alias("tree"), "doc_id", leaf_digest(own).alias("leaf"),
                       F.when(~F.col("text").eqNullSafe(F.col("found")), leaf_digest(other)).alias("other"))


def placed(rows: DataFrame, *order: str) -> DataFrame:
    """rows with pos, the place in their tree by order, and n, the nodes of the tree; stored before they are counted.

    Rows are range-partitioned by tree and order, so a large tree spreads over many tasks. What lies before a
    partition comes from one count per tree and partition.
    """
    ranged = rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    rows = stored(ranged.withColumn("id", F.monotonically_increasing_id()), "placed").withColumn("part", F.shiftright("id", 33))
    parts = rows.groupBy("tree", "part").agg(F.min("id").alias("first"), F.count("*").alias("own"))
    ahead = before("own", Window.partitionBy("tree").orderBy("part"))
    parts = stored(parts.select("tree", "part", (ahead - F.col("first")).alias("shift"),
                                F.sum("own").over(Window.partitionBy("tree")).alias("n")), "parts")
    return rows.join(small(parts, "5"), ["tree", "part"]).withColumn("pos", F.col("id") + F.col("shift")).drop("id", "part", "shift")


def in_blocks(nodes: DataFrame, *carried: str) -> DataFrame:
    """(tree, block, n, nodes): aligned blocks of at most BLOCK nodes in order; stored."""
    rows = nodes.groupBy("tree", F.expr(f"pos div {BLOCK}").alias("block")).agg(
        F.max("n").alias("n"), F.sort_array(F.collect_list(F.struct("pos", "digest", *carried))).alias("nodes"))
    return stored(rows, "blocks")


def digest(parts: list[bytes]) -> bytes:
    return sha256(b"".join(parts)).hexdigest().encode()


def levels(nodes: list[bytes], n: int) -> tuple[list[list[bytes]], int]:
    """(levels of a block from its nodes to its top, nodes of the tree on the top's level); digests as hex text."""
    out = [nodes]
    while n > 1 and len(out) <= LEVELS:
        last, n = out[-1], -(-n // FAN)
        out.append([digest(last[i:i + FAN]) for i in range(0, len(last), FAN)])
    return out, n


def siblings(row: list[bytes], i: int) -> tuple[bytes, bytes]:
    """The run's nodes before and after node i."""
    a = i - i % FAN
    return b"".join(row[a:i]), b"".join(row[i + 1:a + FAN])


def _hex(column: pa.Array) -> list[bytes]:
    return [x.hex().encode() for x in column.to_pylist()]


def _nodes(batch: pa.RecordBatch):
    """(tree, block, n, nodes of the block as a struct array) of every row."""
    tree, block, n = (batch.column(c).to_pylist() for c in ("tree", "block", "n"))
    for i, own in enumerate(batch.column("nodes")):
        yield tree[i], block[i], n[i], own.values


def _tops(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for tree, block, n, own in _nodes(batch):
            found, n = levels(_hex(own.field("digest")), n)
            rows.append((tree, block, n, bytes.fromhex(found[-1][0].decode())))
        if rows:
            tree, pos, n, top = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(tree), pa.array(pos, pa.int64()), pa.array(n, pa.int64()), pa.array(top, pa.binary())],
                ["tree", "pos", "n", "digest"])


def _down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The path of every node: its siblings in the block, then the path of the block."""
    for batch in batches:
        for (tree, _, n, own), path, root in zip(_nodes(batch), batch.column("path").to_pylist(), batch.column("root").to_pylist()):
            found, _ = levels(_hex(own.field("digest")), n)
            above = [[*siblings(row, i)] for row in found[1:-1] for i in range(len(row))]
            paths = [[*siblings(found[0], i), *(above[i // FAN] if above else []), *path] if len(found) > 1 else path
                     for i in range(len(found[0]))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([tree] * len(paths)), own.field("pos"), pa.array(paths, pa.list_(pa.binary())),
                 pa.array([root] * len(paths), pa.binary())], ["tree", "pos", "path", "root"])


PATH = "tree string, pos long, path array<binary>, root binary"


def paths(nodes: DataFrame) -> DataFrame:
    """(tree, pos, path, root) of nodes (tree, pos, n, digest); stored. path: siblings before and after, a pair a level."""
    if (nodes.select(F.max("n")).first()[0] or 1) == 1:
        return nodes.select("tree", "pos", F.array().cast("array<binary>").alias("path"), F.col("digest").alias("root"))
    blocks = in_blocks(nodes)
    tops = stored(blocks.mapInArrow(_tops, "tree string, pos long, n long, digest binary"), "tops")
    upper = small(paths(tops).withColumnRenamed("pos", "block"), _PATH_SIZE)
    return stored(blocks.join(upper, ["tree", "block"]).mapInArrow(_down, PATH), "paths")


def fold(node: bytes, path: list[bytes]) -> list[bytes]:
    """The ancestors of a node that a version copies, up to the root."""
    out = []
    for left, right in zip(path[::2], path[1::2]):
        node = digest([left, node, right])
        out.append(node)
    return out


def _versions(with_nodes: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            others = [batch.column(c).to_pylist() for c in ("path", "root", "top_path", "top_root")]
            for (_, _, n, own), path, subroot, top_path, root in zip(_nodes(batch), *others):
                leaf, other = _hex(own.field("digest")), own.field("other").to_pylist()
                subroot, root = subroot.hex(), root.hex()
                found, _ = levels(leaf, n)
                beyond = [*path, *top_path]
                # From a leaf's parent on, the way up is the same for the whole run.
                upward = [[*(x for row, j in zip(found[1:-1], [k]) for x in siblings(row, j)), *beyond] for k in range(len(found[min(1, len(found) - 1)]))]
                proof, folded, copies = [], [], []
                for i, node in enumerate(leaf):
                    way = [*siblings(leaf, i), *upward[i // FAN]] if len(found) > 1 else beyond
                    proof.append(sha256(b"".join(way)).hexdigest())
                    if other[i] is None:
                        folded.append(root)  # nothing copied: the version is the tree itself
                        copies.append([])
                    else:
                        begin = other[i].hex().encode()
                        copies.append([begin, *fold(begin, way)])
                        folded.append(copies[-1][-1].decode())
                count = len(leaf)
                columns = [own.field("doc_id"), pa.array([x.decode() for x in leaf]), pa.array([subroot] * count), pa.array([root] * count),
                           pa.array(proof), pa.array(folded), pa.array([x == root for x in folded])]
                names = [*OUT]
                if with_nodes:
                    columns.append(pa.array([[x.decode() for x in c] for c in copies], pa.list_(pa.string())))
                    names.append("copied")
                yield pa.RecordBatch.from_arrays(columns, names)

    return run


OUT = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def manifest(docs: DataFrame, found: Column | None = None, with_nodes: bool = False) -> DataFrame:
    """OUT columns of every row of docs (FIELDS): its leaf, the roots, and whether the text as found leads to the root.

    found: the text as it is now, as a column over docs; by default the text itself. with_nodes adds copied: the digests of
    the version from its leaf to its root, none where nothing differs. Nulls in any column are values of their own;
    repeated rows are leaves each, ties of doc_id go by leaf; null ids come first. A lone leaf is its source's root,
    a lone source's root the root. An empty table has no rows. Other columns are not looked at.
    """
    prepare(docs.sparkSession)
    rows = placed(leaves(docs, F.col("text") if found is None else found), "doc_id", "leaf").withColumnRenamed("leaf", "digest")
    blocks = in_blocks(rows, "doc_id", "other")
    tops = stored(blocks.mapInArrow(_tops, "tree string, pos long, n long, digest binary"), "tops")
    upper = paths(tops)
    sources = upper.filter("pos = 0").select(F.lit("").alias("tree"), F.col("tree").alias("name"), F.col("root").alias("digest"))
    sources = stored(placed(sources, "name"), "sources")
    above = paths(sources.select("tree", "pos", "n", "digest")).select("pos", F.col("path").alias("top_path"), F.col("root").alias("top_root"))
    above = sources.select("pos", F.col("name").alias("tree")).join(above, "pos").drop("pos")
    above = stored(above, "above")
    upper = small(upper.withColumnRenamed("pos", "block"), _PATH_SIZE)
    rows = blocks.join(upper, ["tree", "block"]).join(small(above, "2 + 60 * size(top_path)"), "tree")
    doc_id = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {doc_id}, {', '.join(f'{c} string' for c in OUT[1:-1])}, verified boolean" + ", copied array<string>" * with_nodes
    return rows.mapInArrow(_versions(with_nodes), schema)

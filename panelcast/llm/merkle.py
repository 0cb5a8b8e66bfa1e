"""Merkle manifest of a dataset, with a version of the tree for every changed leaf.

Leaves of one group (here: a language) are numbered by ids; every aligned block
of 1,024 positions is a subtree that one task builds and keeps as a persistent
tree: its nodes are never overwritten. A changed leaf makes a version that
copies only the nodes on its way up and shares all others with the first
version. Blocks' roots are the leaves of the next storey, built the same way
until one node is left; the roots of the groups are again leaves of one last
tree. What a block needs from the storeys above it is the path of its own root,
one short row; with it every version is carried on to the root in the task of
its block, so that versions, however many, never meet in one place.

Nodes are SHA-256 over the lowercase hex digests of their children, two each;
a last child without a neighbour is hashed alone.

Positions come from ranges over (group, id) and prefix sums of their counts, one
row per group and range. Texts are read once and shuffled never.

Defined results: a null field counts as ``-``; null ids come first, rows of one
id in order of their digest; repeated rows are leaves of their own; a null group
is a group like any other and the first one; an empty table gives no rows; other
columns are not looked at; a text of any length is hashed whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, StringType, StructType

from panelcast.sources.spool import spool

BLOCK_BITS = 10  # a block is a whole subtree of this height
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


# ------------------------------------------------------------------------- trees


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def height(n: int) -> int:
    """Levels above ``n`` leaves until one node is left."""
    return max(n - 1, 0).bit_length()


class Tree:
    """A persistent binary tree over given leaves: nodes once made stay, versions add nodes.

    ``levels`` fixes the height, for a block that is a part of a larger tree.
    """

    def __init__(self, leaves: Sequence[str], levels: int):
        self.nodes = [list(leaves)]
        for _ in range(levels):
            below = self.nodes[-1]
            self.nodes.append([digest("".join(below[i : i + 2])) for i in range(0, len(below), 2)])

    @property
    def root(self) -> str:
        return self.nodes[-1][0]

    def path(self, leaf: int) -> list[str]:
        """The sibling at each level: ``<digest`` stands left, ``>digest`` right, an empty string for none."""
        steps = []
        for level in self.nodes[:-1]:
            at = leaf ^ 1
            steps.append("" if at >= len(level) else ("<" if leaf & 1 else ">") + level[at])
            leaf >>= 1
        return steps


def version(leaf: str, path: Sequence[str]) -> list[str]:
    """The nodes that a version copies: the new leaf and its ancestors; every sibling on the path is shared."""
    copied = [leaf]
    for step in path:
        at = copied[-1]
        copied.append(digest(step[1:] + at if step[:1] == "<" else at + step[1:]))
    return copied


# ------------------------------------------------------------------------ frames


def sized(column: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value."""
    value = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf_digest(fields: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*map(sized, fields)), 256)


def placed(rows: DataFrame, *order: str) -> DataFrame:
    """``rows`` with ``pos``, their place in the group ``g`` by ``order``, and ``n``, the size of the group.

    Ranges are cut by group and order, with a random tie so that repeated rows
    are no hot range; a row's place is its place in the range plus the rows of
    its group in earlier ranges.
    """
    keys = ["g", *order, "tie"]
    ranges = rows.withColumn("tie", F.rand(11)).repartitionByRange(*keys).sortWithinPartitions(*keys)
    numbered = spool(ranges.drop("tie").withColumn("at", F.monotonically_increasing_id()))
    counts = numbered.groupBy("g", F.shiftright("at", 33).alias("range")).agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("rows"))
    of_group = Window.partitionBy("g")
    before = F.coalesce(F.sum("rows").over(of_group.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select("g", "range", (before - F.col("first")).alias("shift"), F.sum("rows").over(of_group).alias("n"))
    return (
        numbered.withColumn("range", F.shiftright("at", 33))
        .join(starts, ["g", "range"])
        .withColumn("pos", F.col("at") + F.col("shift"))
        .drop("at", "shift", "range")
    )


def _blocks(nodes: DataFrame, bits: int, *carry: str) -> DataFrame:
    """One row per aligned block of a group: ``g, n, block, leaves`` in order."""
    block = F.shiftright("pos", bits).alias("block")
    leaves = F.sort_array(F.collect_list(F.struct("pos", "digest", *carry)))
    return spool(nodes.groupBy("g", "n", block).agg(leaves.alias("leaves")))


def _tree(n: int, leaves: list[str], bits: int) -> Tree:
    """The subtree of a block in a group of ``n``; a block that is its whole group ends at one node."""
    return Tree(leaves, min(bits, height(n)))


def _upper(blocks: DataFrame, bits: int) -> DataFrame:
    """``g, block, top, above``: the root of each block's group and the path from the block's root to it."""

    def root(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            trees = [_tree(n, leaves, bits) for n, leaves in zip(b.column("n").to_pylist(), b.column("digests").to_pylist())]
            count = [(n + (1 << bits) - 1) >> bits for n in b.column("n").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("g"), pa.array(count, pa.int64()), b.column("block"), pa.array([t.root for t in trees], pa.string())],
                ["g", "n", "pos", "digest"],
            )

    roots = blocks.select("g", "n", "block", F.col("leaves.digest").alias("digests")).mapInArrow(root, "g string, n long, pos long, digest string")
    roots = spool(roots)
    if roots.filter("n > 1").isEmpty():
        return roots.select("g", F.col("pos").alias("block"), F.col("digest").alias("top"), F.array().cast("array<string>").alias("above"))
    storey = _blocks(roots, bits)

    def paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for g, n, leaves, top, above in zip(*(b.column(c).to_pylist() for c in ("g", "n", "leaves", "top", "above"))):
                tree = _tree(n, [x["digest"] for x in leaves], bits)
                out += [{"g": g, "block": x["pos"], "top": top, "above": tree.path(i) + above} for i, x in enumerate(leaves)]
            yield pa.RecordBatch.from_pylist(out, schema=_PATHS)

    return storey.join(_upper(storey, bits), ["g", "block"]).select("g", "n", "leaves", "top", "above").mapInArrow(
        paths, "g string, block long, top string, above array<string>"
    )


_PATHS = pa.schema([("g", pa.string()), ("block", pa.int64()), ("top", pa.string()), ("above", pa.list_(pa.string()))])


def manifest(leaves: DataFrame, bits: int = BLOCK_BITS) -> DataFrame:
    """Paths and versions of ``leaves(g string not null, doc_id, digest, changed)``.

    One row per leaf: ``g, pos, doc_id, leaf, subroot, root``, ``siblings``, the
    steps from the leaf to the root (see ``Tree.path``), and ``copied``, the nodes
    of the version in which the leaf is ``changed``, from the new leaf to the new
    root; ``changed`` equal to ``digest`` gives the path of the first version.
    Groups are in bytewise order of ``g``. A block has ``2 ** bits`` leaves.
    """
    blocks = _blocks(placed(leaves, "doc_id", "digest"), bits, "doc_id", "changed")
    inner = spool(_upper(blocks, bits))
    tops = inner.filter("block = 0").select(F.lit("").alias("g"), F.col("g").alias("name"), F.col("top").alias("digest"))
    outer_blocks = _blocks(placed(tops, "name"), bits, "name")

    def outer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for n, nodes, top, above in zip(*(b.column(c).to_pylist() for c in ("n", "leaves", "top", "above"))):
                tree = _tree(n, [x["digest"] for x in nodes], bits)
                out += [{"g": x["name"], "block": 0, "top": top, "above": tree.path(i) + above} for i, x in enumerate(nodes)]
            yield pa.RecordBatch.from_pylist(out, schema=_PATHS)

    joined = outer_blocks.join(_upper(outer_blocks, bits), ["g", "block"]).select("n", "leaves", "top", "above")
    roots = joined.mapInArrow(outer, "g string, block long, top string, above array<string>")
    roots = roots.select("g", F.col("top").alias("root"), F.col("above").alias("over"))
    whole = blocks.join(inner, ["g", "block"]).join(roots, "g")
    schema = StructType.fromDDL("g string, pos long")
    schema.add(leaves.schema["doc_id"])
    for name in ("leaf", "subroot", "root"):
        schema.add(name, "string")
    for name in ("siblings", "copied"):
        schema.add(name, ArrayType(StringType()))
    wanted = to_arrow_schema(schema)

    def versions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for g, n, nodes, subroot, above, root, over in zip(*(b.column(c).to_pylist() for c in ("g", "n", "leaves", "top", "above", "root", "over"))):
                tree, out = _tree(n, [x["digest"] for x in nodes], bits), []
                for i, x in enumerate(nodes):
                    path = tree.path(i) + above + over
                    out.append(
                        {
                            "g": g,
                            "pos": x["pos"],
                            "doc_id": x["doc_id"],
                            "leaf": x["digest"],
                            "subroot": subroot,
                            "root": root,
                            "siblings": path,
                            "copied": version(x["changed"], path),
                        }
                    )
                yield pa.RecordBatch.from_pylist(out, schema=wanted)

    return whole.select("g", "n", "leaves", "top", "above", "root", "over").mapInArrow(versions, schema)


def document_leaves(docs: DataFrame, every: int = 7) -> DataFrame:
    """Leaves of ``docs`` by language; where ``every`` divides the CRC-32 of the id, ``changed`` has one more in ``n_chars``."""
    group = F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit(""))
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % every == 0, F.lit(False))
    own = leaf_digest([F.col(c) for c in FIELDS])
    other = leaf_digest([F.col(c) + 1 if c == "n_chars" else F.col(c) for c in FIELDS])
    slim = docs.select("doc_id", group.alias("g"), own.alias("digest"), F.when(hit, other).alias("other"))
    return slim.select("doc_id", "g", "digest", F.coalesce("other", "digest").alias("changed"))


def verified(paths: DataFrame) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` of ``manifest``'s rows."""
    proof = F.sha2(F.concat_ws("", F.transform("siblings", lambda s: F.substring(s, 2, 64))), 256)
    folded = F.element_at("copied", -1)
    return paths.select(
        "doc_id", "leaf", "subroot", "root", proof.alias("proof_sha256"), folded.alias("folded_root"), (folded == F.col("root")).alias("verified")
    )

"""A Merkle manifest of a dataset, as a persistent tree with path copying.

Every row is a leaf; the leaves of a source, in the order of their ids, are the bottom of its
tree, and the roots of all sources are the bottom of the tree above. Each ``ARITY`` consecutive
nodes become one.

Trees are built in aligned blocks of ``ARITY ** LEVELS`` consecutive nodes, so that a
block is a whole subtree of known height. A task folds a block to its top; the tops are the nodes
of the next round, until each source has one, and then the sources are folded in the same way.
Back down, every block gets the path of its top to the root: the siblings on each level.

A changed leaf makes a version of the tree. The version shares all nodes that the change does
not touch and copies only the ancestors of its leaf: those in the leaf's block there, those
above along the block's path, so that a version costs one digest a level and no other version
sees it. A version is verified if its root is the root of the dataset.

Places are found without a sort in one task: rows are sorted by ranges, and a row's place is
its place in its range plus the rows of its tree in ranges before.

Definitions. Digests are lower-case hexadecimal SHA-256 of the texts of their parts, joined. Null
sources come first, others by their bytes; null ids first. Rows that repeat an id are leaves of
their own, in the order of their digests. A null field is written ``-``, so that it differs from an
empty one. Rows with a null id are never tampered with in ``tampered``. An empty table has no
root and no rows. Columns other than those of the manifest are not looked at, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import materialize, work_dir
from .columns import picked

ARITY = 3
LEVELS = 6  # of a block
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def _stored(frame: DataFrame) -> DataFrame:
    return materialize(frame, work_dir(frame.sparkSession, "manifest"))


def digest(*parts: str) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def leaf_digest(fields: list[Column]) -> Column:
    """The digest of a row: each field ``-`` if null, else its UTF-8 bytes' number, a colon, and itself."""
    texts = [f.cast("string") for f in fields]
    written = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*written), 256)


def height(n: int) -> int:
    """Levels above ``n`` nodes until one is left."""
    levels = 0
    while n > 1:
        n, levels = -(-n // ARITY), levels + 1
    return levels


def _place(frame: DataFrame, tree: str | None, order: list[str]) -> DataFrame:
    """``frame`` with the ``place`` of each row in its tree, by ``order``, and the tree's size ``n``."""
    keys = [tree] if tree else []
    ranged = frame.withColumn("tie", F.monotonically_increasing_id())  # splits rows that are equal
    ranged = ranged.repartitionByRange(*keys, *order, "tie").sortWithinPartitions(*keys, *order, "tie").drop("tie")
    number = F.monotonically_increasing_id()
    stored = _stored(ranged.withColumn("number", number).withColumn("part", F.shiftright("number", 33)))
    counts = stored.groupBy(*keys, "part").agg(F.min("number").alias("first"), F.count("*").alias("rows"))
    own = Window.partitionBy(*keys)  # a row for each range and tree
    before = F.sum("rows").over(own.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.withColumn("start", F.coalesce(before, F.lit(0)) - F.col("first")).withColumn("n", F.sum("rows").over(own))
    counts = counts.select(*keys, "part", "start", "n").alias("c")
    same = F.col("s.part") == F.col("c.part")
    if tree:
        same &= F.col(f"s.{tree}").eqNullSafe(F.col(f"c.{tree}"))
    joined = stored.alias("s").join(counts, same)
    kept = [F.col(f"s.{c}") for c in stored.columns if c not in ("number", "part")]
    return joined.select(*kept, (F.col("s.number") + F.col("c.start")).alias("place"), "c.n")


class Block:
    """The subtree above some consecutive nodes: ``nodes`` by level, the given ones first."""

    def __init__(self, digests: list[str], levels: int):
        self.nodes = [digests]
        for _ in range(levels):
            below = self.nodes[-1]
            self.nodes.append([digest(*below[i : i + ARITY]) for i in range(0, len(below), ARITY)])

    @property
    def top(self) -> str:
        return self.nodes[-1][0]

    def siblings(self, at: int) -> list[str]:
        """Of the node ``at`` of the bottom, level by level: what stands left of it and right of it in its run."""
        path = []
        for level in self.nodes[:-1]:
            begin = at - at % ARITY
            path += ["".join(level[begin:at]), "".join(level[at + 1 : begin + ARITY])]
            at //= ARITY
        return path


def version(leaf: str, path: list[str]) -> str:
    """The root of the version in which a node of the path's bottom is ``leaf``: copies of its ancestors only."""
    for left, right in zip(path[::2], path[1::2], strict=True):
        leaf = digest(left, leaf, right)
    return leaf


def _gathered(nodes: DataFrame, keep: list[str], levels: int) -> DataFrame:
    """(tree, block, n, items): the nodes of each aligned block."""
    item = F.struct("place", *keep)
    block = F.expr(f"place div {ARITY**levels}").alias("block")
    return _stored(nodes.groupBy("tree", block, "n").agg(F.sort_array(F.collect_list(item)).alias("items")))


def _block(row: dict, levels: int) -> Block:
    return Block([item["digest"] for item in row["items"]], min(levels, height(row["n"])))


def _rows(work: Callable[[dict], Iterator[tuple]], names: list[str], kinds: pa.Schema):
    """``work`` over each row, as a function of Arrow batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):  # a block at a time
                out = list(work(batch.slice(i, 1).to_pylist()[0]))
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), kinds, strict=True)], names) if out else pa.RecordBatch.from_pylist([], kinds)

    return run


def _tops(blocks: DataFrame, levels: int) -> DataFrame:
    """The nodes of the next round."""
    kinds = pa.schema([("tree", pa.string()), ("place", pa.int64()), ("digest", pa.string()), ("n", pa.int64())])

    def top(row: dict) -> Iterator[tuple]:
        yield row["tree"], row["block"], _block(row, levels).top, -(-row["n"] // ARITY**levels)

    return blocks.mapInArrow(_rows(top, kinds.names, kinds), "tree string, place long, digest string, n long")


def _with_path(blocks: DataFrame, above: DataFrame | None) -> DataFrame:
    """``blocks`` with the path from their tops upwards, empty where nothing is above."""
    if above is None:
        return blocks.withColumn("above", F.array().cast("array<string>"))
    same = F.col("b.tree").eqNullSafe(F.col("a.tree")) & (F.col("b.block") == F.col("a.place"))
    return blocks.alias("b").join(above.alias("a"), same).select("b.*", F.col("a.path").alias("above"))


def _paths(blocks: DataFrame, above: DataFrame | None, levels: int) -> DataFrame:
    """(tree, place, path) of every node in ``blocks``."""
    kinds = pa.schema([("tree", pa.string()), ("place", pa.int64()), ("path", pa.list_(pa.string()))])

    def paths(row: dict) -> Iterator[tuple]:
        block = _block(row, levels)
        for i, item in enumerate(row["items"]):
            yield row["tree"], item["place"], block.siblings(i) + row["above"]

    return _with_path(blocks, above).mapInArrow(_rows(paths, kinds.names, kinds), "tree string, place long, path array<string>")


def _rounds(nodes: DataFrame, keep: list[str], levels: int) -> tuple[list[DataFrame], DataFrame]:
    """The blocks of each round, from the bottom, and the roots of the trees."""
    rounds = [_gathered(nodes, keep, levels)]
    while True:
        tops = _stored(_tops(rounds[-1], levels))
        if tops.filter("n > 1").isEmpty():
            return rounds, tops
        rounds.append(_gathered(tops, ["digest"], levels))


def _down(rounds: list[DataFrame], above: DataFrame | None, levels: int) -> DataFrame | None:
    """The paths of the tops of the first round's blocks, given those of the roots."""
    for blocks in reversed(rounds[1:]):
        above = _stored(_paths(blocks, above, levels))
    return above


def manifest(leaves: DataFrame, levels: int = LEVELS) -> DataFrame:
    """The tree of ``leaves`` (tree string, id long, digest string, changed string), a row for each leaf.

    Returns id, tree, place, digest, subroot, root, proof (the siblings up to the root), folded (the root of
    the version in which the leaf is ``changed``; null keeps it) and verified.
    """
    placed = _place(_stored(leaves), "tree", ["id", "digest"])
    rounds, subroots = _rounds(placed, ["digest", "id", "changed"], levels)
    # The tree of the sources: its places are the order of the sources.
    sources = _place(subroots.select("tree", "digest"), None, ["tree"])
    sources = _stored(sources.select(F.col("tree").alias("source"), "digest", "place", "n"))
    upper, root = _rounds(sources.select(F.lit("").alias("tree"), "place", "digest", "n"), ["digest"], levels)
    paths = _paths(upper[0], _down(upper, None, levels), levels)
    of_source = paths.join(sources, "place").select(F.col("source").alias("tree"), F.lit(0).cast("long").alias("place"), "path")
    above = _down(rounds, _stored(of_source), levels)
    same = F.col("b.tree").eqNullSafe(F.col("s.tree"))
    blocks = _with_path(rounds[0], above).alias("b").join(subroots.alias("s"), same).select("b.*", F.col("s.digest").alias("subroot"))
    top = root.first()
    blocks = blocks.withColumn("root", F.lit(top["digest"] if top else None).cast("string"))

    kinds = pa.schema(
        [("id", pa.int64()), ("tree", pa.string()), ("place", pa.int64()), ("digest", pa.string()), ("subroot", pa.string()), ("root", pa.string())]
        + [("proof", pa.list_(pa.string())), ("folded", pa.string()), ("verified", pa.bool_())]
    )

    def verify(row: dict) -> Iterator[tuple]:
        block, root = _block(row, levels), row["root"]
        for i, item in enumerate(row["items"]):
            path = block.siblings(i) + row["above"]
            leaf = item["changed"] or item["digest"]
            folded = version(leaf, path)
            yield item["id"], row["tree"], item["place"], item["digest"], row["subroot"], root, [p for p in path if p], folded, folded == root

    out = "id long, tree string, place long, digest string, subroot string, root string, proof array<string>, folded string, verified boolean"
    return blocks.mapInArrow(_rows(verify, kinds.names, kinds), out)


def tampered(docs: DataFrame) -> Column:
    """The text of a row as the tampering leaves it: without line feeds where 2 divides the checksum of the id."""
    odd = F.crc32(F.col("doc_id").cast("string")) % 2
    return F.when(odd == 0, F.translate("text", "\n", "")).otherwise(F.col("text"))


def document_leaves(docs: DataFrame) -> DataFrame:
    """The leaves of ``documents``, with what tampering makes of them (null where it changes nothing)."""
    rows = picked(docs, *FIELDS)
    leaf = leaf_digest([F.col(c) for c in FIELDS])
    changed = leaf_digest([*(F.col(c) for c in FIELDS[:-1]), tampered(rows)])
    moved = F.coalesce(tampered(rows) != F.col("text"), F.lit(False))
    return rows.select(
        F.col("source").cast("string").alias("tree"), F.col("doc_id").cast("long").alias("id"), leaf.alias("digest"), F.when(moved, changed).alias("changed")
    )

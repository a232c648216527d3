"""A prefix trie of conversations, in double arrays by prefix shard.

A turn is the 128-bit digest of its role and text; a conversation is the sequence of its turns.
Equal sequences are one path of the trie with a count, so copies cost nothing further on.

The sequences are cut into prefix shards, disjoint subtrees of at most ``MOST`` sequences each. They are
found from the root down: prefixes of one more turn are counted, those that few sequences
share are roots of shards, and only the sequences below frequent prefixes go into the next
round. So a first turn that a third of all conversations share is an upper node, and its subtree lies in
many shards.

In a task each shard numbers its turns densely and packs its subtree into two arrays: the child
of node s by turn c is t = BASE[s] + c if CHECK[t] = s. Following the sequences through the arrays
counts the members of each node; going through the nodes from the deepest up, CHECK gives the
parent to which leaves and saved bytes are added. What the roots of shards gathered is then merged
over the upper nodes, one level after the other from the bottom, by grouped sums.

Definitions. Turns of a conversation are ordered by number, null first, then by the MD5 of role
and text; null role or text is empty. Rows without a conv_id belong to no conversation and are
left out. An empty table has no nodes. A conversation's turns, 24 bytes each, are gathered in one
row; the texts are not. A task holds the sequences of one shard at a time. Columns other than
conv_id, turn, role and text are not looked at, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, work_dir
from .columns import picked

MOST = 256
SHARED = 8
FAMILY = 5
CHUNK = 4096
NO_ENDS = sha256().hexdigest()

NODE = "key binary, depth long, conv_id long, parent binary, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved long, ends string"


def _stored(frame: DataFrame) -> DataFrame:
    return materialize(frame, work_dir(frame.sparkSession, "trie"))


def sequences(turns: DataFrame) -> DataFrame:
    """(conv_id, seq): the turns of each conversation in order, as (digest, bytes of the text)."""
    rows = picked(turns, "conv_id", "turn", "role", "text").filter("conv_id is not null")
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    code = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)))
    turn = F.struct(F.col("turn").cast("long").alias("turn"), code.alias("code"), F.octet_length(text).cast("long").alias("bytes"))
    own = rows.groupBy(F.col("conv_id").cast("long").alias("conv_id")).agg(F.sort_array(F.collect_list(turn)).alias("seq"))
    return own.withColumn("seq", F.transform("seq", lambda t: F.struct(t["code"].alias("code"), t["bytes"].alias("bytes"))))


def rebuilt(own: DataFrame) -> DataFrame:
    """Each conversation of ``own`` behind the head of its family's first: h turns, by the checksum of its id."""
    base = F.col("conv_id") - F.pmod("conv_id", F.lit(FAMILY))  # at or below the id, also where that is negative
    heads = own.filter(base == F.col("conv_id")).select(F.col("conv_id").alias("base"), F.slice("seq", 1, SHARED).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string")) % (SHARED + 1)).cast("int")
    joined = own.withColumn("base", base).withColumn("h", h).join(heads, "base", "left")
    none = F.array().cast(own.schema["seq"].dataType)
    head = F.slice(F.coalesce("head", none), F.lit(1), F.col("h"))
    tail = F.slice("seq", F.col("h") + 1, F.size("seq"))
    return joined.select("conv_id", F.concat(head, tail).alias("seq"))


def _key(depth):
    """The name of the node that a sequence reaches after ``depth`` turns."""
    codes = F.transform(F.slice("seq", F.lit(1), depth), lambda t: F.hex(t["code"]))
    return F.unhex(F.md5(F.array_join(codes, "")))


def _joined_ids(batches: Iterator[pa.RecordBatch], chunk: int) -> Iterator[pa.RecordBatch]:
    """Ids in order, joined by commas in chunks of one key each."""
    for batch in batches:
        keys, ids = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        out, at = [], 0
        for key, group in groupby(keys):
            end = at + len(list(group))
            out += [(key, ids[i], ",".join(map(str, ids[i : min(i + chunk, end)])), min(chunk, end - i)) for i in range(at, end, chunk)]
            at = end
        columns = zip(*out, strict=True) if out else [[]] * 4
        kinds = (pa.binary(), pa.int64(), pa.string(), pa.int64())
        yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["key", "conv_id", "ids", "n"])


def _hashed_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks in the order of key and id, one digest for each key; a chunk at a time is held."""
    key = state = least = None
    n, kinds = 0, (pa.binary(), pa.int64(), pa.int64(), pa.string())
    done: list[tuple] = []

    def flush() -> pa.RecordBatch:
        columns = list(zip(*done, strict=True)) if done else [[]] * 4
        done.clear()
        return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["key", "conv_id", "n", "ends"])

    for batch in batches:
        for k, conv, ids, count in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            if k != key:
                if key is not None:
                    done.append((key, least, n, state.hexdigest()))
                key, state, least, n = k, sha256(ids.encode()), conv, count
            else:
                state.update(b"," + ids.encode())
                n += count
        yield flush()
    if key is not None:
        done.append((key, least, n, state.hexdigest()))
    yield flush()


def distinct_sequences(seqs: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(key, conv_id, n, ends, seq): each sequence once, with its least conversation, their number and the digest of their ids."""
    ids = seqs.select(_key(F.size("seq")).alias("key"), "conv_id")
    ranged = ids.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    chunks = ranged.mapInArrow(lambda b: _joined_ids(b, chunk), "key binary, conv_id long, ids string, n long")
    # SHA-256 goes through its input in order, so one task reads the chunks of a key, one by one.
    dealt = chunks.repartition("key").sortWithinPartitions("key", "conv_id")
    ends = dealt.mapInArrow(_hashed_ids, "key binary, conv_id long, n long, ends string")
    return _stored(ends.join(seqs, "conv_id").select("key", "conv_id", "n", "ends", "seq"))


def _shards(every: DataFrame, most: int) -> tuple[DataFrame, list[DataFrame]]:
    """The sequences with ``shard`` (the key of its root) and ``cut`` (its depth), and the upper nodes of each depth."""
    hot, depth, cut, upper = every, 0, [], []
    while True:
        prefixes = hot.filter(F.size("seq") >= depth).withColumn("shard", _key(F.lit(depth)))
        if depth:
            # Written down, so that a join on a frequent prefix can be split.
            counted = _stored(prefixes.groupBy("shard").agg(F.count("*").alias("size")))
            sized = _stored(prefixes.alias("p").join(counted.alias("c"), "shard").select("p.*", "c.size"))
        else:
            sized = prefixes.withColumn("size", F.lit(every.count()))
        cut.append(sized.filter(F.col("size") <= most).drop("size").withColumn("cut", F.lit(depth).cast("long")))
        hot = sized.filter(F.col("size") > most)
        if hot.isEmpty():
            break
        last = F.element_at("seq", depth)["bytes"] if depth else F.lit(0)
        above = _key(F.lit(depth - 1)) if depth else F.lit(None).cast("binary")
        nodes = hot.groupBy(F.col("shard").alias("key")).agg(F.first(above).alias("parent"), F.first(last).cast("long").alias("bytes"))
        upper.append(_stored(nodes))
        hot, depth = hot.drop("shard", "size"), depth + 1
    shards = cut[0]
    for x in cut[1:]:
        shards = shards.unionByName(x)
    return shards, upper


class DoubleArray:
    """A trie of sequences of turn ids 1, 2, ... in BASE and CHECK; node 1 is its root."""

    def __init__(self, rows: list[list[int]]):
        self.base, self.check = [0, 0], [0, 1]
        self.free = 2  # no slot below is free
        stack = [(1, 0, rows)]
        while stack:
            node, depth, below = stack.pop()
            parts: dict[int, list] = {}
            for row in below:
                if len(row) > depth:
                    parts.setdefault(row[depth], []).append(row)
            if parts:
                base = self.base[node] = self._fit(sorted(parts))
                for turn in parts:
                    self.check[base + turn] = node
                stack += [(base + turn, depth + 1, part) for turn, part in parts.items()]

    def _fit(self, turns: list[int]) -> int:
        """The least base at which the slots of all ``turns`` are free."""
        while self.free < len(self.check) and self.check[self.free]:
            self.free += 1
        base = self.free - turns[0]
        while any(base + t < 2 or base + t < len(self.check) and self.check[base + t] for t in turns):
            base += 1
        grow = base + turns[-1] + 1 - len(self.check)
        if grow > 0:
            self.check += [0] * grow
            self.base += [0] * grow
        return base

    def step(self, node: int, turn: int) -> int:
        """The child of ``node`` by ``turn``, 0 if there is none."""
        slot = self.base[node] + turn
        return slot if 1 < slot < len(self.check) and self.check[slot] == node else 0


def _shard_nodes(rows: list[dict]) -> list[tuple]:
    """The nodes of a shard, its root first, in the order of ``NODE`` but for key and parent of the inner ones."""
    cut = rows[0]["cut"]
    ids: dict[bytes, int] = {}
    paths = [[ids.setdefault(t["code"], len(ids) + 1) for t in row["seq"][cut:]] for row in rows]
    trie = DoubleArray(paths)
    size = len(trie.check)
    n, least = np.zeros(size, np.int64), np.full(size, np.iinfo(np.int64).max)
    depth, text = np.zeros(size, np.int64), np.zeros(size, np.int64)
    ends = [NO_ENDS] * size
    text[1] = rows[0]["seq"][cut - 1]["bytes"] if cut else 0
    for row, path in zip(rows, paths, strict=True):
        node, conv = 1, row["conv_id"]
        n[1] += row["n"]
        least[1] = min(least[1], conv)
        for at, turn in enumerate(path):
            node = trie.step(node, turn)
            n[node] += row["n"]
            least[node] = min(least[node], conv)
            depth[node], text[node] = at + 1, row["seq"][cut + at]["bytes"]
        ends[node] = row["ends"]
    check = np.array(trie.check)
    used = np.flatnonzero(n)
    children = np.bincount(check[used[used > 1]], minlength=size)
    leaves, saved = (children == 0).astype(np.int64), (n - 1) * text
    for node in used[np.argsort(-depth[used], kind="stable")]:
        if node > 1:
            leaves[check[node]] += leaves[node]
            saved[check[node]] += saved[node]
    order = [1, *(t for t in used.tolist() if t > 1)]
    root, parent = rows[0]["shard"], rows[0]["parent"]
    return [
        (
            root if t == 1 else None,
            cut + int(depth[t]),
            int(least[t]),
            parent if t == 1 else None,
            None if t == 1 else int(least[check[t]]),
            *map(int, (n[t], children[t], leaves[t], saved[t])),
            ends[t],
        )
        for t in order
    ]


_KINDS = [pa.binary(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()]


def _walked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nodes of shards whose sequences follow one another."""
    names = [f.split()[0] for f in NODE.split(", ")]

    def nodes(rows: list[dict]) -> pa.RecordBatch:
        return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*_shard_nodes(rows), strict=True), _KINDS, strict=True)], names)

    rows: list[dict] = []
    for batch in batches:
        for begin in range(0, batch.num_rows, MOST):
            for row in batch.slice(begin, MOST).to_pylist():
                if rows and row["shard"] != rows[0]["shard"]:
                    yield nodes(rows)
                    rows = []
                rows.append(row)
    if rows:
        yield nodes(rows)


def _merged(tops: DataFrame, upper: list[DataFrame], every: DataFrame) -> list[DataFrame]:
    """The upper nodes of each depth, as ``NODE``, from the ``tops`` of shards and the sequences that end at them."""
    levels: list[DataFrame] = []
    below = None
    for depth in reversed(range(len(upper))):
        own = tops.filter(F.col("depth") == depth + 1)
        own = own if below is None else own.unionByName(below)
        sums = own.groupBy("parent").agg(
            F.min("conv_id").alias("conv_id"),
            F.sum("n_convs").alias("n_convs"),
            F.count("*").alias("n_children"),
            F.sum("n_leaves").alias("n_leaves"),
            F.sum("saved").alias("saved"),
        )
        ended = every.filter(F.size("seq") == depth).select("key", F.col("conv_id").alias("end_conv"), "n", "ends")
        nodes = upper[depth].join(sums.withColumnRenamed("parent", "key"), "key", "left").join(ended, "key", "left")
        zero = F.lit(0).cast("long")
        n = F.coalesce("n_convs", zero) + F.coalesce("n", zero)
        nodes = nodes.select(
            "key",
            F.lit(depth).cast("long").alias("depth"),
            F.least("conv_id", "end_conv").alias("conv_id"),
            "parent",
            F.lit(None).cast("long").alias("parent_conv_id"),
            n.alias("n_convs"),
            F.coalesce("n_children", zero).alias("n_children"),
            F.coalesce("n_leaves", F.lit(1).cast("long")).alias("n_leaves"),
            (F.coalesce("saved", zero) + (n - 1) * F.col("bytes")).alias("saved"),
            F.coalesce("ends", F.lit(NO_ENDS)).alias("ends"),
        )
        below = _stored(nodes)
        levels.append(below)
    return levels


def trie(seqs: DataFrame, most: int = MOST) -> DataFrame:
    """The nodes of the trie over ``seqs`` (conv_id, seq), a row each, the textless root included.

    conv_id is the least member; depth, parent_conv_id, n_convs (members), n_children, n_leaves and saved are of
    the subtree under the node: childless nodes, and bytes of the turns that members need not store again. ends
    is the digest of the ids of members that end at the node, in order.
    """
    every = distinct_sequences(_stored(seqs))
    shards, upper = _shards(every, most)
    parent = F.when(F.col("cut") > 0, _key((F.col("cut") - 1).cast("int")))
    dealt = shards.withColumn("parent", parent).repartition("shard").sortWithinPartitions("shard")
    nodes = _stored(dealt.select("shard", "cut", "parent", "conv_id", "n", "ends", "seq").mapInArrow(_walked, NODE))
    tops = nodes.filter("key is not null")
    levels = _merged(tops, upper, every)
    if levels:
        merged = levels[0]
        for x in levels[1:]:
            merged = merged.unionByName(x)
        named = merged.select(F.col("key").alias("parent"), F.col("conv_id").alias("above"))
        tops = tops.unionByName(merged).join(named, "parent", "left").withColumn("parent_conv_id", F.col("above")).drop("above")
    return tops.unionByName(nodes.filter("key is null")).drop("key", "parent")

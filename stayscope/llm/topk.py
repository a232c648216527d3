"""Exact search for the largest integer inner products, by pairs of cover trees.

Vectors are dealt to blocks; a block of data and a block of queries each become a cover tree,
in which a node stands for its vectors by one of them and a radius that covers the others,
and children cover their share with about half the radius. Pairs of nodes are visited
together, best bound first. No inner product between the two nodes exceeds
``<q, p> + rq * |p| + rp * |q| + rq * rp``, so a pair goes if that is less than the worst k-th
score of the queries below its query node. What is left at the leaves is computed exactly.

All query blocks meet all data blocks, as any exact search must; data blocks travel whole,
as one row each, and only the best of each query and block come back.

Definitions. Components become floor(scale * x) as integers, inner products are exact in
doubles below 2**53. Vectors that are null, empty or hold null or non-finite components take
no part, and neither does a query or candidate with a null id. A query's own id is no
candidate; all other rows are, also different vectors of one id, each in its own right; rows that are the same in both
count once. Query rows of one id share their k results. Vectors of different lengths are not compared. Ties go to the smaller id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .columns import any_names
from .words import column

K = 10
SCALE = 1024
LEAF = 64
#: Vectors in a block of data, about, and in a block of queries.
DATA_BLOCK, QUERY_BLOCK = 4096, 2048


class Node:
    """Vectors ``rows`` of a tree within ``radius`` of the vector ``center``."""

    __slots__ = ("rows", "center", "radius", "children", "norm")

    def __init__(self, rows, center, radius, children, norm):
        self.rows, self.center, self.radius, self.children, self.norm = rows, center, radius, children, norm


def cover_tree(x: np.ndarray, rows: np.ndarray | None = None, center: int | None = None) -> Node:
    rows = np.arange(len(x)) if rows is None else rows
    center = int(rows[0]) if center is None else center
    away = np.sqrt(((x[rows] - x[center]) ** 2).sum(1))
    radius = float(away.max())
    children = []
    if len(rows) > LEAF and radius > 0:
        # Centres at least half the radius apart, farthest first; every vector goes to its nearest.
        centers, nearest, least = [center], np.zeros(len(rows), np.int64), away
        while least.max() > radius / 2 and len(centers) < 16:
            centers.append(int(rows[least.argmax()]))
            d = np.sqrt(((x[rows] - x[centers[-1]]) ** 2).sum(1))
            closer = d < least
            nearest[closer] = len(centers) - 1
            least = np.minimum(least, d)
        if len(centers) > 1:
            children = [cover_tree(x, rows[nearest == i], c) for i, c in enumerate(centers) if (nearest == i).any()]
    return Node(rows, center, radius, children, float(np.sqrt((x[center] ** 2).sum())))


class Search:
    """The best k of each query among one block of data."""

    def __init__(self, q: np.ndarray, q_ids: np.ndarray, x: np.ndarray, x_ids: np.ndarray, k: int):
        self.q, self.q_ids, self.x, self.x_ids, self.k = q, q_ids, x, x_ids, k
        self.score = np.full((len(q), k), -np.inf)
        self.id = np.full((len(q), k), np.iinfo(np.int64).max)
        self.pairs = 0

    def run(self) -> Search:
        a, b = cover_tree(self.q), cover_tree(self.x)
        stack = [(self.bound(a, b), a, b)]
        while stack:
            bound, a, b = stack.pop()
            if bound < self.score[a.rows, -1].min():
                continue
            if not a.children and not b.children:
                self.leaves(a.rows, b.rows)
                continue
            if b.children and (not a.children or b.radius >= a.radius):
                pairs = [(a, c) for c in b.children]
            else:
                pairs = [(c, b) for c in a.children]
            stack += sorted(((self.bound(*p), *p) for p in pairs), key=lambda t: t[0])
        return self

    def bound(self, a: Node, b: Node) -> float:
        most = float(self.q[a.center] @ self.x[b.center]) + a.radius * b.norm + b.radius * a.norm + a.radius * b.radius
        return most + 1e-6 * (1 + abs(most))

    def leaves(self, rows: np.ndarray, others: np.ndarray) -> None:
        self.pairs += len(rows) * len(others)
        new = self.q[rows] @ self.x[others].T
        ids = np.broadcast_to(self.x_ids[others], new.shape)
        new[ids == self.q_ids[rows][:, None]] = -np.inf
        score = np.concatenate((self.score[rows], new), 1)
        ids = np.concatenate((self.id[rows], ids), 1)
        order = np.lexsort((ids, -score), axis=1)[:, : self.k]
        self.score[rows] = np.take_along_axis(score, order, 1)
        self.id[rows] = np.take_along_axis(ids, order, 1)


def _matrix(value: pa.Array, scale: int | None) -> np.ndarray:
    x = value.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(value), -1)
    return np.floor(x * scale) if scale else x


def _blocks(vectors: DataFrame, block: Column) -> DataFrame:
    """Blocks of vectors of one length as one row: block, dims, ids, values."""
    return vectors.groupBy(block.alias("block"), F.size("vec").alias("dims")).agg(
        F.collect_list(F.struct("id", "vec")).alias("rows")
    ).select("block", "dims", F.col("rows.id").alias("ids"), F.flatten("rows.vec").alias("values"))


def usable(vectors: DataFrame, id_column: str, vec_column: str) -> DataFrame:
    """The different (id, vec) of the rows that take part."""
    vec = F.col(vec_column).cast("array<double>")
    bad = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = vectors.select(F.col(id_column).cast("long").alias("id"), vec.alias("vec"))
    return whole.filter("id is not null and size(vec) > 0").filter(~bad).distinct()


def _searched(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            dims = column(batch, "dims")[i].as_py()
            part = {n: column(batch, n)[i].values.to_numpy(zero_copy_only=False) for n in ("q_ids", "q_values", "ids", "values")}
            x, q = part["values"].reshape(-1, dims), part["q_values"].reshape(-1, dims)
            x_order, q_order = np.argsort(part["ids"], kind="stable"), np.argsort(part["q_ids"], kind="stable")
            found = Search(q[q_order], part["q_ids"][q_order], x[x_order], part["ids"][x_order], k).run()
            ok = np.isfinite(found.score)
            rows = np.nonzero(ok)[0]
            yield pa.record_batch(
                [pa.array(found.q_ids[rows]), pa.array(found.id[ok]), pa.array(found.score[ok].astype(np.int64))], ["query_id", "vec_id", "score"]
            )


@any_names("vec_id", "embedding")
def exact_topk(vectors: DataFrame, is_query: Column, k: int = K, scale: int = SCALE, id_column: str = "vec_id", vec_column: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k candidates of largest score for each query. is_query: a condition on ``id``."""
    whole = usable(vectors, id_column, vec_column).withColumn("vec", F.transform("vec", lambda x: F.floor(x * scale).cast("double")))
    n = whole.select(F.count("*"), F.count(F.when(is_query, 1))).first()
    parts = 1 + n[0] // DATA_BLOCK
    q_parts = 1 + n[1] // QUERY_BLOCK
    deal = lambda m: F.pmod(F.xxhash64("id"), F.lit(m))
    data = _blocks(whole, deal(parts)).withColumn("q_block", F.explode(F.sequence(F.lit(0), F.lit(q_parts - 1))))
    asked = _blocks(whole.filter(is_query), deal(q_parts)).select(
        F.col("block").alias("q_block"), "dims", F.col("ids").alias("q_ids"), F.col("values").alias("q_values")
    )
    pairs = data.join(asked, ["q_block", "dims"]).repartition(int(parts * q_parts), "block", "q_block", "dims")
    found = pairs.select("dims", "q_ids", "q_values", "ids", "values").mapInArrow(lambda b: _searched(b, k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

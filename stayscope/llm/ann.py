"""Approximate nearest neighbours by inner product: p-stable hashing with many probes.

Vectors are divided by the largest norm and given one more component that makes them unit
vectors, queries become unit vectors; then the nearest by distance are those of the largest
inner product. Each of ``TABLES`` tables hashes a vector by a few functions
floor((a.x + b) / w) with normal a, as many as make buckets of about ``BUCKET`` vectors.

A neighbour with cosine s lies, under one function, around s times the query's projection with
variance 1 - s * s, which gives each perturbed bucket a probability of holding it. Every query
first visits its ``FIRST`` best buckets of each table; the k-th best score found there is a
lower bound of the wanted s. It then visits buckets in the order of estimated success until
their sum reaches the target, so queries in dense places stop early and those without close
neighbours go on. Data and probes meet by bucket; buckets are split in parts of bounded size,
each of which returns a query's best only. Scores are exact inner products of the original vectors.

Definitions. Vectors that are null, empty, zero or hold null or non-finite components take
no part. Vectors of different lengths are not compared. A query's own id is no candidate;
all vectors of a repeated id are, and it is returned once, with its best score. Query rows of one id share their k results.
Ties go to the smaller id. A query for which fewer than k
are found in its first buckets is compared with every vector of its length, in blocks of ``PART``.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import log2

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import materialize, work_dir
from .columns import any_names
from .topk import usable
from .words import column

K = 20
TABLES = 2
BUCKET = 512
WIDTH = 1.0
FIRST = 4
TARGET = 0.97
#: Vectors of a bucket that are held at once.
PART = 8192
#: Probes that are sent at once.
SENT = 8192
#: Projections of unit vectors beyond this many slots fall into the last one.
REACH = 5


class Hashes:
    """The functions of one table for vectors of ``dims`` components."""

    def __init__(self, table: int, dims: int, functions: int):
        rng = np.random.default_rng([7, table, dims])
        self.a = rng.standard_normal((32, dims + 1))[:functions]
        self.b = rng.uniform(0, WIDTH, 32)[:functions]

    def places(self, x: np.ndarray) -> np.ndarray:
        """Where unit vectors fall, in units of the width."""
        return (x @ self.a.T + self.b) / WIDTH

    def keys(self, x: np.ndarray) -> np.ndarray:
        return _key(np.clip(np.floor(self.places(x)), -REACH, REACH).astype(np.int64))


def _key(slots: np.ndarray) -> np.ndarray:
    key = np.zeros(slots.shape[:-1], np.int64)
    for j in range(slots.shape[-1]):
        key = key * (2 * REACH + 1) + slots[..., j] + REACH
    return key


def _normal(z: np.ndarray) -> np.ndarray:
    """The normal distribution function, within 1e-7."""
    t = 1 / (1 + 0.2316419 * np.abs(z))
    tail = np.exp(-z * z / 2) / np.sqrt(2 * np.pi) * t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    return np.where(z > 0, 1 - tail, tail)


def probes(projection: np.ndarray, offset: np.ndarray, s: float, target: float, most: int | None = None) -> np.ndarray:
    """Bucket keys for one query in the order of estimated success, until that sums to the target."""
    slots = np.arange(-REACH, REACH + 1)
    spread = np.sqrt(max(1 - s * s, 1e-4))
    edge = np.append(slots, REACH + 1).astype(float)
    edge[0], edge[-1] = -np.inf, np.inf
    z = ((edge[None] * WIDTH - offset[:, None]) - s * projection[:, None]) / spread
    chance = np.diff(_normal(np.clip(z, -40, 40)), axis=1)
    found, keys = np.ones(1), np.zeros(1, np.int64)
    for j, own in enumerate(chance):
        found = (found[:, None] * own[None]).ravel()
        keys = (keys[:, None] * len(slots) + np.arange(len(slots))[None]).ravel()
        order = np.argsort(-found, kind="stable")
        found, keys = found[order], keys[order]
        # What is cut here was less likely than what later is enough.
        enough = np.searchsorted(np.cumsum(found), 1 - (1 - target) / 4 / len(chance)) + 1
        found, keys = found[:enough], keys[:enough]
    keys = keys[: np.searchsorted(np.cumsum(found), target) + 1]
    return keys[:most]


def _unit(x: np.ndarray, norm: float | None) -> np.ndarray:
    """Data (norm: the largest) or queries as unit vectors with one more component."""
    if norm is None:
        return np.column_stack((x / np.sqrt((x * x).sum(1))[:, None], np.zeros(len(x))))
    x = x / norm
    return np.column_stack((x, np.sqrt(np.maximum(0, 1 - (x * x).sum(1)))))


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch, np.ndarray]]:
    size = column(batch, "vec").value_lengths().to_numpy()
    for dims in np.unique(size):
        some = batch.filter(pa.array(size == dims))
        yield int(dims), some, column(some, "vec").flatten().to_numpy().reshape(-1, dims)


def _indexed(batches: Iterator[pa.RecordBatch], functions: int, norm: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for dims, some, x in _by_length(batch):
            for table in range(TABLES):
                key = Hashes(table, dims, functions).keys(_unit(x, norm))
                where = pa.array(np.full(len(x), dims * TABLES + table, np.int64))
                yield pa.record_batch([where, pa.array(key), column(some, "id"), column(some, "vec")], ["tab", "bucket", "id", "vec"])


def _probed(batches: Iterator[pa.RecordBatch], functions: int, norm: float, first: bool) -> Iterator[pa.RecordBatch]:
    target = 1 - (1 - TARGET) ** (1 / TABLES)
    for batch in batches:
        for dims, some, x in _by_length(batch):
            least = column(some, "least").to_numpy(zero_copy_only=False)
            cosine = np.clip(np.nan_to_num(least) / norm / np.sqrt((x * x).sum(1)), -1, 1)
            for table in range(TABLES):
                hashes = Hashes(table, dims, functions)
                places = _unit(x, None) @ hashes.a.T
                for begin in range(0, len(x), 64):
                    some_places = zip(places[begin : begin + 64], cosine[begin : begin + 64], strict=True)
                    part = [probes(p, hashes.b, 0.9, 0.999, FIRST) if first else probes(p, hashes.b, s, target) for p, s in some_places]
                    rows, buckets = begin + np.repeat(np.arange(len(part)), [len(p) for p in part]), np.concatenate(part)
                    for sent in range(0, len(rows), SENT):
                        at = pa.array(rows[sent : sent + SENT])
                        where = pa.array(np.full(len(at), dims * TABLES + table, np.int64))
                        yield pa.record_batch(
                            [where, pa.array(buckets[sent : sent + SENT]), *(column(some, n).take(at) for n in ("id", "vec", "least"))],
                            ["tab", "bucket", "id", "vec", "least"],
                        )


def _best(q: np.ndarray, q_ids: np.ndarray, least: np.ndarray, x: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    score = q @ x.T
    score[ids[None] == q_ids[:, None]] = -np.inf
    floor_ = np.nan_to_num(least, nan=-np.inf)
    if score.shape[1] > k:
        floor_ = np.maximum(floor_, np.partition(score, -k, axis=1)[:, -k])
    row, at = np.nonzero((score >= (floor_ - 1e-9)[:, None]) & np.isfinite(score))
    exact = np.einsum("ij,ij->i", q[row], x[at])
    order = np.lexsort((ids[at], -exact, row))
    row, at, exact = row[order], at[order], exact[order]
    place = np.arange(len(row)) - np.searchsorted(row, row)
    keep = place < k
    return q_ids[row[keep]], ids[at[keep]], exact[keep]


def _met(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Rows come by (tab, bucket, part), data before probes."""
    held, x, ids = None, None, None
    for batch in batches:
        keys = np.stack([column(batch, n).to_numpy() for n in ("tab", "bucket", "part", "probe")], 1)
        new = np.flatnonzero(np.concatenate(([True], (keys[1:] != keys[:-1]).any(1)))) if len(keys) else []
        for a, b in zip(new, [*new[1:], len(keys)], strict=True):
            some = batch.slice(a, b - a)
            group = tuple(keys[a, :3])
            vec = column(some, "vec").flatten().to_numpy().reshape(b - a, -1)
            own = column(some, "id").to_numpy()
            if not keys[a, 3]:
                x, ids = (np.concatenate((x, vec)), np.concatenate((ids, own))) if held == group else (vec, own)
                held = group
            elif held == group:
                least = column(some, "least").to_numpy(zero_copy_only=False)
                for at in range(0, b - a, 256):
                    part = slice(at, at + 256)
                    found = _best(vec[part], own[part], least[part], x, ids, k)
                    yield pa.record_batch([pa.array(f) for f in found], ["query_id", "vec_id", "score"])


def _search(index: DataFrame, parts: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """The best k of each query over the buckets that it probes."""
    where = ["tab", "bucket"]
    part = F.pmod(F.xxhash64("id"), F.col("parts"))
    data = index.join(parts, where).select(*where, part.alias("part"), F.lit(0).alias("probe"), "id", "vec", F.lit(None).cast("double").alias("least"))
    probe = asked.join(parts, where).withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    rows = data.unionByName(probe.select(*where, "part", F.lit(1).alias("probe"), "id", "vec", "least"))
    met = rows.repartition(*where, "part").sortWithinPartitions(*where, "part", "probe")
    found = met.mapInArrow(lambda b: _met(b, k), "query_id long, vec_id long, score double")
    return _ranked(found, k)


def _compared_with_all(index: DataFrame, sparse: DataFrame, k: int) -> DataFrame:
    """The best k of each query over all vectors of its length: one table's vectors, as one bucket that is split in parts."""
    asked = sparse.select((F.size("vec") * TABLES).cast("long").alias("tab"), F.lit(0).cast("long").alias("bucket"), "id", "vec", "least")
    lengths = F.broadcast(asked.select("tab").distinct())
    every = index.join(lengths, "tab", "left_semi").withColumn("bucket", F.lit(0).cast("long"))
    parts = every.groupBy("tab", "bucket").agg(F.ceil(F.count("*") / PART).cast("long").alias("parts"))
    return _search(every, F.broadcast(parts), asked, k)  # a row for each length of vectors


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return once.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


@any_names("vec_id", "embedding")
def nearest(vectors: DataFrame, is_query: Column, k: int = K, id_column: str = "vec_id", vec_column: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the nearest k found for each query. is_query: a condition on ``id``."""
    fresh = lambda frame: materialize(frame, work_dir(vectors.sparkSession, "nearest"))
    norm = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda s, x: s + x * x))
    whole = fresh(usable(vectors, id_column, vec_column).withColumn("norm", norm).filter("norm > 0"))
    n, most = whole.agg(F.count("*"), F.max("norm")).first()
    functions = max(1, min(16, round(log2(max(n, 1) / BUCKET) / 2)))
    most = float(most or 1.0)
    index = fresh(whole.select("id", "vec").mapInArrow(lambda b: _indexed(b, functions, most), "tab long, bucket long, id long, vec array<double>"))
    parts = index.groupBy("tab", "bucket").agg(F.ceil(F.count("*") / PART).cast("long").alias("parts"))
    asked = whole.filter(is_query).select("id", "vec")
    kind = "tab long, bucket long, id long, vec array<double>, least double"

    def probing(queries: DataFrame, first: bool) -> DataFrame:
        return queries.mapInArrow(lambda b: _probed(b, functions, most, first), kind)

    parts = fresh(parts)
    early = fresh(_search(index, parts, probing(asked.withColumn("least", F.lit(None).cast("double")), True), k))
    kth = early.filter(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("least"))
    queries = fresh(asked.join(kth, "id", "left"))
    late = _search(index, parts, probing(queries.filter("least is not null"), False), k)
    found = early.drop("rank").unionByName(late.drop("rank"))
    sparse = queries.filter("least is null")
    if not sparse.isEmpty():
        found = found.unionByName(_compared_with_all(index, sparse, k).drop("rank"))
    both = _ranked(found, k)
    return both.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")

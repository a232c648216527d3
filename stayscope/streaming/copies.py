"""Exact removal of copies with bounded state, however late a copy comes.

The state of the query remembers keys for a short time only. What it lets pass is looked up, batch by
batch, among all keys that ever came, which lie in files: in runs, each with its keys, in folders by
hash, and a Bloom filter of them. The filter is in blocks of 32,768 bits, ten a key; a key has four
bits in one block, so looking it up is a join on the block's number. Most new keys are
told from all old ones by the filters alone. For the others the folders that could hold them are
read and compared in full, so a filter's mistake costs a look and never a booking.

Runs are merged like the digits of a counter: as soon as ``MERGED`` runs cover as many
batches each, they become one. So a key is written again once for each power of
``MERGED`` in the number of batches, and a lookup meets a few runs of every size.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from stayscope.session import settings
from stayscope.streaming.sinks import Versions

MERGED = 4
BLOCK_BITS = 32_768
BLOCK_KEYS = 3_200
BITS = 4
FILTER = "block long, bitmap binary"


def _hash(keys: Sequence[str], seed: int) -> Column:
    # hashes pass over nulls; with where they are, (1, null) and (null, 1) differ
    return F.xxhash64(F.lit(seed), *keys, *[F.col(k).isNull() for k in keys])


def _positions() -> list[Column]:
    return [F.shiftright("code", 15 * i).bitwiseAND(F.lit(BLOCK_BITS - 1)).cast("int") for i in range(BITS)]


def _is_set(bitmap: Column, position: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bitmap, (position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.call_function("shiftright", byte, position % 8).bitwiseAND(1) == 1


def _folder(run: str) -> str:
    return run.split(":")[0]


def due(batches: Sequence[int], merged: int = MERGED) -> int:
    """How many of the last runs are to become one; runs are given by the last batch of each, in order.

    A run covers the batches since the run before it.
    """
    covers = [b - a for a, b in zip([-1, *batches], batches, strict=False)]
    last = covers[-merged:]
    return merged if len(last) == merged and len(set(last)) == 1 else 0


@dataclass(frozen=True)
class SeenKeys:
    """All keys that batches have brought so far, at ``path``.

    ``buckets`` is the number of folders of a run. Its keys should be some tens of millions at most in
    each; it cannot change later. A batch that runs again after a failure is compared with the batches
    before it, and takes the place of its first run. Batch 0 starts anew.
    """

    path: str
    keys: Sequence[str]
    buckets: int = 64

    def admit(self, batch: DataFrame, batch_id: int) -> DataFrame:
        """The rows of ``batch`` whose key no earlier batch had, one for each key; from now on they are known."""
        spark, versions = batch.sparkSession, Versions(self.path)
        shown = versions.current(spark)
        earlier = {n: name for n, name in sorted(shown.items()) if n < batch_id}
        if any(n > batch_id for n in shown) and batch_id:
            raise ValueError(f"batch {batch_id} lies before the last one of {self.path}")
        hashed = batch.dropDuplicates(list(self.keys)).withColumns(
            {"place": _hash(self.keys, 0), "code": _hash(self.keys, 1)}
        )
        schema = StructType(hashed.schema.fields).add("bucket", IntegerType())
        if earlier:
            # it is read more than once from here on, and would be computed as often, with the state it comes from
            noted = versions.folder(f"w-{uuid.uuid4().hex}")
            hashed.write.parquet(noted)
            hashed = self._unseen(spark.read.schema(hashed.schema).parquet(noted), list(earlier.values()), schema)
        fresh = hashed
        name = self._write(spark, fresh)
        while n := due(list(earlier)):
            ids = list(earlier)[-n:]
            runs = [earlier.pop(i) for i in ids]
            earlier[ids[-1]] = self._write(spark, self._keys(spark, runs, schema))
        folders = {**earlier, batch_id: name}
        versions.publish(spark, folders)
        versions.clean(spark, {_folder(run) for run in (*shown.values(), *folders.values())})
        return self._keys(spark, [name], schema).drop("place", "code", "bucket")

    def _keys(self, spark: SparkSession, runs: Sequence[str], schema: StructType) -> DataFrame:
        reader = spark.read.schema(schema)  # a run without rows has no files
        frames = [reader.parquet(f"{Versions(self.path).folder(_folder(run))}/keys") for run in runs]
        return reduce(DataFrame.unionByName, frames)

    def _write(self, spark: SparkSession, rows: DataFrame) -> str:
        """Write rows with their hashes as a run: its folder, a colon, and the number of its filter's blocks."""
        name = f"v-{uuid.uuid4().hex}"
        folder = Versions(self.path).folder(name)
        with settings(spark, {"spark.sql.adaptive.enabled": "true"}):
            bucket = F.pmod("place", F.lit(self.buckets)).cast("int")
            dealt = rows.withColumn("bucket", bucket)
            dealt.hint("rebalance", "bucket").write.partitionBy("bucket").parquet(f"{folder}/keys")
            stored = self._keys(spark, [name], dealt.schema)
            blocks = stored.count() // BLOCK_KEYS + 1
            block = F.pmod(F.shiftright("place", 16), F.lit(blocks)).alias("block")
            bits = stored.select(block, F.explode(F.array(*_positions())).alias("bit"))
            filters = bits.groupBy("block").agg(F.bitmap_construct_agg("bit").alias("bitmap"))
            filters.write.parquet(f"{folder}/filters")
        return f"{name}:{blocks}"

    def _unseen(self, hashed: DataFrame, runs: list[str], schema: StructType) -> DataFrame:
        spark, versions = hashed.sparkSession, Versions(self.path)
        folder = versions.folder(f"w-{uuid.uuid4().hex}")
        filters = [
            spark.read.schema(FILTER).parquet(f"{versions.folder(_folder(run))}/filters").select(F.lit(i).alias("run"), "block", "bitmap")
            for i, run in enumerate(runs)
        ]
        every = reduce(DataFrame.unionByName, filters)
        sizes = F.array(*[F.lit(int(run.split(":")[1])) for run in runs])
        asked = hashed.select("place", "code", F.posexplode(sizes).alias("run", "blocks"))
        asked = asked.withColumn("block", F.pmod(F.shiftright("place", 16), F.col("blocks")).cast("long"))
        met = asked.join(every, ["run", "block"])
        hit = reduce(Column.__and__, [_is_set(F.col("bitmap"), p) for p in _positions()])
        with settings(spark, {"spark.sql.adaptive.enabled": "true"}):
            met.where(hit).select("place", "code").distinct().write.parquet(folder)
        suspected = spark.read.parquet(folder)
        # at most as many as there are folders of a run
        bucket = F.pmod("place", F.lit(self.buckets)).cast("int").alias("bucket")
        buckets = [r["bucket"] for r in suspected.select(bucket).distinct().collect()]
        if not buckets:
            return hashed
        old = self._keys(spark, runs, schema).where(F.col("bucket").isin(buckets))
        found = old.join(suspected, ["place", "code"], "left_semi").select("place", *self.keys).alias("o")
        same = [F.col(f"n.{k}").eqNullSafe(F.col(f"o.{k}")) for k in self.keys]
        return hashed.alias("n").join(found, [F.col("n.place") == F.col("o.place"), *same], "left_anti")

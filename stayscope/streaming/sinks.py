"""Sinks for results that change while the stream runs."""

from __future__ import annotations

import json
import uuid
from collections.abc import Collection, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayscope.session import file_system, settings


def stamped(frame: DataFrame) -> DataFrame:
    """Add the time of the batch as ``timestamp``."""
    return frame.withColumn("timestamp", F.current_timestamp())


@dataclass(frozen=True)
class Versions:
    """Folders below ``path``/data, and one small file that names those to be read.

    Every batch is written to a folder of its own. It counts once the file names it, and
    the file is replaced as a whole, by a rename, after the folder is complete. So a reader
    sees a batch whole or not at all, also after a crash, and no one lists old folders.
    """

    path: str

    def folder(self, name: str) -> str:
        return f"{self.path}/data/{name}"

    def write(self, batch: DataFrame) -> str:
        """Write a batch in files of a fair size; returns its folder.

        It comes in as many parts as there are state partitions, most of them tiny. Stateful
        queries turn AQE off; writing their result may use it.
        """
        name = f"v-{uuid.uuid4().hex}"
        with settings(batch.sparkSession, {"spark.sql.adaptive.enabled": "true"}):
            batch.hint("rebalance").write.parquet(self.folder(name))
        return name

    def current(self, spark: SparkSession) -> dict[int, str]:
        """Folders by number of batch, in order."""
        system, file = file_system(spark, f"{self.path}/current.json")
        if not system.exists(file):
            return {}
        stream = system.open(file)
        try:
            text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return {int(batch_id): name for batch_id, name in json.loads(text).items()}

    def publish(self, spark: SparkSession, folders: Mapping[int, str]) -> None:
        system, file = file_system(spark, f"{self.path}/current.json")
        _, fresh = file_system(spark, f"{self.path}/next-{uuid.uuid4().hex}.json")
        stream = system.create(fresh)
        stream.write(json.dumps(folders).encode())
        stream.close()
        hadoop = spark._jvm.org.apache.hadoop.fs
        rename = getattr(hadoop, "Options$Rename")
        options = spark.sparkContext._gateway.new_array(rename, 1)
        options[0] = rename.OVERWRITE
        configuration = spark._jsc.hadoopConfiguration()
        hadoop.FileContext.getFileContext(file.toUri(), configuration).rename(fresh, file, options)

    def clean(self, spark: SparkSession, keep: Collection[str]) -> None:
        """Delete all other folders, among them those that a failed batch left."""
        system, root = file_system(spark, f"{self.path}/data")
        for status in system.listStatus(root):
            if status.getPath().getName() not in keep:
                system.delete(status.getPath(), True)

    def read(self, spark: SparkSession, folders: Mapping[int, str] | None = None) -> DataFrame:
        folders = folders or self.current(spark)
        if not folders:
            raise FileNotFoundError(f"no batch has been published at {self.path}")
        return spark.read.parquet(*map(self.folder, folders.values()))


@dataclass(frozen=True)
class ChangeTable:
    """A Parquet table of the rows that changed, for queries in update mode.

    A batch that is run again after a failure takes the place of its first run. Batch 0,
    with which every new checkpoint begins, starts the table anew. Reading takes the latest
    row per key.

    Every ``merge_every``-th batch writes the latest row of all keys, not just of the
    changed ones, and readers need no older folder from then on. What it replaces is
    deleted at the merge after it, so a reader has that long to finish.
    """

    path: str
    keys: Sequence[str]
    merge_every: int = 100

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark, versions = batch.sparkSession, Versions(self.path)
        shown = versions.current(spark)
        earlier = {n: name for n, name in shown.items() if n <= batch_id} if batch_id else {}
        if batch_id and shown and not earlier:
            raise ValueError(f"batch {batch_id} lies before the last merge of {self.path}")
        numbered = batch.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        merges = batch_id % self.merge_every == 0
        if merges and earlier:
            # run again, a merge finds its own first result, which is older than the batch
            number = F.least("batch_id", F.lit(batch_id - 1).cast("bigint"))
            stored = versions.read(spark, earlier).withColumn("batch_id", number)
            latest = self._latest(stored.unionByName(numbered))
            numbered = latest.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        kept = {} if merges else earlier
        folders = {**kept, batch_id: versions.write(numbered)}
        versions.publish(spark, folders)
        if merges:
            versions.clean(spark, {*shown.values(), *folders.values()})

    def read(self, spark: SparkSession) -> DataFrame:
        return self._latest(Versions(self.path).read(spark))

    def _latest(self, changes: DataFrame) -> DataFrame:
        columns = [c for c in changes.columns if c not in (*self.keys, "batch_id")]
        # as one struct, with the batch first, the latest row is also the largest
        version = F.struct("batch_id", *columns)
        latest = changes.groupBy(*self.keys).agg(F.max(version).alias("latest"))
        return latest.select(*self.keys, *[F.col("latest")[c].alias(c) for c in columns])


@dataclass(frozen=True)
class SumTable:
    """A Parquet table of counts to which every batch adds, for queries in append mode.

    A batch that is run again after a failure takes the place of its first run, so it is
    added once. Batch 0, with which every new checkpoint begins, starts the table anew. Reading adds
    up the rows of a key, and takes the largest of its ``maxima``.

    Every ``merge_every``-th batch replaces the batches before it by their sums. They are final, as a
    batch starts only when those before it are done; the batch itself stays apart until the next merge.
    """

    path: str
    keys: Sequence[str]
    counters: Sequence[str]
    maxima: Sequence[str] = ()
    merge_every: int = 100

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark, versions = batch.sparkSession, Versions(self.path)
        shown = versions.current(spark)
        earlier = {n: name for n, name in shown.items() if n < batch_id}
        if batch_id and shown and not earlier and batch_id not in shown:
            raise ValueError(f"batch {batch_id} lies before the last merge of {self.path}")
        merges = batch_id % self.merge_every == 0
        if merges and len(earlier) > 1:
            earlier = {batch_id - 1: versions.write(self._sums(versions.read(spark, earlier)))}
        folders = {**earlier, batch_id: versions.write(batch.select(*self.keys, *self.counters, *self.maxima))}
        versions.publish(spark, folders)
        if merges:
            versions.clean(spark, {*shown.values(), *folders.values()})

    def read(self, spark: SparkSession) -> DataFrame:
        return self._sums(Versions(self.path).read(spark))

    def before(self, spark: SparkSession, batch_id: int) -> DataFrame | None:
        """What the batches before ``batch_id`` have added; None if there are none."""
        versions = Versions(self.path)
        earlier = {n: name for n, name in versions.current(spark).items() if n < batch_id}
        return self._sums(versions.read(spark, earlier)) if earlier else None

    def added(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """What one batch added, until a merge has taken it in."""
        versions = Versions(self.path)
        return versions.read(spark, {batch_id: versions.current(spark)[batch_id]})

    def _sums(self, parts: DataFrame) -> DataFrame:
        sums = [F.sum(name).alias(name) for name in self.counters]
        return parts.groupBy(*self.keys).agg(*sums, *[F.max(name).alias(name) for name in self.maxima])


@dataclass(frozen=True)
class SnapshotTable:
    """A Parquet table of the whole result, for queries in complete mode.

    The snapshot before stays until the next one is published, for those who still read it.
    """

    path: str

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark, versions = batch.sparkSession, Versions(self.path)
        shown = versions.current(spark)
        folders = {batch_id: versions.write(batch)}
        versions.publish(spark, folders)
        versions.clean(spark, {*shown.values(), *folders.values()})

    def read(self, spark: SparkSession) -> DataFrame:
        return Versions(self.path).read(spark)


@dataclass(frozen=True)
class DocumentIndex:
    """A document index behind a deployed connector.

    Rows get an id made of their keys in ``doc_id``. With the connector told to use it,
    a row that is sent again replaces the one before.
    """

    target: str
    keys: Sequence[str]
    fmt: str = "es"
    id_option: str = "es.mapping.id"
    options: Mapping[str, str] | None = None

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        options = {**(self.options or {}), self.id_option: "doc_id"}
        rows = with_doc_id(stamped(batch), self.keys)
        rows.write.format(self.fmt).mode("append").options(**options).save(self.target)


def with_doc_id(frame: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add ``doc_id``, the same for rows with the same keys and for no others.

    Nulls stay part of the key: JSON leaves them out, so null and "" differ.
    """
    return frame.withColumn("doc_id", F.sha2(F.to_json(F.struct(*keys)), 256))

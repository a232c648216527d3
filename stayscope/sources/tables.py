"""Tables that are replaced as a whole, or partition by partition, in one step."""

from __future__ import annotations

import json
import uuid
from collections.abc import Collection, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stayscope.session import file_system

COMMIT = "commit_id"
#: File systems that create a file if there is none, in one step, but rename by copying.
STORES = ("s3", "s3a", "gs", "abfs", "abfss", "wasb", "oss")


class ConflictError(RuntimeError):
    """Someone else has published a version since the one that was read."""


@dataclass(frozen=True)
class Version:
    """What a manifest says: its number, the folder of each partition, the schema, and notes of the writer."""

    number: int = 0
    folders: Mapping[str, str] = field(default_factory=dict)
    schema: str | None = None
    notes: Mapping[str, object] = field(default_factory=dict)


@dataclass(frozen=True)
class AtomicTable:
    """A Parquet table below ``path`` that readers see whole, in some version, whatever happens to its writers.

    A write puts files into folders of its own, below those of their partitions. They count once a
    manifest names them: a small numbered file, which is created only if no other has its number. So of
    two writers that start from one version one succeeds and the other gets a ``ConflictError``, and a
    write that is lost on its way leaves the version before. Neither needs a rename of data.

    ``partition_by`` names the columns of the folders. Partitions should be few enough for one file to list.
    """

    path: str
    partition_by: Sequence[str] = ()

    def current(self, spark: SparkSession) -> Version:
        """The newest version; number 0 if there is none."""
        system, folder = file_system(spark, f"{self.path}/manifests")
        if not system.exists(folder):
            return Version()
        names = [status.getPath().getName() for status in system.listStatus(folder)]
        numbers = sorted((int(n.split(".")[0]) for n in names if n.endswith(".json") and n[0].isdigit()), reverse=True)
        for number in numbers:
            try:
                return self.version(spark, number)
            except json.JSONDecodeError:  # a manifest that was lost while it was written
                continue
        return Version()

    def version(self, spark: SparkSession, number: int) -> Version:
        """An earlier version, as long as ``vacuum`` has left it."""
        if number == 0:
            return Version()
        system, file = file_system(spark, self._manifest(number))
        stream = system.open(file)
        try:
            text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return Version(**json.loads(text))

    def replace(self, frame: DataFrame, notes: Mapping[str, object] | None = None, since: Version | None = None) -> Version:
        """Publish ``frame`` as the whole table."""
        return self._publish(frame, since, lambda old, new: new, notes)

    def replace_partitions(self, frame: DataFrame, notes: Mapping[str, object] | None = None, since: Version | None = None) -> Version:
        """Publish ``frame`` in place of the partitions that it has rows of; the others stay."""
        if not self.partition_by:
            raise ValueError(f"{self.path} has no partitions")
        return self._publish(frame, since, lambda old, new: {**old, **new}, notes)

    def drop_partitions(self, spark: SparkSession, partitions: Collection[str], since: Version | None = None) -> Version:
        """Publish the table without some partitions, given as ``Version.folders`` has them."""
        old = since or self.current(spark)
        left = {p: f for p, f in old.folders.items() if p not in partitions}
        return self._commit(spark, Version(old.number + 1, left, old.schema, old.notes))

    def read(self, spark: SparkSession, version: Version | None = None, partitions: Collection[str] | None = None) -> DataFrame:
        """The newest version, or a given one; only some of its partitions if they are given."""
        version = version or self.current(spark)
        if version.schema is None:
            raise FileNotFoundError(f"nothing has been published at {self.path}")
        schema = StructType.fromJson(json.loads(version.schema))
        folders = [f for p, f in version.folders.items() if partitions is None or p in partitions]
        if not folders:
            return spark.createDataFrame([], schema)
        # partition values are read as they were written, not as what they look like
        full = StructType(schema.fields).add(COMMIT, "string")
        reader = spark.read.schema(full).option("basePath", f"{self.path}/data")
        return reader.parquet(*[f"{self.path}/data/{f}" for f in folders]).select(*[f"`{c}`" for c in schema.names])

    def vacuum(self, spark: SparkSession, keep: int = 2) -> None:
        """Delete what the last ``keep`` versions do not use; not while others write or read older ones."""
        newest = self.current(spark).number
        used = {f for n in range(max(1, newest - keep + 1), newest + 1) for f in self.version(spark, n).folders.values()}
        system, _ = file_system(spark, self.path)
        for folder, path in self._written(spark, "*").items():
            if folder not in used:
                system.delete(path, True)
        for number in range(newest - keep, 0, -1):
            _, file = file_system(spark, self._manifest(number))
            if not system.delete(file, False):
                break

    def _manifest(self, number: int) -> str:
        return f"{self.path}/manifests/{number:012d}.json"

    def _written(self, spark: SparkSession, commit: str) -> dict:
        """Folders of a commit, or of all, below ``data``, with their full paths."""
        depth = "*/" * len(self.partition_by)
        system, root = file_system(spark, f"{self.path}/data")
        _, pattern = file_system(spark, f"{self.path}/data/{depth}{COMMIT}={commit}")
        prefix = f"{root.toUri().getPath()}/"
        return {s.getPath().toUri().getPath().removeprefix(prefix): s.getPath() for s in system.globStatus(pattern) or []}

    def _publish(self, frame: DataFrame, since: Version | None, merged, notes) -> Version:
        spark = frame.sparkSession
        old = since or self.current(spark)
        commit = uuid.uuid4().hex
        rows = frame.hint("rebalance", *self.partition_by) if self.partition_by else frame
        rows.withColumn(COMMIT, F.lit(commit)).write.mode("append").partitionBy(*self.partition_by, COMMIT).parquet(f"{self.path}/data")
        new = {f.rsplit("/", 1)[0] if "/" in f else "": f for f in self._written(spark, commit)}
        schema = StructType([f for f in frame.schema if f.name not in self.partition_by])
        for name in self.partition_by:
            schema = schema.add(name, frame.schema[name].dataType)
        return self._commit(spark, Version(old.number + 1, merged(dict(old.folders), new), schema.json(), {**old.notes, **(notes or {})}))

    def _commit(self, spark: SparkSession, version: Version) -> Version:
        """Create the manifest if no other has its number."""
        text = json.dumps(version.__dict__, default=dict).encode()
        system, file = file_system(spark, self._manifest(version.number))
        java = spark._jvm.org.apache.hadoop.fs
        try:
            if file.toUri().getScheme() in STORES:
                stream = system.create(file, False)
                stream.write(text)
                stream.close()
            else:
                _, fresh = file_system(spark, f"{self.path}/manifests/next-{uuid.uuid4().hex}")
                stream = system.create(fresh)
                stream.write(text)
                stream.close()
                options = spark.sparkContext._gateway.new_array(getattr(java, "Options$Rename"), 0)
                java.FileContext.getFileContext(file.toUri(), spark._jsc.hadoopConfiguration()).rename(fresh, file, options)
        except Exception as error:
            if "AlreadyExists" in str(error) or "exists" in str(error):
                raise ConflictError(f"version {version.number} of {self.path} is there already") from error
            raise
        return version

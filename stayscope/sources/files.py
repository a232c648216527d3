"""Tables in files."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from stayscope.session import file_system


def read_table(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    schema: StructType | str | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """A batch of records; without ``schema`` the files describe themselves.

    ``fmt`` is any format the session knows: ``avro`` needs its package deployed.
    """
    reader = spark.read.format(fmt).options(**(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def read_table_stream(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    fmt: str = "parquet",
    files_per_trigger: int | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Records as their files arrive, with a schema fixed beforehand."""
    reader = spark.readStream.format(fmt).schema(schema).options(**(options or {}))
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def write_table(
    frame: DataFrame,
    path: str,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    options: Mapping[str, str] | None = None,
) -> None:
    """Replace the table at ``path``.

    Rows of a partitioned table are brought together by partition first, or every task
    would write a small file to every folder. AQE spreads a large partition over several
    tasks, and small ones over fewer.
    """
    if partition_by:
        frame = frame.hint("rebalance", *partition_by)
    writer = frame.write.format(fmt).mode("overwrite").options(**(options or {}))
    writer.partitionBy(*partition_by).save(path)


def append_files(frame: DataFrame, path: str, least: int, *keys: str) -> int:
    """Append to the Parquet files at ``path``, a file for each task; returns how many came.

    Rows stay in the tasks that have them, so files are as large as what a task reads. Only fewer than
    ``least`` tasks are dealt to as many, by ``keys``.
    """
    system, folder = file_system(frame.sparkSession, path)

    def count() -> int:
        found = system.listStatus(folder) if system.exists(folder) else []
        return sum(status.getPath().getName().startswith("part-") for status in found)

    before = count()
    if frame.rdd.getNumPartitions() < least:
        frame = frame.repartition(least, *keys)
    frame.write.mode("append").parquet(path)
    return count() - before


def archived(folder: str) -> dict[str, str]:
    """Options of a stream of files: what has been processed is moved to ``folder``, so that listings stay short.

    A file moves after the micro-batch behind the one that read it is done, when no restart needs it any more.
    The folder must not match the path that is read.
    """
    return {"cleanSource": "archive", "sourceArchiveDir": folder}

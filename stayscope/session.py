"""Session helpers: the shared working folder and settings for large runs."""

from __future__ import annotations

import math
import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

MIB = 1024 * 1024
PARTITION = 64 * MIB
MAX_SCAN_TASKS = 100_000
MAX_SHUFFLE_TASKS = 40_000


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder under ``spark.checkpoint.dir``, which all executors share.

    Only a local session may go without that setting; it then uses the temporary
    folder of the one machine it runs on.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.gettempdir()
    return f"{root.rstrip('/')}/stayscope/{label}-{uuid.uuid4().hex}"


def materialize(frame: DataFrame, path: str, batch_rows: int | None = None) -> DataFrame:
    """Write ``frame`` as Parquet and read it back, so that later plans start there.

    The shuffles that made it are not needed any more then, and their files go at once,
    not when the driver happens to collect its garbage. ``batch_rows`` is how many rows Python
    gets at a time, where they are large.
    """
    values = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
    if batch_rows:
        values["spark.sql.execution.arrow.maxRecordsPerBatch"] = str(batch_rows)
    with settings(frame.sparkSession, values):
        frame.write.mode("overwrite").parquet(path)
    return frame.sparkSession.read.parquet(path)


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system that holds ``path``, and the path in full."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return system, system.makeQualified(target)


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files below ``path``, which may be a pattern of folders."""
    system, target = file_system(spark, path)
    found = system.globStatus(target) or []
    return sum(system.getContentSummary(status.getPath()).getLength() for status in found)


@contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Apply runtime settings for the duration of a block."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def settings_for(input_bytes: int, cores: int) -> dict[str, str]:
    """Builder settings for a run over ``input_bytes`` of booking files.

    About a quarter of a booking record (five of its twenty columns) is shuffled, in
    partitions that start at 64 MiB; AQE merges the small ones. The driver keeps a bit
    per pair of scan and shuffle task, so both numbers are bounded: beyond some terabytes
    the tasks grow instead, to 1 GiB scanned and 600 MiB shuffled at 100 TB, which Spark
    sorts and spills within a task.

    Joins broadcast what a finished stage has measured, never what the planner guesses:
    the guess for a decoded or aggregated table can be off by orders of magnitude. Where
    every measured partition of the smaller side fits a task, it is hashed there instead
    of sorting both sides. A task needs about 300 MiB of memory for that.
    """
    shuffled = input_bytes // 4
    partitions = min(math.ceil(shuffled / PARTITION), MAX_SHUFFLE_TASKS)
    scanned = max(128 * MIB, input_bytes // MAX_SCAN_TASKS)
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(PARTITION),
        "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": str(PARTITION),
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * MIB),
        "spark.sql.files.maxPartitionBytes": str(scanned),
        "spark.sql.shuffle.partitions": str(max(cores, partitions)),
        "spark.sql.session.timeZone": "UTC",
    }

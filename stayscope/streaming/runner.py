"""Start, run out and configure streaming queries."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from stayscope.session import settings

AVAILABLE_NOW = {"availableNow": True}

# Keeps state on the disks of the executors instead of in their heaps, and writes
# changes instead of snapshots at every trigger. A store sets no space aside in advance, which
# would be about 5 MB for each.
ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}

# The shuffles of a micro-batch go when it is done, not when the driver happens to collect its garbage.
CLEANED = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


@dataclass(frozen=True)
class Target:
    """A built-in or deployed streaming sink."""

    fmt: str
    path: str | None = None
    options: Mapping[str, str] = field(default_factory=dict)
    name: str | None = None


BatchWriter = Callable[[DataFrame, int], None]


def run_stream(
    frame: DataFrame,
    sink: Target | BatchWriter,
    checkpoint: str | None,
    mode: str = "append",
    trigger: Mapping[str, object] | None = None,
    state: Mapping[str, str] = ROCKSDB,
    partitions: int | None = None,
) -> StreamingQuery:
    """Start a query and return its handle; it never blocks.

    ``partitions`` is the number of state partitions, which a query keeps for as long as
    it keeps its checkpoint; the default is that of the session's shuffles.

    ``sink`` is a ``Target``, or a function of (batch, batch id) that is called again
    with the same id after a failure and so must replace what it wrote before.
    """
    writer = frame.writeStream.outputMode(mode)
    if checkpoint is not None:
        writer = writer.option("checkpointLocation", checkpoint)
    if trigger:
        writer = writer.trigger(**trigger)
    if isinstance(sink, Target):
        writer = writer.format(sink.fmt).options(**sink.options)
        if sink.name:
            writer = writer.queryName(sink.name)
        path = sink.path
    else:
        writer = writer.foreachBatch(sink)
        path = None
    shuffles = {"spark.sql.shuffle.partitions": str(partitions)} if partitions else {}
    with settings(frame.sparkSession, {**CLEANED, **state, **shuffles}):
        return writer.start(path)


def run_out(query: StreamingQuery) -> None:
    """Wait until a query with an ending trigger is done; raises if it failed."""
    query.awaitTermination()

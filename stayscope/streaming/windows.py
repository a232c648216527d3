"""Counts over time."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayscope.streaming.sinks import SumTable


def windowed_count(
    frame: DataFrame, event_time: str, size: str = "5 seconds", delay: str = "5 seconds"
) -> DataFrame:
    """Rows per tumbling window of ``event_time``, as ``window`` and ``count``.

    Run in append mode, a window comes out once, when an event later than its end plus
    ``delay`` has been seen; rows that arrive after that are dropped.
    """
    late = frame.withWatermark(event_time, delay)
    return late.groupBy(F.window(event_time, size)).count()


@dataclass(frozen=True)
class AmendedWindows:
    """Counts per window at ``path`` that late events amend, as the sink of a query in append mode.

    ``windowed_count`` keeps open windows as state and drops what comes after they closed. Here each micro-batch
    is counted by window and added to a table of sums, so there is no state, nothing is dropped, and a
    window that is closed already gets a correction: the rows that a batch added (``changes``). How many
    events came late, after their window closed, is counted beside. A window is closed once an event later than its
    end plus ``delay`` has come in an earlier micro-batch, as a watermark has it.

    Events without a time have no window.
    """

    path: str
    event_time: str
    size: str = "5 seconds"
    delay: str = "5 seconds"
    merge_every: int = 100

    @property
    def table(self) -> SumTable:
        return SumTable(self.path, ["start", "end"], ["count", "late"], ["newest"], self.merge_every)

    def _watermark(self, counted: DataFrame):
        """The newest event's time less the delay, as one value."""
        return counted.agg(F.max("newest") - F.expr(f"INTERVAL {self.delay}")).first()[0]

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        before = self.table.before(batch.sparkSession, batch_id)
        closed = self._watermark(before) if before is not None else None
        time = batch.select(F.col(self.event_time).cast("timestamp").alias("at"))
        windows = time.select("at", F.window("at", self.size).alias("window")).select("at", "window.start", "window.end")
        late = F.coalesce(F.col("end") <= F.lit(closed).cast("timestamp"), F.lit(False))
        counted = windows.groupBy("start", "end").agg(
            F.count("*").alias("count"), F.count_if(late).alias("late"), F.max("at").alias("newest")
        )
        self.table(counted, batch_id)

    def read(self, spark: SparkSession) -> DataFrame:
        """start, end, count, late and whether the window is closed."""
        counted = self.table.read(spark)
        closed = F.coalesce(F.col("end") <= F.lit(self._watermark(counted)).cast("timestamp"), F.lit(False))
        return counted.select("start", "end", "count", "late", closed.alias("closed"))

    def changes(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """What a batch added to which window, corrections of closed ones (``late`` above 0) among them."""
        return self.table.added(spark, batch_id).select("start", "end", "count", "late")

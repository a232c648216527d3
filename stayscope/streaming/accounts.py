"""What a run took in and what it left out, counted while it runs.

Counts are observed on rows that pass through a query anyway (``DataFrame.observe``), so nothing is
read twice; a batch takes an ``Observation`` for its name. ``enrich_with_days`` observes bookings without
weather. ``Accounts`` listens to the queries of a session and adds up what their micro-batches report.
"""

from __future__ import annotations

import json
from collections import defaultdict
from collections.abc import Mapping
from threading import Lock

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener


def null_keys(*columns: str) -> Column:
    """Rows in which any of the keys is null."""
    missing = [F.col(c).isNull() for c in columns]
    return F.count_if(F.greatest(*[m.cast("int") for m in missing], F.lit(0)) == 1)


def observed_bookings(bookings: DataFrame, name: str | Observation = "bookings") -> DataFrame:
    """Raw bookings, with their number and that of those which can match no weather as ``name``."""
    return bookings.observe(name, F.count("*").alias("rows"), null_keys("hotel_id", "srch_ci").alias("null_keys"))


def observed_messages(messages: DataFrame, name: str | Observation = "messages", column: str = "value") -> DataFrame:
    """Messages of a topic, with the number of those that are no JSON objects, and of those without text."""
    text = F.col(column).cast("string")
    shape = F.schema_of_variant(F.try_parse_json(text))
    stray = text.isNotNull() & ~F.coalesce(shape.startswith("OBJECT<"), F.lit(False))
    return messages.observe(
        name, F.count("*").alias("rows"), F.count_if(text.isNull()).alias("empty"), F.count_if(stray).alias("malformed")
    )


def lost_messages(source: Mapping) -> int:
    """Messages between the offsets of a micro-batch that were not there any more, for a source with offsets by partition.

    A topic whose head has expired is read from what is left; the offsets still tell how many there were.
    """
    try:
        ends = json.loads(source.get("endOffset") or "null")
        starts = json.loads(source.get("startOffset") or "null")
    except (TypeError, ValueError):
        return 0
    if not isinstance(ends, dict) or not isinstance(starts, dict):
        return 0
    asked = 0
    for topic, parts in ends.items():
        if not isinstance(parts, dict):
            return 0
        asked += sum(end - starts.get(topic, {}).get(part, end) for part, end in parts.items())
    return max(0, asked - int(source.get("numInputRows", 0)))


class Accounts(StreamingQueryListener):
    """Totals by name of observation and of counter, over all micro-batches of the session's queries.

    A micro-batch that runs again after a failure is counted when it is done. Besides what is observed
    there are ``late`` (rows dropped by watermarks) and ``lost`` (messages that had expired).
    """

    def __init__(self):
        self._totals: dict[str, dict[str, int]] = defaultdict(lambda: defaultdict(int))
        self._lock = Lock()

    def listen(self, spark: SparkSession) -> Accounts:
        spark.streams.addListener(self)
        return self

    def stop(self, spark: SparkSession) -> None:
        spark.streams.removeListener(self)

    @property
    def totals(self) -> dict[str, dict[str, int]]:
        with self._lock:
            return {name: dict(counters) for name, counters in self._totals.items()}

    def add(self, name: str, counters: Mapping[str, int]) -> None:
        with self._lock:
            for counter, n in counters.items():
                self._totals[name][counter] += n or 0

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        progress = event.progress
        for name, row in (progress.observedMetrics or {}).items():
            self.add(name, row.asDict())
        late = sum(state.numRowsDroppedByWatermark for state in progress.stateOperators)
        lost = sum(lost_messages(json.loads(source.json)) for source in progress.sources)
        self.add("queries", {"late": late, "lost": lost})

"""Popular stays while both bookings and weather arrive.

Neither side is fixed: a booking waits in the state of the join until weather for its
hotel-day comes, and weather waits for bookings. So what is counted depends on what has arrived, not
on the order in which it did, and new weather needs no restart. Each match comes out once and
is counted into a table of sums, which needs no state.

The weather that decides is whether a hotel-day has a reading above the threshold, and under
which hotel names; a mean would change with every further reading. Readings beyond
the first of a hotel-day and name change nothing and are dropped before the join.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stayscope.categories import STAY_CATEGORIES, StayCategory
from stayscope.operators.bookings import BOOKING_KEYS, project_bookings, with_stay_days
from stayscope.operators.classify import classify
from stayscope.operators.counts import category_counts
from stayscope.operators.enrich import booking_salt, drop_copies, join_days
from stayscope.operators.popular import GRAINS, with_popular
from stayscope.operators.weather import DAY_KEYS, MIN_TMPR, above_temperature, project_weather
from stayscope.streaming.runner import ROCKSDB, BatchWriter, run_stream
from stayscope.streaming.sinks import SumTable

# One store for each partition of the join instead of four.
STATE = {**ROCKSDB, "spark.sql.streaming.join.stateFormatVersion": "3"}
# Counting the rows of the state costs a lookup for each row that is put there. As no watermark empties a state
# without bound, a micro-batch without data would only write it again.
UNBOUNDED = {
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}
# A query that ends is started again, and then reads its state back: files of a snapshot are copied, while each
# row of the changes would be put into the store anew.
SNAPSHOTS = {"spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "false"}
ENDING = {"availableNow", "once"}


def arriving_days(weather: DataFrame, min_tmpr: float = MIN_TMPR) -> DataFrame:
    """Each hotel-day and name of a stream of readings once, as soon as a reading is above ``min_tmpr``."""
    readings = above_temperature(project_weather(weather), min_tmpr).select(*DAY_KEYS)
    known = readings.where("Id IS NOT NULL AND wthrDate IS NOT NULL")
    timed = known.withColumn("seen", F.current_timestamp()).withWatermark("seen", "0 seconds")
    return timed.dropDuplicates(list(DAY_KEYS))


def live_preferences(
    bookings: DataFrame,
    weather: DataFrame,
    min_tmpr: float = MIN_TMPR,
    categories: Sequence[StayCategory] = STAY_CATEGORIES,
    patience: str | None = None,
    copies_within: str | None = None,
    join_salts: int = 1,
    copy_salts: int = 0,
) -> DataFrame:
    """Classified bookings of two streams, each once per hotel name of its day; for append mode.

    ``patience``, a time like "30 days", bounds how long a booking waits: until the weather that
    arrives is that much younger than the booking. Without it bookings wait for ever, and
    the state holds all of them. The weather is always kept, a row for each hotel-day and name.

    ``copies_within`` bounds the memory of copies, ``join_salts`` and ``copy_salts`` split hot
    hotel-days and bookings, as for ``enrich_with_days``. Copies go before the join, so that each booking waits once.
    """
    narrow = project_bookings(bookings).where("hotel_id IS NOT NULL AND srch_ci IS NOT NULL")
    timed = narrow.withColumn("arrival", F.current_timestamp())
    timed = timed.withWatermark("arrival", copies_within or "0 seconds")
    timed = timed.withColumn("salt", booking_salt(max(join_salts, copy_salts, 1)))
    if copy_salts > 1:
        timed = drop_copies(timed, [*BOOKING_KEYS, "salt"], bool(copies_within))
    once = drop_copies(timed, BOOKING_KEYS, bool(copies_within))
    waits = F.col("arrival") >= F.col("seen") - F.expr(f"INTERVAL {patience}") if patience else None
    matched = join_days(once, arriving_days(weather, min_tmpr), join_salts, waits)
    return classify(with_stay_days(matched), categories)


def counts_table(path: str, grain: str, categories: Sequence[StayCategory] = STAY_CATEGORIES) -> SumTable:
    """The table that ``counting`` adds to."""
    level = GRAINS[grain]
    return SumTable(path, level.keys, list(level.counters(categories)))


def counting(
    table: SumTable, grain: str, categories: Sequence[StayCategory] = STAY_CATEGORIES
) -> BatchWriter:
    """A sink that adds the counts of classified bookings, of which none comes twice, to ``table``."""
    level = GRAINS[grain]

    def write(batch: DataFrame, batch_id: int) -> None:
        table(category_counts(batch, level.keys, level.counters(categories)), batch_id)

    return write


def popular_so_far(
    spark: SparkSession, table: SumTable, grain: str, categories: Sequence[StayCategory] = STAY_CATEGORIES
) -> DataFrame:
    """Counts and most popular category of what has been added up."""
    return GRAINS[grain].visible(with_popular(table.read(spark), categories))


def start_live(
    bookings: DataFrame,
    weather: DataFrame,
    path: str,
    checkpoint: str,
    grain: str = "hotel_children",
    trigger: Mapping[str, object] | None = None,
    partitions: int | None = None,
    categories: Sequence[StayCategory] = STAY_CATEGORIES,
    **options,
) -> StreamingQuery:
    """Keep the counts per group at ``path`` up to date; ``popular_so_far`` reads them.

    ``options`` are those of ``live_preferences``. The progress of the query has the number of rows in its state
    only if ``patience`` or ``copies_within`` bounds them. With a ``trigger`` that ends, the state is written as
    snapshots, which the next start reads faster; a checkpoint may change between triggers.
    """
    found = live_preferences(bookings, weather, categories=categories, **options)
    sink = counting(counts_table(path, grain, categories), grain, categories)
    bounded = options.get("patience") or options.get("copies_within")
    state = STATE if bounded else {**STATE, **UNBOUNDED}
    if ENDING.intersection(trigger or ()):
        state = {**state, **SNAPSHOTS}
    return run_stream(found, sink, checkpoint, "append", trigger, state, partitions)

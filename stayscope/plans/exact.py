"""Popular stays of a stream that counts each booking once, for ever, with bounded state.

The query itself remembers bookings for a short time, which catches the copies that come in quick
succession. ``SeenKeys`` has all older ones in files. Counts are added up in a table, so there is no state
for them either.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stayscope.categories import STAY_CATEGORIES, StayCategory
from stayscope.operators.bookings import BOOKING_KEYS, project_bookings
from stayscope.operators.classify import classify
from stayscope.operators.enrich import booking_salt, drop_copies, enrich_with_days, with_weather
from stayscope.plans.live import counting, counts_table
from stayscope.plans.stream import StaticDays
from stayscope.streaming.copies import SeenKeys
from stayscope.streaming.runner import run_stream


def recent_once(bookings: DataFrame, copies_within: str, copy_salts: int = 0) -> DataFrame:
    """Bookings without the copies that arrive within a time of each other, and without null keys.

    The time is that of the micro-batches; "0 seconds" leaves all but those of one micro-batch to be looked up.
    """
    narrow = project_bookings(bookings).where("hotel_id IS NOT NULL AND srch_ci IS NOT NULL")
    timed = narrow.withColumn("arrival", F.current_timestamp()).withWatermark("arrival", copies_within)
    if copy_salts > 1:
        salted = timed.withColumn("salt", booking_salt(copy_salts))
        timed = drop_copies(salted, [*BOOKING_KEYS, "salt"], within_watermark=True).drop("salt")
    return drop_copies(timed, BOOKING_KEYS, within_watermark=True).drop("arrival")


def start_exact(
    bookings: DataFrame,
    days: StaticDays,
    path: str,
    checkpoint: str,
    grain: str = "hotel_children",
    copies_within: str = "1 hour",
    copy_salts: int = 0,
    buckets: int = 64,
    trigger: Mapping[str, object] | None = None,
    partitions: int | None = None,
    categories: Sequence[StayCategory] = STAY_CATEGORIES,
) -> StreamingQuery:
    """Keep the counts per group at ``path``/counts, and the bookings that were counted at ``path``/seen.

    ``plans.live.popular_so_far`` reads the counts. Bookings without weather are remembered neither by the
    query nor in the files, as a copy of one would not be counted either.
    """
    seen = SeenKeys(f"{path}/seen", BOOKING_KEYS, buckets)
    add = counting(counts_table(f"{path}/counts", grain, categories), grain, categories)

    def write(batch: DataFrame, batch_id: int) -> None:
        fresh = seen.admit(batch, batch_id)
        add(classify(enrich_with_days(fresh.withColumnRenamed("order_id", "id"), days.frame), categories), batch_id)

    matched = with_weather(project_bookings(bookings), days.frame, copy_salts)
    once = recent_once(matched, copies_within, copy_salts)
    return run_stream(once, write, checkpoint, "append", trigger, partitions=partitions)

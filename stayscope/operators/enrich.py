"""Bookings joined to the weather of their check-in day, batch or stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from stayscope.operators.bookings import BOOKING_KEYS, project_bookings, with_stay_days
from stayscope.operators.grouping import group_by_whole_key
from stayscope.operators.weather import MIN_TMPR, weather_means

ENRICHED_KEYS = (*BOOKING_KEYS, "hotel_name")

# Ways in which a protected stream splits the copies of one booking before it removes them,
# or the bookings of one hotel-day; about the number of its cores is a good choice.
COPY_SALTS = 8


def enrich(bookings: DataFrame, weather: DataFrame, min_tmpr: float = MIN_TMPR) -> DataFrame:
    """Distinct bookings of days above ``min_tmpr``, with mean temperature and stay length.

    A booking appears once per hotel name known for its hotel-day.

    The weather is averaged before the join, so that bookings do not fan out, and copies
    of bookings are removed after it, so that only bookings with weather are shuffled for
    that, or kept as state by a stream.
    """
    return enrich_with_days(bookings, weather_means(weather, min_tmpr))


def enrich_with_days(
    bookings: DataFrame,
    days: DataFrame,
    join_salts: int = 1,
    copy_salts: int = 0,
    copies_within: str | None = None,
    unmatched: str | Observation | None = None,
) -> DataFrame:
    """``enrich`` for weather that ``weather_means`` has already reduced.

    ``unmatched`` names an observation of how many bookings, copies included, met no weather; they then go
    through the join and are dropped after it.

    The other arguments are for streams, where AQE does not help. ``join_salts`` splits
    the bookings of a hotel-day over that many tasks of a sort-merge join, at the price
    of as many copies of ``days``. ``copy_salts`` splits the copies of a booking over that
    many tasks before they are removed, at the price of twice the state; 0 leaves them in one. With ``copies_within``, a time like
    "1 day", a copy is only recognised if it arrives so soon after the first, and the
    state stays small. Arrival is the time of the micro-batch, so no booking is ever late,
    however old it is; the price is that a copy sent again after that time counts again.
    A query must be restarted with the ``copy_salts`` and ``copies_within`` it began with.
    """
    if not bookings.isStreaming:
        return finish_batch(join_days(project_bookings(bookings), days, unmatched=unmatched))

    # Null keys match no day; dropped before the salt, whose place in the plan stops filters.
    narrow = project_bookings(bookings).where("hotel_id IS NOT NULL AND srch_ci IS NOT NULL")
    if copies_within:
        narrow = narrow.withColumn("arrival", F.current_timestamp()).withWatermark("arrival", copies_within)
    salted = narrow.withColumn("salt", booking_salt(max(join_salts, copy_salts, 1)))
    joined = join_days(salted, days, join_salts, unmatched=unmatched)
    if copy_salts > 1:
        joined = drop_copies(joined, [*ENRICHED_KEYS, "salt"], bool(copies_within))
    return _finish(drop_copies(joined, ENRICHED_KEYS, bool(copies_within)))


def join_days(
    bookings: DataFrame,
    days: DataFrame,
    salts: int = 1,
    also: Column | None = None,
    unmatched: str | Observation | None = None,
) -> DataFrame:
    """Inner join on hotel and check-in day, which is compared as text, and on what holds ``also``."""
    matches = (F.col("hotel_id") == F.col("Id")) & (F.col("srch_ci") == F.col("wthrDate"))
    if salts > 1:
        every_salt = F.array(*[F.lit(n) for n in range(salts)])
        days = days.withColumn("day_salt", F.explode(every_salt))
        matches &= F.col("salt") % salts == F.col("day_salt")
    if also is not None:
        matches &= also
    if unmatched is None:
        return bookings.join(days, matches, "inner").drop("Id", "wthrDate", "day_salt")
    joined = bookings.join(days.withColumn("known", F.lit(True)), matches, "left")
    none = F.count_if(F.col("known").isNull())
    counted = joined.observe(unmatched, F.count("known").alias("matched"), none.alias("unmatched"))
    return counted.where("known").drop("Id", "wthrDate", "day_salt", "known")


def with_weather(bookings: DataFrame, days: DataFrame, salts: int = 0) -> DataFrame:
    """Projected bookings whose hotel-day has weather; ``salts`` above 1 splits the bookings of one over so many tasks."""
    known = bookings.where("hotel_id IS NOT NULL AND srch_ci IS NOT NULL")
    days = days.select("Id", "wthrDate")
    matches = (F.col("hotel_id") == F.col("Id")) & (F.col("srch_ci") == F.col("wthrDate"))
    if salts > 1:
        known = known.withColumn("salt", booking_salt(salts))
        days = days.withColumn("day_salt", F.explode(F.array(*[F.lit(n) for n in range(salts)])))
        matches &= F.col("salt") == F.col("day_salt")
    return known.join(days, matches, "left_semi").drop("salt")


def booking_salt(salts: int) -> Column:
    """Spreads the bookings of one day by their ids, and copies of one by their task."""
    by_id = F.pmod(F.xxhash64("order_id"), F.lit(salts))
    return ((by_id + F.spark_partition_id()) % salts).cast("int")


def _distinct(joined: DataFrame) -> DataFrame:
    """One row per enriched booking of a batch.

    Copies share their mean; as its maximum, unlike as the first one met, it does not
    keep filters on the result from reaching the scans.
    """
    return group_by_whole_key(joined, ENRICHED_KEYS, F.max("avg_tmpr").alias("avg_tmpr"))


def drop_copies(
    joined: DataFrame, keys: Sequence[str] = ENRICHED_KEYS, within_watermark: bool = False
) -> DataFrame:
    """The first row per key of a stream.

    A stream sends all copies of a key to one task. With a salt among the keys they go
    to several, and only what those let pass meets at the next, unsalted removal.
    """
    if within_watermark:
        return joined.dropDuplicatesWithinWatermark(list(keys))
    return joined.dropDuplicates(list(keys))


def finish_batch(joined: DataFrame) -> DataFrame:
    """Enriched bookings of a batch, from bookings joined to their days."""
    return _finish(_distinct(joined))


def _finish(distinct: DataFrame) -> DataFrame:
    return with_stay_days(distinct).select(*ENRICHED_KEYS, "avg_tmpr", "duration_stay")

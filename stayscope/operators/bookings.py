"""Operators on booking records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayscope.functions.stay import stay_days

# What makes two bookings the same.
BOOKING_KEYS = ("order_id", "srch_ci", "srch_co", "srch_children_cnt", "hotel_id")


def project_bookings(bookings: DataFrame, *more: str) -> DataFrame:
    """The five columns that identify a booking, with ``id`` renamed to ``order_id``.

    Ids become longs, which is free where they are longs already.
    """
    renamed = bookings.withColumnRenamed("id", "order_id")
    longs = {name: F.col(name).cast("bigint").alias(name) for name in ("order_id", "hotel_id")}
    return renamed.select(*[longs.get(name, name) for name in (*BOOKING_KEYS, *more)])


def distinct_bookings(bookings: DataFrame) -> DataFrame:
    """Each booking once.

    Copies collapse within every input task before anything is shuffled, so a booking
    that was sent a million times does not load one reducer.
    """
    return project_bookings(bookings).distinct()


def with_stay_days(bookings: DataFrame) -> DataFrame:
    return bookings.withColumn("duration_stay", stay_days(F.col("srch_ci"), F.col("srch_co")))

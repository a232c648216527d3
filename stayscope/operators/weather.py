"""Operators on the weather readings of hotels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FractionalType, StringType

from stayscope.operators.grouping import group_by_whole_key

MIN_TMPR = 0

DAY_KEYS = ("Id", "wthrDate", "hotel_name")


def project_weather(weather: DataFrame) -> DataFrame:
    """Hotel id, day, temperature and hotel name of each reading.

    The id is a double where a JSON reader inferred it; as a long it can be compared
    with booking ids, exactly so below 2**53. An id with a fraction is no id. Where messages
    differ in its type it is text, in which a number may be written with an exponent.
    """
    hotel = F.col("Id")
    kind = weather.select(hotel).schema[0].dataType
    if isinstance(kind, FractionalType):
        hotel = F.when(hotel == F.floor(hotel), hotel)
    number = hotel.try_cast("bigint")
    if isinstance(kind, StringType):
        real = hotel.try_cast("double")
        number = F.coalesce(number, F.when(real == F.floor(real), real).try_cast("bigint"))
    return weather.select(
        number.alias("Id"),
        F.col("wthrDate").alias("wthrDate"),
        F.col("avgTmprC").try_cast("double").alias("avgTmprC"),
        F.col("Name").alias("hotel_name"),
    )


def above_temperature(readings: DataFrame, min_tmpr: float = MIN_TMPR) -> DataFrame:
    """Readings strictly above a temperature; unknown temperatures are dropped."""
    return readings.where(F.col("avgTmprC") > F.lit(min_tmpr))


def weather_means(weather: DataFrame, min_tmpr: float = MIN_TMPR) -> DataFrame:
    """Mean temperature per hotel, day and hotel name over the readings kept.

    One row per hotel-day and name: joined to distinct bookings it neither fans out
    nor changes the mean that averaging after the join would give.
    """
    readings = above_temperature(project_weather(weather), min_tmpr)
    return group_by_whole_key(readings, DAY_KEYS, F.avg("avgTmprC").alias("avg_tmpr"))

"""Bookings laid out for the joins to come: by month of check-in, or in buckets by hotel-day."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stayscope.operators.bookings import BOOKING_KEYS, project_bookings, with_stay_days
from stayscope.operators.enrich import ENRICHED_KEYS, join_days
from stayscope.sources.files import write_table

MONTH = "ci_month"
#: Rows that a task sorts for a bucket, about 200 MB, and the number of buckets that Spark allows.
BUCKET_ROWS = 2_000_000
MOST_BUCKETS = 100_000


def month_of(day: str) -> Column:
    return F.substring(day, 1, 7)


def write_by_month(bookings: DataFrame, path: str) -> None:
    """Replace the bookings at ``path``, in a folder for each month of check-in."""
    write_table(project_bookings(bookings).withColumn(MONTH, month_of("srch_ci")), path, partition_by=[MONTH])


def join_days_by_month(by_month: DataFrame, days: DataFrame) -> DataFrame:
    """``join_days`` for bookings read from ``write_by_month``, of which only months with weather are read.

    The months are known when the query runs: they alone are broadcast, each once, and prune the folders before
    these are listed for reading. The weather is broadcast only if it has been measured to be small (``static_days``).
    """
    # true of all days, but a comparison: without one Spark takes the weather for all there is and prunes nothing
    months = days.select(month_of("wthrDate").alias("day_month")).where(F.col("day_month") >= "").distinct()
    read = by_month.join(F.broadcast(months), F.col(MONTH) == F.col("day_month"), "left_semi")
    return join_days(read, days).drop(MONTH)


def buckets_for(rows: int, least: int = 1) -> int:
    """Buckets for a table of so many rows, that none grows with the table."""
    return min(max(least, math.ceil(rows / BUCKET_ROWS)), MOST_BUCKETS)


def write_bucketed(frame: DataFrame, table: str, path: str, hotel: str, day: str, buckets: int) -> DataFrame:
    """Store a table in buckets by hotel and day, sorted within; returns it as it is read from the catalog.

    Two tables with as many buckets are joined by hotel and day without moving either, and their rows grouped after it
    where they lie. A hotel-day is never split, so this is for bookings without heavy ones. Each task first
    gathers what belongs to a bucket, so that a bucket is one file.
    """
    dealt = frame.repartition(buckets, hotel, day)
    writer = dealt.write.mode("overwrite").bucketBy(buckets, hotel, day).sortBy(hotel, day)
    writer.option("path", path).format("parquet").saveAsTable(table)
    return frame.sparkSession.table(table)


def enrich_in_place(bookings: DataFrame, days: DataFrame) -> DataFrame:
    """``enrich_with_days`` for two tables in equal buckets: joined and made distinct without a shuffle of either."""
    matches = (F.col("hotel_id") == F.col("Id")) & (F.col("srch_ci") == F.col("wthrDate"))
    joined = bookings.join(days.hint("merge"), matches).drop("Id", "wthrDate")
    once = joined.groupBy(*ENRICHED_KEYS).agg(F.max("avg_tmpr").alias("avg_tmpr"))
    return with_stay_days(once).select(*ENRICHED_KEYS, "avg_tmpr", "duration_stay")


def bucketed_inputs(
    spark: SparkSession, bookings: DataFrame, days: DataFrame, name: str, root: str, buckets: int
) -> tuple[DataFrame, DataFrame]:
    """Bookings and reduced weather as tables ``name``_bookings and ``name``_days in equal buckets."""
    mine = project_bookings(bookings).select(*BOOKING_KEYS)
    left = write_bucketed(mine, f"{name}_bookings", f"{root}/bookings", "hotel_id", "srch_ci", buckets)
    return left, write_bucketed(days, f"{name}_days", f"{root}/days", "Id", "wthrDate", buckets)

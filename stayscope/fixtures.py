"""Booking and weather tables derived from the TPC-H-like test tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stayscope.session import MIB
from stayscope.sources.files import read_table_stream

GIB = 1024 * MIB


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def table_stream(
    spark: SparkSession, sf_dir: str, name: str, bytes_per_trigger: int | None = None
) -> DataFrame:
    """A table as a file stream.

    The path is a glob because the file source takes a plain path for a folder, and a
    table may be one file or a folder of files.
    """
    schema = table(spark, sf_dir, name).schema
    options = {"maxBytesPerTrigger": str(bytes_per_trigger)} if bytes_per_trigger else None
    path = f"{sf_dir}/{name}[.]parquet"
    return read_table_stream(spark, path, schema, options=options)


def as_bookings(lineitem: DataFrame, children: Column | None = None) -> DataFrame:
    """One booking per order line; stays run from -7 to 41 days or have no check-out."""
    check_in = F.col("l_shipdate").cast("date")
    nights = F.col("l_quantity").cast("int") - 8
    check_out = F.when(F.col("l_quantity") != 50, F.date_add(check_in, nights))
    return lineitem.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
        F.col("l_suppkey").alias("hotel_id"),
        check_in.cast("string").alias("srch_ci"),
        check_out.cast("string").alias("srch_co"),
        (F.col("l_linenumber") % 4 if children is None else children).alias("srch_children_cnt"),
    )


def sent_again(bookings_: DataFrame) -> DataFrame:
    """Every booking one to seven times, by its order line."""
    times = F.sequence(F.lit(1), (F.col("id") % 10).cast("int"))
    return bookings_.select("*", F.explode(times).alias("copy")).drop("copy")


def bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_bookings(table(spark, sf_dir, "lineitem"))


def booking_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bookings in micro-batches that are small enough to repeat after a failure."""
    return as_bookings(table_stream(spark, sf_dir, "lineitem", bytes_per_trigger=256 * GIB))


def weather(spark: SparkSession, sf_dir: str, name: Column | None = None) -> DataFrame:
    """One reading per order, -10 to 34 degrees, at one of the suppliers as hotels."""
    supplier = table(spark, sf_dir, "supplier")
    hotels = supplier.select(F.count("*")).scalar()
    reading_hotel = F.col("o_custkey") % hotels
    degrees = F.floor("o_totalprice").cast("bigint") % 45 - 10
    readings = table(spark, sf_dir, "orders").select(
        reading_hotel.alias("Id"),
        F.col("o_orderdate").cast("date").cast("string").alias("wthrDate"),
        degrees.cast("double").alias("avgTmprC"),
    )
    named = supplier.select("s_suppkey", (F.col("s_name") if name is None else name).alias("Name"))
    return readings.join(named, F.col("Id") == F.col("s_suppkey")).drop("s_suppkey")

"""Heavy keys, found by a sketch, and joins that split just these.

One pass keeps, in each task, the counts of the keys that may be frequent, and merges them to one
row: Spark's frequent-items sketch. Whatever key has more than its share of the rows is in it; a key that
is in it by mistake is split in vain, which costs a little and changes nothing. Keys that are not heavy
are joined as they are.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayscope.operators.enrich import join_days

#: Keys that the sketch may name, and counters it keeps in each task.
NAMED = 512
COUNTERS = 8192
#: Rows that a task always takes, so that small inputs are not split.
FEW = 10_000
#: A key is heavy from this part of an even task's rows on.
HEAVY = 0.5


def sketch(keys: Column) -> list[Column]:
    """Aggregates for ``heavy_keys``: the rows, and the keys that have most of them."""
    top = F.call_function("approx_top_k", keys, F.lit(NAMED), F.lit(COUNTERS))
    return [F.count("*").alias("rows"), top.alias("top")]


def day_hash(hotel: str, day: str) -> Column:
    """A hash of a hotel-day, the same on both sides of the join; null where either is."""
    known = F.col(hotel).isNotNull() & F.col(day).isNotNull()
    return F.when(known, F.xxhash64(F.col(hotel).cast("bigint"), F.col(day).cast("string")))


def heavy_keys(rows: int, top: list, tasks: int, few: int = FEW) -> dict[int, int]:
    """Hash of each heavy key -> in how many parts it is to be split, for an even load of ``tasks``."""
    even = max(few, rows / tasks)
    found = {t["item"]: t["count"] for t in top or [] if t["item"] is not None}
    return {key: min(tasks, math.ceil(n / even) + 1) for key, n in found.items() if n > HEAVY * even}


def heavy_days(bookings: DataFrame, tasks: int, few: int = FEW) -> dict[int, int]:
    """The heavy hotel-days of projected bookings; the driver sees one row."""
    row = bookings.agg(*sketch(day_hash("hotel_id", "srch_ci"))).first()
    return heavy_keys(row["rows"], row["top"], tasks, few)


def _parts(heavy: Mapping[int, int], key: Column) -> Column:
    pairs = [x for item, parts in heavy.items() for x in (F.lit(item).cast("bigint"), F.lit(parts))]
    return F.coalesce(F.element_at(F.create_map(*pairs), key), F.lit(1))


def join_days_splitting(bookings: DataFrame, days: DataFrame, heavy: Mapping[int, int]) -> DataFrame:
    """``join_days``, with the bookings of each heavy hotel-day dealt to as many parts as it is heavy.

    Its weather is repeated for each part. Bookings go by id and input task, which a task that runs
    again repeats, so that copies of one booking are spread too.
    """
    if not heavy:
        return join_days(bookings, days)
    parts = _parts(heavy, day_hash("hotel_id", "srch_ci"))
    place = F.pmod(F.xxhash64("order_id") + F.spark_partition_id(), parts).cast("int")
    salted = bookings.where("hotel_id IS NOT NULL AND srch_ci IS NOT NULL").withColumn("salt", place)
    every = F.sequence(F.lit(0), _parts(heavy, day_hash("Id", "wthrDate")) - 1)
    repeated = days.withColumn("day_salt", F.explode(every))
    return join_days(salted, repeated, also=F.col("salt") == F.col("day_salt")).drop("salt")

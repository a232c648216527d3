"""Popular stays over a stream of bookings, as one stateful query or over a topic."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stayscope.categories import STAY_CATEGORIES, StayCategory
from stayscope.operators.bookings import project_bookings
from stayscope.operators.classify import classify
from stayscope.operators.enrich import COPY_SALTS, drop_copies, enrich_with_days
from stayscope.operators.popular import popular
from stayscope.operators.weather import MIN_TMPR, weather_means
from stayscope.schemas import ENRICHED
from stayscope.session import MIB, file_system, materialize
from stayscope.streaming.runner import run_stream

# The driver builds each broadcast, a new one for every micro-batch, and holds several times its bytes.
MAX_BROADCAST = 8 * MIB


@dataclass(frozen=True)
class StaticDays:
    """The weather side of a job: reduced, written down once, and measured."""

    frame: DataFrame
    join_salts: int


def static_days(
    weather: DataFrame,
    path: str,
    min_tmpr: float = MIN_TMPR,
    max_broadcast: int = MAX_BROADCAST,
    salts: int = COPY_SALTS,
) -> StaticDays:
    """Mean weather per hotel-day as a table that every trigger joins.

    Without the table each trigger would average all readings again. Its size decides
    the join once, at the start: up to ``max_broadcast`` bytes it is broadcast, beyond
    that a stream splits the bookings of a hotel-day over ``salts`` tasks.

    New weather is picked up by starting the query again from its checkpoint.
    """
    days = materialize(weather_means(weather, min_tmpr), path)
    if table_bytes(days) <= max_broadcast:
        return StaticDays(F.broadcast(days), join_salts=1)
    # else Spark would broadcast it by the size of its files, which is a small part of that of its rows, salts included
    return StaticDays(days.hint("merge"), join_salts=salts)


def table_bytes(days: DataFrame) -> int:
    """Bytes of the rows in memory: the texts, and 80 for the numbers and the row."""
    texts = [F.coalesce(F.octet_length(c), F.lit(0)) for c in ("wthrDate", "hotel_name")]
    row = texts[0].cast("bigint") + texts[1] + 80
    return days.agg(F.coalesce(F.sum(row), F.lit(0))).first()[0]


def preferences_stream(
    bookings: DataFrame,
    days: StaticDays,
    categories: Sequence[StayCategory] = STAY_CATEGORIES,
    **dedup,
) -> DataFrame:
    """Classified bookings, each once; may be written in append mode."""
    enriched = enrich_with_days(bookings, days.frame, days.join_salts, **dedup)
    return classify(enriched, categories)


def start_collapsing(
    bookings: DataFrame,
    days: StaticDays,
    path: str,
    checkpoint: str,
    trigger: Mapping[str, object] | None = None,
) -> StreamingQuery:
    """First of two queries: micro-batches, enriched and rid of their copies, into files.

    It keeps no state. Each micro-batch is enriched as a batch: copies collapse before
    the shuffle, and AQE splits large hotel-days. That is cheaper than the salts of a
    single query where a few bookings or hotel-days make up much of the stream.

    A micro-batch that runs again after a failure appends its rows again; like copies
    that lie in different micro-batches, they are left to ``popular_stays_collapsed``.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        enrich_with_days(batch, days.frame).write.mode("append").parquet(path)

    # so that the second query finds the folder, however early it starts
    spark = bookings.sparkSession
    system, folder = file_system(spark, path)
    if not system.exists(folder):
        spark.createDataFrame([], ENRICHED).write.mode("append").parquet(path)
    return run_stream(project_bookings(bookings), write, checkpoint, "append", trigger)


def popular_stays_collapsed(
    enriched: DataFrame,
    grain: str = "hotel_children",
    categories: Sequence[StayCategory] = STAY_CATEGORIES,
) -> DataFrame:
    """Second of two queries: counts and most popular category of what the first wrote."""
    preferences = classify(drop_copies(enriched), categories)
    return popular(preferences, grain, categories, keep_keys=True)


def popular_stays_stream(
    bookings: DataFrame,
    days: StaticDays,
    grain: str = "hotel_children",
    categories: Sequence[StayCategory] = STAY_CATEGORIES,
    **dedup,
) -> DataFrame:
    """Counts and most popular category, keys included, for update or complete mode.

    Two stateful steps in one query: the bookings seen, and the counts per group.
    """
    preferences = preferences_stream(bookings, days, categories, **dedup)
    return popular(preferences, grain, categories, keep_keys=True)

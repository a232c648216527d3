"""Popular stays in the order of work that fits the inputs, measured before.

One pass over the hotel-days of both sides, of which the driver sees a row each, tells how many
hotel-days of the bookings have weather (theta sketches and their intersection) and which are heavy
(``operators.heavy``). Where few have weather, joining first drops most bookings early; where most have it,
counting first sends counts through the join instead of bookings.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayscope.categories import STAY_CATEGORIES, StayCategory
from stayscope.operators.bookings import project_bookings
from stayscope.operators.classify import classify
from stayscope.operators.enrich import finish_batch
from stayscope.operators.heavy import day_hash, heavy_keys, join_days_splitting, sketch
from stayscope.operators.popular import popular
from stayscope.operators.weather import MIN_TMPR, weather_means
from stayscope.plans.batch import count_first

#: Part of the bookings' hotel-days that must have weather for counting first to pay.
COVERED = 0.5


@dataclass(frozen=True)
class Profile:
    """What the sketches say: bookings, their hotel-days, those with weather, and the heavy ones."""

    rows: int
    days: int
    with_weather: int
    heavy: dict[int, int] = field(default_factory=dict)

    @property
    def coverage(self) -> float:
        return self.with_weather / self.days if self.days else 0.0

    @property
    def order(self) -> str:
        return "count_first" if self.coverage >= COVERED else "join_first"


def profile(bookings: DataFrame, days: DataFrame, tasks: int | None = None) -> Profile:
    """Sketch raw bookings and reduced weather; reads two columns of each."""
    spark = bookings.sparkSession
    tasks = tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    theta = lambda hotel, day: F.theta_sketch_agg(day_hash(hotel, day)).alias("theta")
    known = days.agg(theta("Id", "wthrDate")).first()["theta"]  # 32 KiB at most
    asked = project_bookings(bookings).agg(*sketch(day_hash("hotel_id", "srch_ci")), theta("hotel_id", "srch_ci"))
    common = F.theta_sketch_estimate(F.theta_intersection("theta", F.lit(known)))
    row = asked.select("rows", "top", F.theta_sketch_estimate("theta").alias("days"), common.alias("common")).first()
    return Profile(row["rows"], row["days"], row["common"], heavy_keys(row["rows"], row["top"], tasks))


def popular_stays_adaptive(
    bookings: DataFrame,
    weather: DataFrame,
    grain: str = "hotel",
    min_tmpr: float = MIN_TMPR,
    categories: Sequence[StayCategory] = STAY_CATEGORIES,
    tasks: int | None = None,
) -> DataFrame:
    """``popular_stays`` of a batch, in the order that ``profile`` recommends."""
    return in_best_order(bookings, weather_means(weather, min_tmpr), grain, categories, tasks)


def in_best_order(
    bookings: DataFrame,
    days: DataFrame,
    grain: str = "hotel",
    categories: Sequence[StayCategory] = STAY_CATEGORIES,
    tasks: int | None = None,
) -> DataFrame:
    """``popular_stays_adaptive`` for weather that is already reduced."""
    found = profile(bookings, days, tasks)
    if found.order == "count_first":
        return count_first(bookings, days, grain, categories)
    joined = join_days_splitting(project_bookings(bookings), days, found.heavy)
    return popular(classify(finish_batch(joined), categories), grain, categories)

"""From bookings and weather to the most popular stay per hotel, as one lazy plan.

There are two orders of work with the same result. ``popular_stays`` joins first: every
booking is shuffled once to meet the weather, and what has weather once more to remove
copies. Weather that ``static_days`` has measured as small is broadcast without the first
shuffle; if Spark measures it at run time, the shuffle has already been written. ``popular_stays_counting_first`` removes
the copies first, counts per hotel-day, and joins the counts.

Joining first is faster where few bookings have weather or where the weather is small;
counting first is where most bookings have weather that is too large to broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayscope.categories import STAY_CATEGORIES, StayCategory
from stayscope.functions.stay import category_label
from stayscope.operators.bookings import distinct_bookings, with_stay_days
from stayscope.operators.classify import classify
from stayscope.operators.counts import add_up, category_counts
from stayscope.operators.enrich import enrich_with_days, join_days
from stayscope.operators.popular import GRAINS, popular, with_popular
from stayscope.operators.weather import MIN_TMPR, weather_means


def popular_stays(
    bookings: DataFrame,
    weather: DataFrame,
    grain: str = "hotel",
    min_tmpr: float = MIN_TMPR,
    categories: Sequence[StayCategory] = STAY_CATEGORIES,
) -> DataFrame:
    """Counts per category and the most popular one.

    A stream of bookings gives a stream of results, for update or complete mode;
    ``plans.stream`` has what a long-running one needs besides.
    """
    return join_first(bookings, weather_means(weather, min_tmpr), grain, categories)


def popular_stays_counting_first(
    bookings: DataFrame,
    weather: DataFrame,
    grain: str = "hotel",
    min_tmpr: float = MIN_TMPR,
    categories: Sequence[StayCategory] = STAY_CATEGORIES,
) -> DataFrame:
    """The same as ``popular_stays`` for a batch, in the other order of work."""
    return count_first(bookings, weather_means(weather, min_tmpr), grain, categories)


def join_first(
    bookings: DataFrame,
    days: DataFrame,
    grain: str = "hotel",
    categories: Sequence[StayCategory] = STAY_CATEGORIES,
) -> DataFrame:
    """``popular_stays`` for weather that ``weather_means`` has already reduced."""
    return popular(classify(enrich_with_days(bookings, days), categories), grain, categories)


def count_first(
    bookings: DataFrame,
    days: DataFrame,
    grain: str = "hotel",
    categories: Sequence[StayCategory] = STAY_CATEGORIES,
) -> DataFrame:
    """``popular_stays_counting_first`` for weather that is already reduced.

    A hotel-day has one count row (per number of children, at that grain) and one weather
    row per name, so the counts add up to what counting joined bookings would give. They
    leave every task pre-aggregated and lie where the join needs them.
    """
    if bookings.isStreaming:
        raise ValueError("a stream of bookings can only be joined first")
    level = GRAINS[grain]
    counters = level.counters(categories)
    label = category_label(F.col("duration_stay"), categories)
    stays = (
        with_stay_days(distinct_bookings(bookings))
        .withColumnRenamed("srch_children_cnt", "children_cnt")
        .withColumn("initial_state", label)
    )
    from_booking = [key for key in level.keys if key not in ("hotel_name", "hotel_id")]
    per_day = category_counts(stays, ["hotel_id", "srch_ci", *from_booking], counters)
    counted = add_up(join_days(per_day, days.drop("avg_tmpr")), level.keys, list(counters))
    return level.visible(with_popular(counted, categories))

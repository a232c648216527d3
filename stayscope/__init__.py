"""Stay analytics on Spark: which length of stay is most popular per hotel.

The public operators are re-exported here; each takes and returns DataFrames.
"""

from stayscope.categories import STAY_CATEGORIES, StayCategory
from stayscope.functions.argmax import argmax_name
from stayscope.functions.stay import category_description, category_label, stay_days
from stayscope.operators.bookings import distinct_bookings, project_bookings
from stayscope.operators.classify import classify
from stayscope.operators.counts import category_counts, children_counters, stay_counters
from stayscope.operators.enrich import enrich
from stayscope.operators.popular import GRAINS, argmax_column, popular
from stayscope.operators.weather import above_temperature, project_weather, weather_means
from stayscope.plans.batch import popular_stays, popular_stays_counting_first

__all__ = [
    "GRAINS",
    "STAY_CATEGORIES",
    "StayCategory",
    "above_temperature",
    "argmax_column",
    "argmax_name",
    "category_counts",
    "category_description",
    "category_label",
    "children_counters",
    "classify",
    "distinct_bookings",
    "enrich",
    "popular_stays",
    "popular_stays_counting_first",
    "popular",
    "project_bookings",
    "project_weather",
    "stay_counters",
    "stay_days",
    "weather_means",
]

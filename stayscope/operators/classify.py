"""Customer preferences: each booking with the category of its length."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayscope.categories import STAY_CATEGORIES, StayCategory
from stayscope.functions.stay import category_description, category_label


def classify(
    enriched: DataFrame, categories: Sequence[StayCategory] = STAY_CATEGORIES
) -> DataFrame:
    """Label every enriched booking; works the same on a batch and on a stream."""
    label = category_label(F.col("duration_stay"), categories)
    return enriched.select(
        "hotel_name",
        "hotel_id",
        "order_id",
        "duration_stay",
        F.col("srch_children_cnt").alias("children_cnt"),
        label.alias("initial_state"),
    ).withColumn("initial_state_value", category_description(F.col("initial_state"), categories))

"""The most popular category per group."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame

from stayscope.categories import STAY_CATEGORIES, StayCategory
from stayscope.functions.argmax import argmax_name
from stayscope.operators.counts import category_counts, children_counters, stay_counters

POPULAR = "most_popular_stay_type"


@dataclass(frozen=True)
class Grain:
    """What a result row stands for: its group keys, and which of them to hide."""

    keys: tuple[str, ...]
    hidden: tuple[str, ...] = ()
    children: bool = False

    def counters(self, categories: Sequence[StayCategory]) -> dict[str, Column]:
        flags = children_counters() if self.children else {}
        return {**flags, **stay_counters(categories)}

    def visible(self, frame: DataFrame) -> DataFrame:
        return frame.drop(*self.hidden)


# "hotel" tells same-named hotels apart. "hotel_children" goes by name and number of
# children; its rows are told apart by a key that the result does not show.
GRAINS = {
    "hotel": Grain(keys=("hotel_name", "hotel_id")),
    "hotel_children": Grain(
        keys=("hotel_name", "children_cnt"), hidden=("children_cnt",), children=True
    ),
}


def argmax_column(frame: DataFrame, columns: Sequence[str], out: str) -> DataFrame:
    """Add a column ``out`` that names the largest of ``columns``."""
    return frame.withColumn(out, argmax_name(columns))


def with_popular(
    counted: DataFrame, categories: Sequence[StayCategory] = STAY_CATEGORIES
) -> DataFrame:
    return argmax_column(counted, [c.counter for c in categories], POPULAR)


def popular(
    preferences: DataFrame,
    grain: str = "hotel",
    categories: Sequence[StayCategory] = STAY_CATEGORIES,
    keep_keys: bool = False,
) -> DataFrame:
    """Counts per category and the most popular one, at a grain of ``GRAINS``.

    ``keep_keys`` keeps the hidden keys, which a sink needs to replace rows.
    """
    level = GRAINS[grain]
    counted = category_counts(preferences, level.keys, level.counters(categories))
    result = with_popular(counted, categories)
    return result if keep_keys else level.visible(result)

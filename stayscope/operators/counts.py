"""Conditional counts per group."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayscope.categories import STAY_CATEGORIES, StayCategory


def stay_counters(
    categories: Sequence[StayCategory] = STAY_CATEGORIES, label: str = "initial_state"
) -> dict[str, Column]:
    """Counter name -> condition, one per category."""
    return {c.counter: F.col(label) == c.label for c in categories}


def children_counters(children: str = "children_cnt") -> dict[str, Column]:
    """Counters of bookings with and without children; unknown is neither."""
    return {
        "with_children_true": F.col(children) > 0,
        "with_children_false": F.col(children) <= 0,
    }


def category_counts(
    frame: DataFrame, keys: Sequence[str], counters: Mapping[str, Column]
) -> DataFrame:
    """Rows per group that meet each condition, one bigint column per counter."""
    counts = [F.count_if(condition).alias(name) for name, condition in counters.items()]
    return frame.groupBy(*keys).agg(*counts)


def add_up(frame: DataFrame, keys: Sequence[str], counters: Sequence[str]) -> DataFrame:
    """Sum counters that were counted at a finer grain."""
    return frame.groupBy(*keys).agg(*[F.sum(name).alias(name) for name in counters])

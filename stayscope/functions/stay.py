"""Expressions on the length of a stay."""

from __future__ import annotations

from collections.abc import Sequence
from pyspark.sql import Column
from pyspark.sql import functions as F

from stayscope.categories import STAY_CATEGORIES, StayCategory, fallback_of


def stay_days(check_in: Column, check_out: Column) -> Column:
    """Days between two date strings, never negative; null if either is no date."""
    days = F.datediff(check_out.try_cast("date"), check_in.try_cast("date"))
    return F.abs(days).cast("bigint")


def category_label(
    days: Column, categories: Sequence[StayCategory] = STAY_CATEGORIES
) -> Column:
    """Label of the category whose day range holds ``days``."""
    label = F.lit(fallback_of(categories).label)
    for c in categories:
        if not c.is_fallback:
            label = F.when(days.between(c.first_day, c.last_day), c.label).otherwise(label)
    return label


def category_description(
    label: Column, categories: Sequence[StayCategory] = STAY_CATEGORIES
) -> Column:
    """Description that belongs to a label, looked up in a literal map."""
    pairs = [F.lit(text) for c in categories for text in (c.label, c.description)]
    return F.create_map(*pairs)[label]

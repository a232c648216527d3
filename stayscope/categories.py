"""The length-of-stay categories, as data."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass


@dataclass(frozen=True)
class StayCategory:
    """A label for stays of ``first_day``..``last_day`` days, both ends included.

    A category without a range takes every stay that no other category takes,
    unknown lengths included. A category list has exactly one such fallback.
    """

    label: str
    description: str
    counter: str
    first_day: int | None = None
    last_day: int | None = None

    @property
    def is_fallback(self) -> bool:
        return self.first_day is None


# Labels, descriptions, counter names and day ranges.
# The spelling and the blank before "1-2 weeks" are part of the contract.
STAY_CATEGORIES = (
    StayCategory(
        "Erroneous data", "null/ more than 30 days/ less or equal to 0", "erroneous_data_cnt"
    ),
    StayCategory("Short stay", "1 day stay", "short_stay_cnt", 1, 1),
    StayCategory("Standart stay", "2-7 days", "standart_stay_cnt", 2, 7),
    StayCategory("Standart extended stay", " 1-2 weeks", "standart_extended_stay_cnt", 8, 14),
    StayCategory("Long stay", "2-4 weeks (less than month)", "long_stay_cnt", 15, 30),
)


def fallback_of(categories: Sequence[StayCategory]) -> StayCategory:
    fallbacks = [c for c in categories if c.is_fallback]
    if len(fallbacks) != 1:
        raise ValueError(f"expected one category without a day range, got {len(fallbacks)}")
    return fallbacks[0]

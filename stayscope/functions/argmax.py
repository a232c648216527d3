"""Name of the largest of several columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def argmax_name(columns: Sequence[str]) -> Column:
    """Name of the column with the largest value in the row.

    On a tie the name that sorts last wins. Null counts as smaller than any value,
    so a row of nulls also yields the name that sorts last.
    """
    names = sorted(columns, reverse=True)
    if not names:
        raise ValueError("argmax_name needs at least one column")
    if len(names) == 1:
        return F.lit(names[0])
    largest = F.greatest(*names)
    hits = [F.when(F.col(name) == largest, F.lit(name)) for name in names]
    return F.coalesce(*hits, F.lit(names[0]))

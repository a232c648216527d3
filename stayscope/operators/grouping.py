"""Grouping that does not depend on how its input happens to be partitioned."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def group_by_whole_key(frame: DataFrame, keys: Sequence[str], *aggregates: Column) -> DataFrame:
    """``groupBy(*keys).agg(*aggregates)``, always with a shuffle by all of the keys.

    After a join on some of the keys, Spark would reuse the partitioning of the join.
    That saves a shuffle of rows that are pre-aggregated anyway, but a join value with a
    third of the rows would stay in one task: AQE splits a join only where the rows are
    shuffled afterwards. Grouped as one struct, the keys do not match the partitioning.
    """
    grouped = frame.groupBy(F.struct(*keys).alias("key")).agg(*aggregates)
    return grouped.select("key.*", *[c for c in grouped.columns if c != "key"])

"""Popular stays kept up to date without counting all bookings again.

Distinct bookings are counted per hotel-day, and the reduced weather is kept per hotel-day, both in
tables by month of the day that are replaced month by month. The result is the sum, over the
hotel-days that have weather, of their counts. When months of either table change, the
result changes by what their days contribute now less what they contributed before; all
other months are not read. Which months changed is seen by comparing the versions of the
tables that the result has been made from with the newest, so a refresh that is lost on its way, or comes late,
is made up for by the next one.

All copies of a booking have one check-in day, so they meet within a month.
"""

from __future__ import annotations

from collections.abc import Collection, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayscope.categories import STAY_CATEGORIES, StayCategory
from stayscope.functions.stay import category_label
from stayscope.operators.bookings import BOOKING_KEYS, project_bookings, with_stay_days
from stayscope.operators.counts import add_up, category_counts
from stayscope.operators.enrich import join_days
from stayscope.operators.popular import GRAINS, with_popular
from stayscope.operators.weather import DAY_KEYS, MIN_TMPR, weather_means
from stayscope.sources.tables import AtomicTable, Version

MONTH = "month"
#: Bookings of a group, whatever their category.
ALL = "bookings"


@dataclass(frozen=True)
class PopularityView:
    """Counts per group at ``path``, and the tables by month that they are made from."""

    path: str
    grain: str = "hotel"
    min_tmpr: float = MIN_TMPR
    categories: Sequence[StayCategory] = STAY_CATEGORIES

    @property
    def counts(self) -> AtomicTable:
        return AtomicTable(f"{self.path}/counts", [MONTH])

    @property
    def days(self) -> AtomicTable:
        return AtomicTable(f"{self.path}/days", [MONTH])

    @property
    def result(self) -> AtomicTable:
        return AtomicTable(f"{self.path}/result")

    @property
    def counters(self) -> list[str]:
        return [ALL, *GRAINS[self.grain].counters(self.categories)]

    def replace_bookings(self, bookings: DataFrame) -> Version:
        """Take these as all the bookings of the months they have check-ins in; other months stay."""
        level = GRAINS[self.grain]
        known = project_bookings(bookings).withColumn(MONTH, F.substring("srch_ci", 1, 7)).where(F.col(MONTH) != "")
        once = known.where("hotel_id IS NOT NULL").select(*BOOKING_KEYS).distinct()
        stays = with_stay_days(once).withColumnRenamed("srch_children_cnt", "children_cnt")
        labelled = stays.withColumn("initial_state", category_label(F.col("duration_stay"), self.categories))
        keys = ["hotel_id", "srch_ci", *(k for k in level.keys if k not in ("hotel_name", "hotel_id"))]
        counted = category_counts(labelled, keys, {ALL: F.lit(True), **level.counters(self.categories)})
        counted = counted.withColumn(MONTH, F.substring("srch_ci", 1, 7))
        return self.counts.replace_partitions(_marked(counted, known))

    def replace_weather(self, weather: DataFrame) -> Version:
        """Take these as all the readings of the months they have; other months stay."""
        named = weather.withColumn(MONTH, F.substring("wthrDate", 1, 7)).where(F.col(MONTH) != "")
        means = weather_means(named, self.min_tmpr).where("Id IS NOT NULL").select(*DAY_KEYS, F.substring("wthrDate", 1, 7).alias(MONTH))
        return self.days.replace_partitions(_marked(means, named))

    def refresh(self, spark: SparkSession) -> Collection[str]:
        """Bring the result up to the newest bookings and weather; returns the months that were read."""
        result, counts, days = (t.current(spark) for t in (self.result, self.counts, self.days))
        before = result.notes.get("made_from", [0, 0])
        old_counts, old_days = self.counts.version(spark, before[0]), self.days.version(spark, before[1])
        changed = {_month(p) for p in {*_changes(old_counts, counts), *_changes(old_days, days)}}
        if not changed and result.number:
            return changed
        parts = [self._contribution(spark, counts, days, changed, 1), self._contribution(spark, old_counts, old_days, changed, -1)]
        if result.number:
            parts.append(self.result.read(spark, result))
        parts = [p for p in parts if p is not None]
        if not parts:
            return changed
        every = parts[0]
        for p in parts[1:]:
            every = every.unionByName(p)
        summed = add_up(every, GRAINS[self.grain].keys, self.counters).where(F.col(ALL) > 0)
        self.result.replace(summed, {"made_from": [counts.number, days.number]}, since=result)
        return changed

    def read(self, spark: SparkSession) -> DataFrame:
        """Counts and most popular category as of the last refresh."""
        return GRAINS[self.grain].visible(with_popular(self.result.read(spark).drop(ALL), self.categories))

    def _contribution(self, spark, counts: Version, days: Version, months: Collection[str], sign: int) -> DataFrame | None:
        """What the hotel-days of some months add to the result, or take from it."""
        if counts.schema is None or days.schema is None:
            return None
        mine = [self._months(t, spark, v, months) for t, v in ((self.counts, counts), (self.days, days))]
        summed = add_up(join_days(*mine), GRAINS[self.grain].keys, self.counters)
        return summed.select(*GRAINS[self.grain].keys, *[(F.col(c) * sign).alias(c) for c in self.counters])

    @staticmethod
    def _months(table: AtomicTable, spark, version: Version, months: Collection[str]) -> DataFrame:
        return table.read(spark, version, [p for p in version.folders if _month(p) in months]).drop(MONTH)


def _marked(rows: DataFrame, months: DataFrame) -> DataFrame:
    """``rows`` with a row of nulls, which joins nothing, for each month of ``months``, so that no month is left out."""
    empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema if f.name != MONTH]
    return rows.unionByName(months.select(MONTH).distinct().select(*empty, MONTH))


def _month(partition: str) -> str:
    return partition.split("=", 1)[1]


def _changes(old: Version, new: Version) -> set[str]:
    """Partitions that are not the same in both versions."""
    return {p for p in {*old.folders, *new.folders} if old.folders.get(p) != new.folders.get(p)}

import re

import pytest
from helpers import bookings_of, plan_of, rows_of, weather_of
from pyspark.sql import functions as F

from stayscope import (
    distinct_bookings,
    enrich,
    fixtures,
    popular_stays,
    popular_stays_counting_first,
    weather_means,
)
from stayscope.catalog import QUERIES
from stayscope.schemas import BOOKINGS
from stayscope.session import settings

BATCH = [name for name in QUERIES if not name.startswith(("stream", "stamped", "windowed"))]
MERGE_JOIN = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
}


def final_plan(frame):
    """The plan that AQE arrived at."""
    frame.collect()
    return plan_of(frame, "simple")


def exchanges(plan):
    return re.findall(r"Exchange hashpartitioning\(([^)]*)", plan)


@pytest.fixture(scope="module")
def wide(spark, tmp_path_factory):
    """Bookings with all their columns and weather, in files."""
    root = tmp_path_factory.mktemp("wide")
    day = F.date_add(F.lit("2016-01-01").cast("date"), (F.col("id") % 50).cast("int"))
    values = {
        "srch_ci": day.cast("string"),
        "srch_co": F.date_add(day, 3).cast("string"),
        "hotel_id": F.col("id") % 20,
        "srch_children_cnt": (F.col("id") % 3).cast("int"),
    }
    values["id"] = F.col("id")
    columns = [values.get(f.name, F.lit(1)).cast(f.dataType).alias(f.name) for f in BOOKINGS]
    spark.range(5000).select(columns).write.parquet(f"{root}/bookings")
    weather = spark.range(1000).select(
        (F.col("id") % 20).alias("Id"),
        F.date_add(F.lit("2016-01-01").cast("date"), (F.col("id") % 50).cast("int"))
        .cast("string")
        .alias("wthrDate"),
        F.lit(68.0).alias("avgTmprF"),
        F.lit(20.0).alias("avgTmprC"),
        F.lit("A").alias("Name"),
        F.lit("US").alias("Country"),
    )
    weather.write.parquet(f"{root}/weather")
    return spark.read.parquet(f"{root}/bookings"), spark.read.parquet(f"{root}/weather")


@pytest.mark.parametrize("name", BATCH)
def test_no_python_in_the_plan(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    assert not re.search(r"Python|Pandas|Arrow|CartesianProduct|NestedLoop", plan)


@pytest.mark.parametrize("run", [popular_stays, popular_stays_counting_first])
def test_only_needed_columns_and_rows_are_scanned(wide, run):
    plan = plan_of(run(*wide))
    bookings, weather = sorted(re.findall(r"ReadSchema: struct<(.*)>", plan), key=len)[::-1]
    assert set(re.findall(r"(\w+):", bookings)) == {
        "id",
        "srch_ci",
        "srch_co",
        "srch_children_cnt",
        "hotel_id",
    }
    assert set(re.findall(r"(\w+):", weather)) == {"Id", "wthrDate", "avgTmprC", "Name"}
    pushed = re.findall(r"PushedFilters: \[(.*)\]", plan)
    assert any("GreaterThan(avgTmprC,0.0)" in p for p in pushed)
    assert any("IsNotNull(hotel_id)" in p and "IsNotNull(srch_ci)" in p for p in pushed)


def test_filters_on_the_result_reach_both_scans(wide):
    plan = plan_of(enrich(*wide).where("hotel_id = 5 AND srch_ci = '2016-01-06'"))
    pushed = re.findall(r"PushedFilters: \[(.*)\]", plan)
    for column in ("hotel_id,5", "srch_ci,2016-01-06", "wthrDate,2016-01-06"):
        assert any(f"EqualTo({column})" in p for p in pushed), column


def test_mean_is_not_computed_where_it_is_not_shown(wide):
    assert "avg(" not in plan_of(popular_stays(*wide))
    assert "avg(" in plan_of(enrich(*wide))


def test_copies_are_collapsed_before_they_are_shuffled(wide):
    plan = plan_of(distinct_bookings(wide[0]), "simple")
    assert plan.index("HashAggregate") < plan.index("Exchange") < plan.rindex("HashAggregate")
    assert len(exchanges(plan)) == 1


def test_counting_first_shuffles_bookings_once(spark, wide):
    with settings(spark, MERGE_JOIN):
        plan = plan_of(popular_stays_counting_first(*wide), "simple")
    by_booking = [e for e in exchanges(plan) if "order_id" in e]
    assert len(by_booking) == 1
    # the counts by hotel-day lie where the join needs them
    assert sum(bool(re.match(r"hotel_id#\w+, srch_ci#\w+, \d+$", e)) for e in exchanges(plan)) == 1


def test_only_fast_aggregates(spark, wide):
    for run in (popular_stays, popular_stays_counting_first, enrich):
        plan = plan_of(run(*wide), "simple")
        assert "SortAggregate" not in plan
        assert "ObjectHashAggregate" not in plan


def test_copies_are_removed_after_a_shuffle_of_the_whole_key(spark, wide):
    """Else AQE could not split a hotel-day that is too large for one task."""
    with settings(spark, MERGE_JOIN):
        plan = plan_of(enrich(*wide), "simple")
    above_the_join = plan.split("SortMergeJoin")[0]
    assert len(exchanges(above_the_join)) == 1
    assert above_the_join.count("HashAggregate") == 2


def test_weather_of_a_hotel_is_spread_by_day(spark, sf_dir):
    """Also where a join by hotel comes before."""
    with settings(spark, MERGE_JOIN):
        plan = plan_of(weather_means(fixtures.weather(spark, sf_dir)), "simple")
    above_the_join = plan.split("SortMergeJoin")[0]
    assert len(exchanges(above_the_join)) == 1
    assert above_the_join.count("HashAggregate") == 2


@pytest.mark.parametrize(
    ("join", "hash_limit"), [("SortMergeJoin", "0"), ("ShuffledHashJoin", "20m")]
)
def test_a_hotel_day_with_a_third_of_the_bookings_is_split(spark, join, hash_limit):
    """One hot day, and a booking whose copies are another third."""
    day = "2016-05-01"
    spread = F.concat(F.lit("2016-06-"), F.lpad(F.col("id") % 28 + 1, 2, "0"))
    rows = spark.range(60_000, numPartitions=8)
    third = F.col("id") % 3
    bookings = rows.select(
        F.when(third == 1, -1).otherwise(F.col("id")).alias("id"),
        F.when(third == 2, F.col("id") % 500).otherwise(0).alias("hotel_id"),
        F.when(third == 2, spread).otherwise(day).alias("srch_ci"),
        F.lit("2016-05-04").alias("srch_co"),
        F.lit(0).alias("srch_children_cnt"),
    )
    weather = weather_of(spark, [(0, day, 5.0, "Hot")]).unionByName(
        spark.range(14_000).select(
            (F.col("id") % 500).alias("Id"),
            F.concat(F.lit("2016-06-"), F.lpad(F.col("id") % 28 + 1, 2, "0")).alias("wthrDate"),
            F.lit(5.0).alias("avgTmprC"),
            F.lit("Other").alias("Name"),
        )
    )
    low = {
        **MERGE_JOIN,
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
        "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": hash_limit,
    }
    with settings(spark, low):
        result = popular_stays(bookings, weather)
        plan = final_plan(result)
        assert f"{join}(skew=true)" in plan
        counted = {r["hotel_name"]: r for r in result.collect() if r["hotel_name"] == "Hot"}
        assert counted["Hot"]["standart_stay_cnt"] == 20_000 + 1
        again = popular_stays_counting_first(bookings, weather)
        assert rows_of(again) == rows_of(result)


def test_partition_filter_reaches_the_scan(spark, sf_dir):
    plan = plan_of(QUERIES["partition_scan"](spark, sf_dir))
    assert re.search(r"PartitionFilters: \[isnotnull\(year#\w+\), \(year#\w+ = 1996\)\]", plan)


def test_means_are_aggregated_before_their_shuffle(wide):
    plan = plan_of(weather_means(wide[1]), "simple")
    assert plan.index("Exchange") < plan.rindex("partial_avg")


def test_small_weather_is_broadcast_once_measured(spark):
    bookings = bookings_of(spark, [(i, i % 7, "2016-01-01", None, 0) for i in range(100)])
    weather = weather_of(spark, [(1, "2016-01-01", 5.0, "A")])
    sized_at_run_time = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "10m",
    }
    with settings(spark, sized_at_run_time):
        plan = final_plan(popular_stays(bookings, weather))
    assert "BroadcastHashJoin" in plan.split("Initial Plan")[0]


def test_fixture_scans_what_it_needs(spark, sf_dir):
    plan = plan_of(fixtures.bookings(spark, sf_dir))
    schema = re.findall(r"ReadSchema: struct<(.*)>", plan)[0]
    assert set(re.findall(r"(\w+):", schema)) == {
        "l_orderkey",
        "l_suppkey",
        "l_linenumber",
        "l_quantity",
        "l_shipdate",
    }

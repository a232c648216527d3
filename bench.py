"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS (default: all)
the local cores. Every query runs BENCH_RUNS times (default 3) and its best time counts.
"""

from __future__ import annotations

import json
import os
import time
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayscope import GRAINS, classify, fixtures, popular
from stayscope.catalog import QUERIES
from stayscope.operators.bookings import project_bookings, with_stay_days
from stayscope.operators.enrich import ENRICHED_KEYS, join_days
from stayscope.operators.weather import above_temperature, project_weather
from stayscope.plans.stream import popular_stays_stream, static_days
from stayscope.session import settings_for, work_dir
from stayscope.sources.files import read_table_stream
from stayscope.streaming.runner import AVAILABLE_NOW, run_out, run_stream
from stayscope.streaming.sinks import ChangeTable

HEADLINE = [
    "batch_popular_by_hotel",
    "batch_popular_by_hotel_counting_first",
    "popular_by_children",
    "enrich_bookings",
    "distinct_bookings",
    "popular_from_topic",
    "json_topic_infer",
    "partition_scan",
    "stream_scan_bookings",
    "stream_enrich",
    "stream_popular_by_children",
    "stream_popular_by_hotel",
    "stream_popular_collapsed",
    "stream_via_topic",
    "windowed_count",
]


def averaging_after_the_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship in its plainest form, for comparison: join all, then average."""
    readings = above_temperature(project_weather(fixtures.weather(spark, sf_dir)))
    joined = join_days(project_bookings(fixtures.bookings(spark, sf_dir)), readings)
    means = joined.groupBy(*ENRICHED_KEYS).agg(F.avg("avgTmprC").alias("avg_tmpr"))
    return popular(classify(with_stay_days(means)))


def stream_over_six_files(files_per_trigger: int | None):
    """The stream by hotel and children, over bookings in six files."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = work_dir(spark, "bench-stream")
        bookings = fixtures.bookings(spark, sf_dir)
        bookings.repartition(6).write.parquet(f"{root}/bookings")
        stream = read_table_stream(
            spark, f"{root}/bookings", bookings.schema, files_per_trigger=files_per_trigger
        )
        days = static_days(fixtures.weather(spark, sf_dir), f"{root}/days")
        grain = "hotel_children"
        table = ChangeTable(f"{root}/out", GRAINS[grain].keys)
        result = popular_stays_stream(stream, days, grain)
        run_out(run_stream(result, table, f"{root}/checkpoint", "update", AVAILABLE_NOW))
        return table.read(spark)

    return query


def input_bytes(sf_dir: str) -> int:
    return sum(file.stat().st_size for file in Path(sf_dir).rglob("*.parquet"))


def seconds(query, spark: SparkSession, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "*")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("stayscope-bench")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    cores = os.cpu_count() if cpus == "*" else int(cpus)
    for key, value in settings_for(input_bytes(sf_dir), cores).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")

    queries = {name: QUERIES[name] for name in HEADLINE}
    queries["comparison_averaging_after_the_join"] = averaging_after_the_join
    queries["comparison_order_by_sketches"] = QUERIES["batch_popular_by_hotel_adaptive"]
    queries["comparison_stream_in_one_trigger"] = stream_over_six_files(None)
    queries["comparison_stream_in_six_triggers"] = stream_over_six_files(1)
    seconds(queries["batch_popular_by_hotel"], spark, sf_dir)  # start the JVM's compilers
    times = {
        name: round(min(seconds(query, spark, sf_dir) for _ in range(runs)), 3)
        for name, query in queries.items()
    }
    total = sum(t for name, t in times.items() if not name.startswith("comparison"))
    print(
        json.dumps(
            {
                "metric": "headline queries, total of best times",
                "value": round(total, 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()

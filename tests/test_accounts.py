"""Every counter against rows planted for it."""

import json

import pytest
from helpers import bookings_of, rows_of, same, weather_of
from pyspark.sql import Observation
from pyspark.sql import functions as F

from stayscope import popular_stays
from stayscope.operators.enrich import enrich_with_days
from stayscope.operators.weather import weather_means
from stayscope.plans.stream import popular_stays_stream, static_days
from stayscope.sources.files import read_table_stream
from stayscope.streaming.accounts import Accounts, lost_messages, observed_bookings, observed_messages
from stayscope.streaming.runner import AVAILABLE_NOW, Target, run_out, run_stream
from stayscope.streaming.sinks import ChangeTable
from stayscope.streaming.windows import windowed_count

DAY = "2017-08-24"
BOOKINGS = [(i, 1, DAY, None, 0) for i in range(5)] + [(0, 1, DAY, None, 0)]
NULL_KEYS = [(50, None, DAY, None, 0), (51, 1, None, None, 0), (52, None, None, None, 0)]
UNMATCHED = [(60 + i, 2, DAY, None, 0) for i in range(4)]
WEATHER = [(1, DAY, 5.0, "A"), (1, DAY, 6.0, "B")]


def wait_for(spark, accounts, name, counter, wanted):
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    for _ in range(100):
        if accounts.totals.get(name, {}).get(counter) == wanted:
            break
        __import__("time").sleep(0.1)
    return accounts.totals


def test_a_stream_counts_what_it_leaves_out(spark, tmp_path):
    bookings = bookings_of(spark, [*BOOKINGS, *NULL_KEYS, *UNMATCHED])
    bookings.repartition(3).write.parquet(f"{tmp_path}/in")
    days = static_days(weather_of(spark, WEATHER), f"{tmp_path}/days")
    accounts = Accounts().listen(spark)
    try:
        stream = observed_bookings(read_table_stream(spark, f"{tmp_path}/in", bookings.schema, files_per_trigger=1))
        table = ChangeTable(f"{tmp_path}/out", ["hotel_name", "hotel_id"])
        result = popular_stays_stream(stream, days, "hotel", unmatched="join")
        run_out(run_stream(result, table, f"{tmp_path}/cp", "update", AVAILABLE_NOW))
        totals = wait_for(spark, accounts, "bookings", "rows", 13)
    finally:
        accounts.stop(spark)
    assert totals["bookings"] == {"rows": 13, "null_keys": 3}
    assert totals["join"] == {"matched": 12, "unmatched": 4}  # six bookings under two names; copies count
    assert totals["queries"] == {"late": 0, "lost": 0}
    same(table.read(spark), popular_stays(bookings, weather_of(spark, WEATHER)))


def test_a_batch_counts_the_same(spark):
    bookings = bookings_of(spark, [*BOOKINGS, *NULL_KEYS, *UNMATCHED])
    days = weather_means(weather_of(spark, WEATHER))
    seen, met = Observation("seen"), Observation("met")
    enriched = enrich_with_days(observed_bookings(bookings, seen), days, unmatched=met)
    plain = enrich_with_days(bookings, days)
    assert rows_of(enriched) == rows_of(plain)
    assert seen.get == {"rows": 13, "null_keys": 3}
    assert met.get == {"matched": 12, "unmatched": 7}  # in a batch null keys reach the join


def test_stray_messages(spark):
    texts = ['{"a": 1}', "{}", None, "", "no json", "[1]", "3", '{"a":', None]
    messages = spark.createDataFrame([(t,) for t in texts], "value string")
    seen = Observation("messages")
    observed_messages(messages, seen).write.format("noop").mode("overwrite").save()
    assert seen.get == {"rows": 9, "empty": 2, "malformed": 5}


def test_late_rows(spark, tmp_path):
    accounts = Accounts().listen(spark)
    try:
        for seconds in ([0, 1], [100], [2, 3, 101], [200]):
            times = spark.createDataFrame([(s,) for s in seconds], "s bigint").select(F.timestamp_seconds("s").alias("ts"))
            times.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
            stream = read_table_stream(spark, f"{tmp_path}/in", "ts timestamp")
            counted = windowed_count(stream, "ts").select("window.start", "count")
            run_out(run_stream(counted, Target("parquet", f"{tmp_path}/out"), f"{tmp_path}/cp", "append", AVAILABLE_NOW))
        totals = wait_for(spark, accounts, "queries", "late", 2)
    finally:
        accounts.stop(spark)
    assert totals["queries"]["late"] >= 1


@pytest.mark.parametrize(
    ("start", "end", "rows", "wanted"),
    [
        ({"t": {"0": 5, "1": 7}}, {"t": {"0": 10, "1": 9}}, 7, 0),
        ({"t": {"0": 5, "1": 7}}, {"t": {"0": 10, "1": 9}}, 3, 4),
        ({"t": {"0": 5}}, {"t": {"0": 6, "1": 50}}, 1, 0),  # a partition that is new
        (None, {"t": {"0": 6}}, 6, 0),
        ({"logOffset": 1}, {"logOffset": 4}, 0, 0),  # files
    ],
)
def test_expired_messages(start, end, rows, wanted):
    source = {"startOffset": json.dumps(start) if start else None, "endOffset": json.dumps(end), "numInputRows": rows}
    assert lost_messages(source) == wanted

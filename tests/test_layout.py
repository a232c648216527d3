"""Layouts that spare work, topics that are parsed once, and stage files that do not pile up."""

import re
from pathlib import Path

import pytest
from helpers import finish, plan_of, rows_of, same, weather_of
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from stayscope import enrich, fixtures, popular_stays, weather_means
from stayscope.operators.enrich import finish_batch
from stayscope.operators.popular import GRAINS
from stayscope.plans.stream import popular_stays_collapsed, start_collapsing, static_days
from stayscope.schemas import ENRICHED
from stayscope.session import settings
from stayscope.sources.files import append_files, archived, read_table, read_table_stream
from stayscope.sources.layout import bucketed_inputs, buckets_for, enrich_in_place, join_days_by_month, write_by_month
from stayscope.sources.topics import decode_variants, merged_schema, schema_of_variants, stored_variants
from stayscope.streaming.runner import AVAILABLE_NOW, run_out
from stayscope.streaming.sinks import ChangeTable


def test_only_months_with_weather_are_read(spark, sf_dir, tmp_path):
    bookings, weather = fixtures.bookings(spark, sf_dir), fixtures.weather(spark, sf_dir)
    some = weather.where(F.substring("wthrDate", 1, 7).isin("1995-07", "1996-01"))
    write_by_month(bookings, f"{tmp_path}/bookings")
    stored = read_table(spark, f"{tmp_path}/bookings")
    days = static_days(some, f"{tmp_path}/days").frame
    enriched = finish_batch(join_days_by_month(stored, days))
    assert "dynamicpruning" in plan_of(enriched)
    same(enriched, enrich(bookings, some))
    # the scan of the run knows the folders it read
    enriched.collect()
    scans = re.findall(r"FileScan parquet \[order_id.*", plan_of(enriched, "extended"))
    assert scans and all("dynamicpruning" in s for s in scans)


def test_buckets_are_joined_and_made_distinct_in_place(spark, sf_dir, tmp_path):
    bookings, weather = fixtures.sent_again(fixtures.bookings(spark, sf_dir)), fixtures.weather(spark, sf_dir)
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        tables = bucketed_inputs(spark, bookings, weather_means(weather), "layout_test", str(tmp_path), 4)
        enriched = enrich_in_place(*tables)
        assert "Exchange" not in plan_of(enriched, "simple")
        same(enriched, enrich(bookings, weather))
    for table in ("layout_test_bookings", "layout_test_days"):
        spark.sql(f"DROP TABLE {table}")


# --- topics -----------------------------------------------------------------------------


def messages(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "n bigint, value string")


def test_a_topic_is_read_once(spark, tmp_path):
    messages(spark, ['{"a": 1}']).write.parquet(f"{tmp_path}/topic")
    stored = stored_variants(spark.read.parquet(f"{tmp_path}/topic"), f"{tmp_path}/stored", keep=("n",))
    found = decode_variants(stored, schema_of_variants(stored), keep=("n",))
    plan = plan_of(found, "simple")
    assert plan.count("FileScan") == 1
    assert f"{tmp_path}/topic" not in plan_of(found, "extended")  # neither inference nor decoding goes back to it


def test_fields_that_come_later_and_types_that_widen(spark, tmp_path):
    runs = [['{"a": 1, "b": {"x": "y"}}', "stray", None], ['{"a": 1.5, "c d": [1], "b": {"z": 2}}', '{"a": 7}', "[1]"]]
    schema = StructType()
    for texts in runs:
        stored = stored_variants(messages(spark, texts), str(tmp_path), keep=("n",))
        schema = merged_schema(schema, DataType.fromDDL(schema_of_variants(stored)))
    assert [f.name for f in schema.fields] == ["a", "b", "_corrupt_record", "c d"]
    found = decode_variants(spark.read.parquet(f"{tmp_path}/*"), schema, keep=("n",))
    rows = {(r["a"], r["b"]["x"] if r["b"] else None, tuple(r["c d"] or ()), r["_corrupt_record"]) for r in found.collect()}
    assert rows == {(1.0, "y", (), None), (None, None, (), "stray"), (None, None, (), None), (1.5, None, (1,), None), (7.0, None, (), None), (None, None, (), "[1]")}


@pytest.mark.parametrize(
    ("old", "new", "wanted"),
    [
        ("a bigint", "a bigint", "a bigint"),
        ("a bigint", "a double", "a double"),
        ("a bigint", "a string", "a string"),
        ("a array<bigint>", "a array<double>", "a array<double>"),
        ("a struct<x: bigint>", "b boolean", "a struct<x: bigint>, b boolean"),
        ("a struct<x: bigint>", "a boolean", "a string"),
    ],
)
def test_merged_types(old, new, wanted):
    parse = DataType.fromDDL
    assert merged_schema(parse(old), parse(new)) == parse(wanted)


def test_no_objects_to_infer_from(spark, tmp_path):
    stored = stored_variants(messages(spark, ["1", None]), str(tmp_path))
    with pytest.raises(ValueError, match="no JSON objects"):
        schema_of_variants(stored)


# --- stage ------------------------------------------------------------------------------


def test_the_stage_stays_short_over_many_triggers(spark, sf_dir, tmp_path):
    bookings, weather = fixtures.sent_again(fixtures.bookings(spark, sf_dir)), fixtures.weather(spark, sf_dir)
    days = static_days(weather, f"{tmp_path}/days")
    table = ChangeTable(f"{tmp_path}/out", GRAINS["hotel"].keys)
    stage, left = f"{tmp_path}/stage", []
    for n in range(5):
        part = bookings.where(F.pmod(F.xxhash64("id"), F.lit(5)) == n)
        part.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = read_table_stream(spark, f"{tmp_path}/in", bookings.schema)
        run_out(start_collapsing(stream, days, stage, f"{tmp_path}/first", AVAILABLE_NOW))
        enriched = read_table_stream(spark, stage, ENRICHED, options=archived(f"{tmp_path}/archive"))
        finish(popular_stays_collapsed(enriched, "hotel"), table, f"{tmp_path}/second", "update")
        left.append(len(list(Path(stage).glob("*.parquet"))))
    same(table.read(spark), popular_stays(bookings, weather))
    assert max(left) <= 2 * max(1, left[0])
    assert len(list(Path(tmp_path, "archive").rglob("*.parquet"))) >= 3


def test_weather_without_rows(spark, sf_dir, tmp_path):
    bookings = fixtures.bookings(spark, sf_dir)
    write_by_month(bookings, f"{tmp_path}/bookings")
    days = static_days(weather_of(spark, []), f"{tmp_path}/days").frame
    assert rows_of(finish_batch(join_days_by_month(read_table(spark, f"{tmp_path}/bookings"), days))) == []


def test_weather_that_is_not_small_is_not_broadcast(spark, sf_dir, tmp_path):
    bookings, weather = fixtures.bookings(spark, sf_dir), fixtures.weather(spark, sf_dir)
    write_by_month(bookings, f"{tmp_path}/bookings")
    days = static_days(weather, f"{tmp_path}/days", max_broadcast=0).frame
    with settings(spark, {"spark.sql.adaptive.enabled": "false"}):
        enriched = finish_batch(join_days_by_month(read_table(spark, f"{tmp_path}/bookings"), days))
        plan = plan_of(enriched, "simple")
        assert "SortMergeJoin" in plan and plan.count("BroadcastHashJoin") == 1  # that of the months
        assert "dynamicpruning" in plan
        same(enriched, enrich(bookings, weather))


def test_buckets_grow_in_number_and_not_in_size():
    assert buckets_for(0, 8) == buckets_for(16_000_000, 8) == 8
    assert buckets_for(800_000_000, 8) == 10 * buckets_for(80_000_000, 8) == 400


def test_files_are_as_many_as_tasks(spark, tmp_path):
    rows = spark.range(0, 60, 1, 6).withColumnRenamed("id", "hotel_id")
    assert append_files(rows, f"{tmp_path}/in", 2, "hotel_id") == 6
    assert append_files(rows.coalesce(1), f"{tmp_path}/in", 2, "hotel_id") == 2
    assert append_files(rows.limit(0), f"{tmp_path}/in", 2, "hotel_id") <= 2
    assert read_table(spark, f"{tmp_path}/in").count() == 120

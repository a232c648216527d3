import json
import shutil
import time
from pathlib import Path

import pytest
from helpers import bookings_of, finish, plan_of, rows_of, same, weather_of
from pyspark.sql import functions as F

from stayscope import fixtures, popular_stays, popular_stays_counting_first, weather_means
from stayscope.operators.enrich import enrich, enrich_with_days
from stayscope.operators.popular import GRAINS, popular
from stayscope.plans.stream import (
    StaticDays,
    popular_stays_collapsed,
    popular_stays_stream,
    preferences_stream,
    start_collapsing,
    static_days,
    table_bytes,
)
from stayscope.schemas import ENRICHED, PREFERENCES
from stayscope.session import MIB, settings, work_dir
from stayscope.sources.files import read_table_stream
from stayscope.sources.topics import decode_json, encode_json, read_topic_stream
from stayscope.streaming.runner import AVAILABLE_NOW, Target, run_out, run_stream
from stayscope.streaming.sinks import ChangeTable, SnapshotTable, stamped
from stayscope.streaming.windows import windowed_count

DAY = "2017-08-24"


@pytest.fixture(scope="module")
def inputs(spark, sf_dir):
    """Bookings in six files, with copies in several of them, and the weather."""
    path = work_dir(spark, "bookings")
    bookings = fixtures.sent_again(fixtures.bookings(spark, sf_dir))
    bookings.repartition(6, F.rand(7)).write.parquet(path)
    stored = spark.read.parquet(path)
    weather = fixtures.weather(spark, sf_dir)
    return path, stored, weather


@pytest.fixture(scope="module")
def days(spark, inputs):
    return static_days(inputs[2], work_dir(spark, "days"))


def stream_of(spark, inputs, files_per_trigger=None):
    return read_table_stream(
        spark, inputs[0], inputs[1].schema, files_per_trigger=files_per_trigger
    )


def run_popular(spark, bookings, days, grain, root, **dedup):
    table = ChangeTable(f"{root}/out", GRAINS[grain].keys)
    result = popular_stays_stream(bookings, days, grain, **dedup)
    finish(result, table, f"{root}/checkpoint", "update")
    return GRAINS[grain].visible(table.read(spark))


@pytest.mark.parametrize("grain", list(GRAINS))
@pytest.mark.parametrize("files_per_trigger", [1, None])
def test_stream_equals_batch(spark, inputs, days, tmp_path, grain, files_per_trigger):
    stream = stream_of(spark, inputs, files_per_trigger)
    result = run_popular(spark, stream, days, grain, tmp_path)
    same(result, popular_stays(inputs[1], inputs[2], grain))
    for folder in (tmp_path / "out" / "data").iterdir():
        assert len(list(folder.glob("*.parquet"))) == 1


@pytest.mark.parametrize("copy_salts", [0, 3, 8])
def test_salted_sort_merge_join_equals_batch(spark, inputs, tmp_path, copy_salts):
    salted = static_days(inputs[2], str(tmp_path / "days"), max_broadcast=0, salts=4)
    assert salted.join_salts == 4
    stream = stream_of(spark, inputs, 2)
    result = run_popular(spark, stream, salted, "hotel", tmp_path, copy_salts=copy_salts)
    same(result, popular_stays(inputs[1], inputs[2]))


def test_salting_splits_one_hotel_day_and_one_booking(spark):
    from stayscope.operators.enrich import booking_salt

    one_booking = spark.range(8000, numPartitions=8).select(F.lit(5).alias("order_id"))
    one_day = spark.range(8000, numPartitions=1).select(F.col("id").alias("order_id"))
    for frame in (one_booking, one_day):
        shares = frame.groupBy(booking_salt(8).alias("salt")).count().collect()
        assert len(shares) == 8
        assert max(r["count"] for r in shares) < 1300


def test_enriched_stream_keeps_the_mean(spark, inputs, days, tmp_path):
    enriched = enrich_with_days(stream_of(spark, inputs, 1), days.frame, days.join_salts)
    finish(enriched, Target("parquet", str(tmp_path / "out")), str(tmp_path / "cp"), "append")
    same(spark.read.parquet(str(tmp_path / "out")), enrich(inputs[1], inputs[2]))


def test_enrich_of_a_stream_and_raw_weather(spark, inputs, tmp_path):
    enriched = enrich(stream_of(spark, inputs), inputs[2])
    assert enriched.isStreaming
    finish(enriched, Target("parquet", str(tmp_path / "out")), str(tmp_path / "cp"), "append")
    same(spark.read.parquet(str(tmp_path / "out")), enrich(inputs[1], inputs[2]))


def test_one_function_for_both_kinds_of_bookings(spark, inputs, tmp_path):
    stream = stream_of(spark, inputs)
    result = popular_stays(stream, inputs[2], "hotel_children")
    assert result.isStreaming
    assert len(result.columns) == 9
    target = Target("memory", name="popular_in_memory")
    finish(result, target, str(tmp_path / "cp"), "complete")
    same(spark.table("popular_in_memory"), popular_stays(inputs[1], inputs[2], "hotel_children"))
    with pytest.raises(ValueError, match="joined first"):
        popular_stays_counting_first(stream, inputs[2])


def test_restart_and_resent_files_change_nothing(spark, inputs, days, tmp_path):
    files = sorted(Path(inputs[0]).glob("*.parquet"))
    arriving = tmp_path / "arriving"
    arriving.mkdir()
    for file in files[:3]:
        shutil.copy(file, arriving)
    table = ChangeTable(str(tmp_path / "out"), GRAINS["hotel"].keys)

    def run():
        stream = read_table_stream(
            spark, str(arriving), inputs[1].schema, files_per_trigger=1
        )
        finish(popular_stays_stream(stream, days, "hotel"), table, str(tmp_path / "cp"), "update")

    run()
    partial = popular_stays(spark.read.parquet(str(arriving)), inputs[2])
    same(table.read(spark), partial)
    for file in files[3:]:
        shutil.copy(file, arriving)
    for file in files[:2]:
        shutil.copy(file, arriving / f"again-{file.name}")
    run()
    same(table.read(spark), popular_stays(inputs[1], inputs[2]))


def test_a_batch_that_runs_again_after_a_failure_counts_once(spark, inputs, days, tmp_path):
    table = ChangeTable(str(tmp_path / "out"), GRAINS["hotel"].keys)
    failed = []

    def fail_after_writing(batch, batch_id):
        table(batch, batch_id)
        if batch_id == 2 and not failed:
            failed.append(batch_id)
            raise RuntimeError("lost after the write")

    def run():
        result = popular_stays_stream(stream_of(spark, inputs, 1), days, "hotel")
        checkpoint = str(tmp_path / "cp")
        run_out(run_stream(result, fail_after_writing, checkpoint, "update", AVAILABLE_NOW))

    with pytest.raises(Exception, match="lost after the write"):
        run()
    run()
    assert failed == [2]
    same(table.read(spark), popular_stays(inputs[1], inputs[2]))


def test_snapshot_in_complete_mode(spark, inputs, days, tmp_path):
    snapshot = SnapshotTable(str(tmp_path / "out"))
    result = stamped(popular_stays_stream(stream_of(spark, inputs, 2), days, "hotel"))
    finish(result, snapshot, str(tmp_path / "cp"), "complete")
    stored = snapshot.read(spark)
    assert stored.select("timestamp").distinct().count() == 1
    same(stored.drop("timestamp"), popular_stays(inputs[1], inputs[2]))


def test_two_queries_over_a_topic(spark, inputs, days, tmp_path):
    topic = str(tmp_path / "topic")
    preferences = preferences_stream(stream_of(spark, inputs, 1), days)
    finish(encode_json(preferences), Target("text", topic), str(tmp_path / "cp1"), "append")

    table = ChangeTable(str(tmp_path / "out"), GRAINS["hotel_children"].keys)
    received = decode_json(read_topic_stream(spark, {}, "text", topic), PREFERENCES)
    counted = popular(received, "hotel_children", keep_keys=True)
    finish(counted, table, str(tmp_path / "cp2"), "update")
    result = GRAINS["hotel_children"].visible(table.read(spark))
    same(result, popular_stays(inputs[1], inputs[2], "hotel_children"))


def test_two_queries_over_collapsed_files(spark, inputs, days, tmp_path):
    stage, checkpoint = str(tmp_path / "stage"), str(tmp_path / "cp1")
    failed = []

    class Broken:
        """Days that fail once, in the second micro-batch."""

        calls = 0

        @property
        def frame(self):
            self.calls += 1
            if self.calls == 2 and not failed:
                failed.append(True)
                raise RuntimeError("lost")
            return days.frame

    def collapse(static):
        stream = stream_of(spark, inputs, 2)
        run_out(start_collapsing(stream, static, stage, checkpoint, AVAILABLE_NOW))

    with pytest.raises(Exception, match="lost"):
        collapse(Broken())
    collapse(days)
    rows = spark.read.parquet(stage).count()
    assert rows < enrich_with_days(inputs[1], days.frame).count() * 3

    for grain in GRAINS:
        table = ChangeTable(str(tmp_path / f"out-{grain}"), GRAINS[grain].keys)
        enriched = read_table_stream(spark, stage, ENRICHED, files_per_trigger=3)
        result = popular_stays_collapsed(enriched, grain)
        finish(result, table, str(tmp_path / f"cp-{grain}"), "update")
        shown = GRAINS[grain].visible(table.read(spark))
        same(shown, popular_stays(inputs[1], inputs[2], grain))


def test_second_query_may_start_first(spark, inputs, days, tmp_path):
    empty = inputs[1].limit(0)
    empty.write.parquet(str(tmp_path / "in"))
    stream = read_table_stream(spark, str(tmp_path / "in"), empty.schema)
    stage = str(tmp_path / "stage")
    run_out(start_collapsing(stream, days, stage, str(tmp_path / "cp"), AVAILABLE_NOW))
    schema = spark.read.parquet(stage).schema
    assert schema == ENRICHED
    assert schema == enrich_with_days(inputs[1], days.frame).schema


def test_late_new_bookings_are_counted_and_copies_are_not(spark, tmp_path):
    schema = (
        "id bigint, hotel_id bigint, srch_ci string, srch_co string, "
        "srch_children_cnt int, date_time string"
    )
    days_of_booking = ["2017-08-20", "2017-08-01", None, "garbage", "2017-07-01"]
    rows = [
        (50 * n + i % 50, 1, DAY, "2017-08-26", 0, at)
        for n, at in enumerate(days_of_booking)
        for i in range(100)
    ]
    bookings = spark.createDataFrame(rows, schema)
    for n in range(len(days_of_booking)):
        some = bookings.where(f"id >= {50 * n} AND id < {50 * n + 50}")
        some.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    bookings.where("id < 60").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    weather = weather_of(spark, [(1, DAY, 5.0, "A")])
    days = static_days(weather, str(tmp_path / "days"))
    stream = read_table_stream(spark, str(tmp_path / "in"), bookings.schema, files_per_trigger=1)
    result = run_popular(spark, stream, days, "hotel", tmp_path, copies_within="1 day")
    same(result, popular_stays(bookings, weather))
    assert result.first()["standart_stay_cnt"] == 250


def test_size_of_the_days_decides_the_join(spark, tmp_path):
    weather = weather_of(spark, [(1, DAY, 5.0, "name" * 100), (2, DAY, 5.0, None)])
    days = weather_means(weather)
    assert table_bytes(days) == (80 + 10 + 400) + (80 + 10)
    assert table_bytes(days.limit(0)) == 0
    small = static_days(weather, str(tmp_path / "small"))
    assert small.join_salts == 1
    bookings = bookings_of(spark, [(1, 1, DAY, DAY, 0)])
    assert "BroadcastHashJoin" in plan_of(enrich_with_days(bookings, small.frame))
    assert static_days(weather, str(tmp_path / "large"), max_broadcast=100).join_salts > 1


def test_days_that_are_not_small_are_merged(spark, inputs, tmp_path):
    days = static_days(inputs[2], str(tmp_path / "days"), max_broadcast=0)
    with settings(spark, {"spark.sql.adaptive.enabled": "false"}):
        for bookings in (inputs[1], stream_of(spark, inputs, 1)):
            plan = plan_of(enrich_with_days(bookings, days.frame, days.join_salts))
            assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_state_is_kept_by_rocksdb(spark, inputs, days, tmp_path):
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)
    run_popular(spark, stream_of(spark, inputs), days, "hotel", tmp_path)
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass", None) == before
    offsets = (tmp_path / "checkpoint" / "offsets" / "0").read_text().splitlines()
    assert "RocksDB" in json.loads(offsets[1])["conf"][
        "spark.sql.streaming.stateStore.providerClass"
    ]


def test_number_of_state_partitions(spark, inputs, days, tmp_path):
    table = ChangeTable(str(tmp_path / "out"), GRAINS["hotel"].keys)
    result = popular_stays_stream(stream_of(spark, inputs), days, "hotel")
    checkpoint = str(tmp_path / "cp")
    run_out(run_stream(result, table, checkpoint, "update", AVAILABLE_NOW, partitions=3))
    run_out(run_stream(result, table, checkpoint, "update", AVAILABLE_NOW, partitions=5))
    assert len(list((tmp_path / "cp" / "state" / "0").glob("[0-9]*"))) == 3
    assert spark.conf.get("spark.sql.shuffle.partitions") == "4"


def local_files(spark):
    """Files of shuffles, and folders of stores, on the disks of this process."""
    jvm = spark._jvm.org.apache.spark
    blocks = jvm.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n").split("\n")
    stores = Path(jvm.util.Utils.getLocalDir(spark.sparkContext._jsc.sc().conf())).rglob("StateStoreId*")
    return {b for b in blocks if "/shuffle_" in b}, set(stores)


def test_what_a_stream_leaves_on_local_disks(spark, inputs, tmp_path):
    shuffles, stores = local_files(spark)
    merged = static_days(inputs[2], str(tmp_path / "days"), max_broadcast=0, salts=4)
    result = popular_stays_stream(stream_of(spark, inputs, 2), merged, "hotel", copies_within="1 day")
    query = run_stream(result, ChangeTable(str(tmp_path / "out"), GRAINS["hotel"].keys), str(tmp_path / "cp"), "update", AVAILABLE_NOW)
    run_out(query)
    until = time.time() + 20  # files go in the background
    while (left := local_files(spark)[0] - shuffles) and time.time() < until:
        time.sleep(0.2)
    assert not left
    taken = {store: sum(f.stat().st_blocks * 512 for f in store.rglob("*")) for store in local_files(spark)[1] - stores}
    assert taken and max(taken.values()) < MIB


def events_of(spark, path, seconds, files=1):
    times = spark.createDataFrame([(s,) for s in seconds], "s bigint")
    frame = times.select(F.timestamp_seconds("s").alias("ts"))
    frame.coalesce(files).write.mode("append").parquet(path)


def test_windows_come_out_once_closed_and_late_rows_are_dropped(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")

    def run():
        stream = read_table_stream(spark, source, "ts timestamp", files_per_trigger=1)
        counted = windowed_count(stream, "ts").select(
            F.unix_timestamp(F.col("window.start")).alias("start"), "count"
        )
        finish(counted, Target("parquet", out), str(tmp_path / "cp"), "append")
        return rows_of(spark.read.parquet(out), ["start", "count"])

    events_of(spark, source, [0, 1, 4, 5, 9])
    assert run() == []  # watermark 4: no window has ended
    events_of(spark, source, [3, 12])
    assert run() == [(0, 4)]  # watermark 7; the event at 3 was in time
    events_of(spark, source, [2, 6, 30])
    assert run() == [(0, 4), (10, 1), (5, 3)]  # the event at 2 was late


def test_micro_batches_can_be_bounded_by_bytes(spark, inputs, days, tmp_path):
    stream = read_table_stream(
        spark, inputs[0], inputs[1].schema, options={"maxBytesPerTrigger": "1"}
    )
    result = run_popular(spark, stream, days, "hotel", tmp_path)
    same(result, popular_stays(inputs[1], inputs[2]))
    assert len(list((tmp_path / "checkpoint" / "commits").glob("[0-9]*"))) >= 6


def test_static_days_with_no_match(spark, inputs, tmp_path):
    nowhere = StaticDays(weather_means(weather_of(spark, [(-1, DAY, 5.0, "A")])), 1)
    result = run_popular(spark, stream_of(spark, inputs), nowhere, "hotel", tmp_path)
    assert result.count() == 0

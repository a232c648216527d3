"""Streams in which the weather arrives too, and the table of sums that they add to."""

import time
from pathlib import Path

import pytest
from helpers import bookings_of, rows_of, same, weather_of
from pyspark.sql import functions as F

from stayscope import fixtures, popular_stays
from stayscope.operators.popular import GRAINS
from stayscope.plans.live import counting, counts_table, live_preferences, popular_so_far, start_live
from stayscope.session import work_dir
from stayscope.sources.files import read_table_stream
from stayscope.streaming.runner import AVAILABLE_NOW, run_out, run_stream
from stayscope.streaming.sinks import SumTable, Versions

DAY = "2017-08-24"


class Feed:
    """Two folders that files arrive in, and the query over them."""

    def __init__(self, spark, root, bookings, weather):
        self.spark, self.root, self.frames = spark, str(root), {"bookings": bookings, "weather": weather}
        for name, frame in self.frames.items():
            frame.limit(0).write.parquet(f"{root}/{name}")

    def arrive(self, **frames):
        for name, frame in frames.items():
            frame.write.mode("append").parquet(f"{self.root}/{name}")

    def streams(self, files=None):
        return [read_table_stream(self.spark, f"{self.root}/{n}", f.schema, files_per_trigger=files) for n, f in self.frames.items()]

    def run(self, grain="hotel", files=None, **options):
        query = start_live(*self.streams(files), f"{self.root}/out", f"{self.root}/cp", grain, AVAILABLE_NOW, **options)
        run_out(query)
        return query

    def result(self, grain="hotel"):
        return popular_so_far(self.spark, counts_table(f"{self.root}/out", grain), grain)


@pytest.fixture(scope="module")
def inputs(spark, sf_dir):
    bookings = fixtures.sent_again(fixtures.bookings(spark, sf_dir))
    path = work_dir(spark, "live")
    bookings.write.parquet(f"{path}/bookings")
    fixtures.weather(spark, sf_dir).write.parquet(f"{path}/weather")
    return spark.read.parquet(f"{path}/bookings"), spark.read.parquet(f"{path}/weather")


@pytest.mark.parametrize(
    ("grain", "salts", "weather_first"),
    [("hotel", {}, False), ("hotel_children", {"join_salts": 3, "copy_salts": 4}, False), ("hotel", {"join_salts": 2}, True)],
)
def test_the_order_of_arrival_does_not_matter(spark, inputs, tmp_path, grain, salts, weather_first):
    bookings, weather = inputs
    feed = Feed(spark, tmp_path, bookings, weather)
    half = F.pmod(F.xxhash64("Id", "wthrDate", "avgTmprC"), F.lit(2))
    steps = [{"bookings": bookings}, {"weather": weather.where(half == 0)}, {"weather": weather.where(half == 1)}]
    for step in reversed(steps) if weather_first else steps:
        feed.arrive(**step)
        feed.run(grain, **salts)
    same(feed.result(grain), popular_stays(bookings, weather, grain))


def test_a_booking_waits_until_its_day_is_warm(spark, tmp_path):
    bookings = bookings_of(spark, [(1, 1, DAY, "2017-08-25", 0), (2, 2, DAY, None, 1), (3, None, DAY, None, 0), (4, 1, None, None, 0)])
    cold = weather_of(spark, [(1, DAY, 0.0, "A"), (2, DAY, None, "B"), (None, DAY, 9.0, "C"), (1, None, 9.0, "D")])
    warm = weather_of(spark, [(1, DAY, 0.1, "A"), (1, DAY, 7.0, "A"), (1, DAY, 7.0, "A2"), (1, DAY, 8.0, None)])
    feed = Feed(spark, tmp_path, bookings, cold)
    feed.arrive(bookings=bookings, weather=cold)
    feed.run()
    assert feed.result().count() == 0
    feed.arrive(weather=warm)
    feed.run()
    feed.arrive(bookings=bookings)  # sent again
    feed.run()
    same(feed.result(), popular_stays(bookings, cold.union(warm)))
    assert rows_of(feed.result(), ["hotel_name", "short_stay_cnt"]) == sorted([("A", 1), ("A2", 1), (None, 1)], key=repr)


def test_patience_bounds_what_waits(spark, tmp_path):
    def booking(i, day=DAY):
        return bookings_of(spark, [(i, 1, day, None, 0)])

    def reading(day):
        return weather_of(spark, [(1, day, 5.0, "A")])

    feed = Feed(spark, tmp_path, booking(1), reading(DAY))
    patience = {"patience": "1 second", "copies_within": "0 seconds"}
    waiting = []
    for n in range(4):
        many = bookings_of(spark, [(100 * n + i, 7, DAY, None, 0) for i in range(50)])
        feed.arrive(bookings=booking(1000 + n, f"2017-09-0{n + 1}").union(many), weather=reading(f"2017-10-0{n + 1}"))
        query = feed.run(**patience)
        state = query.lastProgress["stateOperators"]
        waiting.append(sum(s["numRowsTotal"] for s in state if s["operatorName"] == "symmetricHashJoin"))
        time.sleep(1.5)
    feed.arrive(weather=weather_of(spark, [(1, "2017-09-01", 5.0, "A"), (1, "2017-09-04", 5.0, "A")]), bookings=booking(5))
    feed.run(**patience)
    # the first booking has waited too long; all but the latest have left the state
    assert feed.result().count() == 0 or feed.result().first()["erroneous_data_cnt"] == 1
    assert max(waiting) < 3 * 51 + 4


def test_a_batch_that_fails_after_its_write_counts_once(spark, inputs, tmp_path):
    bookings, weather = inputs
    feed = Feed(spark, tmp_path, bookings, weather)
    feed.arrive(bookings=bookings.repartition(3), weather=weather)
    add = counting(counts_table(f"{tmp_path}/out", "hotel"), "hotel")
    failed = []

    def fails_once(batch, batch_id):
        add(batch, batch_id)
        if batch_id == 1 and not failed:
            failed.append(batch_id)
            raise RuntimeError("lost after the write")

    def run():
        found = live_preferences(*feed.streams(files=1))
        run_out(run_stream(found, fails_once, f"{tmp_path}/cp", "append", AVAILABLE_NOW))

    with pytest.raises(Exception, match="lost after the write"):
        run()
    run()
    same(feed.result(), popular_stays(bookings, weather))


def counts(spark, rows):
    return spark.createDataFrame(rows, "name string, n bigint")


def test_sums_over_merges_and_batches_that_run_again(spark, tmp_path):
    sums = SumTable(str(tmp_path / "sums"), ["name"], ["n"], merge_every=3)
    for batch_id in (0, 0, 1, 2, 2, 3, 3, 4, 5, 6, 6, 7):
        sums(counts(spark, [("A", 1), (None, batch_id)]), batch_id)
    assert rows_of(sums.read(spark), ["name", "n"]) == sorted([("A", 8), (None, sum(range(8)))], key=repr)
    assert len(Versions(sums.path).current(spark)) == 3  # the sums up to 5, batches 6 and 7
    assert len(list(Path(sums.path, "data").iterdir())) <= 6
    with pytest.raises(ValueError, match="before the last merge"):
        sums(counts(spark, [("A", 1)]), 2)
    sums(counts(spark, [("B", 5)]), 0)  # a new checkpoint
    assert rows_of(sums.read(spark), ["name", "n"]) == [("B", 5)]


def test_sums_without_rows(spark, tmp_path):
    sums = SumTable(str(tmp_path / "sums"), ["name"], ["n"])
    sums(counts(spark, []), 0)
    assert sums.read(spark).collect() == []


def test_both_grains_have_their_keys(spark, tmp_path):
    for grain, level in GRAINS.items():
        assert tuple(counts_table(str(tmp_path), grain).keys) == level.keys


@pytest.mark.parametrize(("options", "counted"), [({}, False), ({"copies_within": "1 hour"}, True)])
def test_state_of_the_join_is_one_store_and_counted_if_bounded(spark, tmp_path, options, counted):
    bookings, weather = bookings_of(spark, [(1, 1, DAY, None, 0), (2, 7, DAY, None, 0)]), weather_of(spark, [(1, DAY, 5.0, "A")])
    feed = Feed(spark, tmp_path, bookings, weather)
    feed.arrive(bookings=bookings, weather=weather)
    state = [s for s in feed.run(**options).recentProgress[0]["stateOperators"] if s["operatorName"] == "symmetricHashJoin"]
    assert '"spark.sql.streaming.join.stateFormatVersion":"3"' in (tmp_path / "cp" / "offsets" / "0").read_text()
    assert (state[0]["numRowsTotal"] > 0) == counted
    assert feed.result().first()["erroneous_data_cnt"] == 1


def test_an_ending_query_leaves_snapshots_that_others_go_on_from(spark, tmp_path):
    bookings = bookings_of(spark, [(i, i % 5, DAY, None, 0) for i in range(40)])
    weather = weather_of(spark, [(i, DAY, 5.0, "A") for i in range(5)])
    feed = Feed(spark, tmp_path, bookings, weather)
    state, commits = tmp_path / "cp" / "state", tmp_path / "cp" / "commits"
    feed.arrive(bookings=bookings.where("id < 10"), weather=weather.where("Id < 2"))
    feed.run()
    feed.arrive(bookings=bookings.where("id < 20"))
    feed.run()
    assert list(state.rglob("*.zip")) and not list(state.rglob("*.changelog"))
    assert len(list(commits.glob("[0-9]*"))) == 2  # none without data

    feed.arrive(bookings=bookings.where("id < 30"), weather=weather.where("Id < 4"))
    query = start_live(*feed.streams(), f"{tmp_path}/out", f"{tmp_path}/cp", "hotel", {"processingTime": "0 seconds"})
    query.processAllAvailable()
    query.stop()
    assert list(state.rglob("*.changelog"))
    feed.arrive(bookings=bookings, weather=weather)
    feed.run()
    same(feed.result(), popular_stays(bookings, weather))

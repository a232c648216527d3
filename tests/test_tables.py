"""Tables replaced in one step, the result that follows them, and windows that late events amend."""

import json
from pathlib import Path

import pytest
from helpers import bookings_of, rows_of, same, weather_of
from pyspark.sql import functions as F

from stayscope import fixtures, popular_stays
from stayscope.plans.incremental import PopularityView
from stayscope.sources import tables
from stayscope.sources.files import read_table_stream
from stayscope.sources.tables import AtomicTable, ConflictError
from stayscope.streaming.runner import AVAILABLE_NOW, run_out, run_stream
from stayscope.streaming.windows import AmendedWindows


def frame(spark, rows):
    return spark.createDataFrame(rows, "a bigint, p string")


def test_a_write_that_is_lost_leaves_the_version_before(spark, tmp_path):
    table = AtomicTable(str(tmp_path / "t"))
    table.replace(frame(spark, [(1, "x")]))
    boom = F.udf(lambda a: 1 // 0, "bigint")
    with pytest.raises(Exception, match="ZeroDivision"):
        table.replace(spark.range(1000).repartition(4).select(F.when(F.col("id") == 999, boom("id")).otherwise(F.col("id")).alias("a"), F.lit("y").alias("p")))
    assert rows_of(table.read(spark)) == [(1, "x")]
    assert table.replace(frame(spark, [(2, "z")])).number == 2
    assert rows_of(table.read(spark)) == [(2, "z")]
    assert rows_of(table.read(spark, table.version(spark, 1))) == [(1, "x")]


def test_files_without_a_manifest_are_not_seen(spark, tmp_path, monkeypatch):
    """The writer is killed between its files and its manifest."""
    table = AtomicTable(str(tmp_path / "t"), ["p"])
    table.replace(frame(spark, [(1, "x"), (2, "y")]))

    def killed(self, session, version):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch, pytest.raises(KeyboardInterrupt):
        patch.setattr(AtomicTable, "_commit", killed)
        table.replace_partitions(frame(spark, [(9, "x")]))
    assert rows_of(table.read(spark)) == [(1, "x"), (2, "y")]
    before = len(list((tmp_path / "t" / "data").glob("p=x/*")))
    table.replace_partitions(frame(spark, [(3, "x")]))
    assert rows_of(table.read(spark)) == [(2, "y"), (3, "x")]
    table.vacuum(spark, keep=1)
    assert before == 2
    assert len(list((tmp_path / "t" / "data").glob("p=x/*"))) == 1
    assert rows_of(table.read(spark)) == [(2, "y"), (3, "x")]


def test_a_manifest_that_was_lost_while_it_was_written(spark, tmp_path):
    table = AtomicTable(str(tmp_path / "t"))
    table.replace(frame(spark, [(1, "x")]))
    Path(table.path, "manifests", f"{2:012d}.json").write_text('{"number": 2, "fol')
    assert table.current(spark).number == 1
    assert rows_of(table.read(spark)) == [(1, "x")]


@pytest.mark.parametrize("store", [False, True])
def test_of_two_writers_one_succeeds(spark, tmp_path, monkeypatch, store):
    if store:  # as on a store that creates files in one step
        monkeypatch.setattr(tables, "STORES", ("file",))
    table = AtomicTable(str(tmp_path / "t"))
    seen = table.replace(frame(spark, [(0, "x")]))
    table.replace(frame(spark, [(1, "x")]), since=seen)
    with pytest.raises(ConflictError):
        table.replace(frame(spark, [(2, "x")]), since=seen)
    assert rows_of(table.read(spark)) == [(1, "x")]


def test_partitions_of_odd_names_and_none(spark, tmp_path):
    table = AtomicTable(str(tmp_path / "t"), ["p"])
    rows = [(1, "a/b=c"), (2, None), (3, "01"), (4, "é %")]
    table.replace(frame(spark, rows))
    assert rows_of(table.read(spark)) == sorted(rows, key=repr)
    table.replace_partitions(frame(spark, [(5, "01"), (6, "new")]))
    kept = [r for r in rows if r[0] != 3]
    assert rows_of(table.read(spark)) == sorted([*kept, (5, "01"), (6, "new")], key=repr)
    version = table.current(spark)
    table.drop_partitions(spark, [p for p in version.folders if p.endswith("new")])
    assert table.read(spark).count() == 4
    table.replace(frame(spark, []))
    assert table.read(spark).collect() == []
    with pytest.raises(FileNotFoundError):
        AtomicTable(str(tmp_path / "none")).read(spark)
    with pytest.raises(ValueError, match="no partitions"):
        AtomicTable(str(tmp_path / "plain")).replace_partitions(frame(spark, rows))


# --- the result that follows ------------------------------------------------------------


@pytest.mark.parametrize("grain", ["hotel", "hotel_children"])
def test_the_result_follows_bookings_and_weather(spark, sf_dir, tmp_path, grain):
    bookings, weather = fixtures.bookings(spark, sf_dir), fixtures.weather(spark, sf_dir)
    year = F.substring("srch_ci", 1, 4)
    view = PopularityView(str(tmp_path), grain)
    view.replace_bookings(fixtures.sent_again(bookings.where(year < "1996")))
    view.replace_weather(weather)
    view.refresh(spark)
    same(view.read(spark), popular_stays(bookings.where(year < "1996"), weather, grain))

    view.replace_bookings(bookings.where(year == "1996"))
    assert {m[:4] for m in view.refresh(spark)} == {"1996"}  # no other months are read
    same(view.read(spark), popular_stays(bookings.where(year <= "1996"), weather, grain))
    assert view.refresh(spark) == set()

    # a month turns cold, another one warm, and a third loses its bookings but for one
    cold, warm, lost = "1995-07", "1995-08", "1996-03"
    month = F.substring("wthrDate", 1, 7)
    changed = weather.withColumn("avgTmprC", F.when(month == cold, -1.0).when(month == warm, 9.0).otherwise(F.col("avgTmprC")))
    view.replace_weather(changed.where(month.isin(cold, warm)))
    left = bookings.where(year <= "1996").where(~F.col("srch_ci").startswith(lost) | (F.col("id") % 97 == 0))
    view.replace_bookings(left.where(F.col("srch_ci").startswith(lost)))
    assert view.refresh(spark) <= {cold, warm, lost}
    same(view.read(spark), popular_stays(left, changed, grain))


def test_a_lost_refresh_is_made_up_for(spark, tmp_path, monkeypatch):
    view = PopularityView(str(tmp_path))
    weather = weather_of(spark, [(1, "2017-08-24", 5.0, "A"), (1, "2017-09-24", 5.0, "A"), (None, "2017-09-24", 5.0, "B")])
    some = bookings_of(spark, [(1, 1, "2017-08-24", "2017-08-25", 0), (2, 1, None, None, 0), (3, None, "2017-08-24", None, 0)])
    more = bookings_of(spark, [(4, 1, "2017-09-24", "2017-09-25", 0)])
    view.replace_bookings(some)
    assert view.refresh(spark) == {"2017-08"}  # no weather yet
    view.replace_weather(weather)
    view.refresh(spark)

    def lost(self, *args, **kwargs):
        raise RuntimeError("lost")

    view.replace_bookings(more)
    with monkeypatch.context() as patch, pytest.raises(RuntimeError, match="lost"):
        patch.setattr(AtomicTable, "replace", lost)
        view.refresh(spark)
    same(view.read(spark), popular_stays(some, weather))
    view.refresh(spark)
    same(view.read(spark), popular_stays(some.union(more), weather))
    view.replace_weather(weather_of(spark, [(1, "2017-08-24", -5.0, "A"), (1, "2017-09-24", None, "A")]))
    view.refresh(spark)
    assert view.read(spark).collect() == []


# --- windows ----------------------------------------------------------------------------


def seconds(spark, path, values):
    times = spark.createDataFrame([(v,) for v in values], "s bigint").select(F.timestamp_seconds("s").alias("ts"))
    times.coalesce(1).write.mode("append").parquet(path)


def test_late_events_amend_closed_windows(spark, tmp_path):
    windows = AmendedWindows(str(tmp_path / "out"), "ts")
    failed = []

    def run():
        def sink(batch, batch_id):
            windows(batch, batch_id)
            if batch_id == 2 and not failed:
                failed.append(True)
                raise RuntimeError("lost after the write")

        stream = read_table_stream(spark, f"{tmp_path}/in", "ts timestamp", files_per_trigger=1)
        run_out(run_stream(stream, sink, f"{tmp_path}/cp", trigger=AVAILABLE_NOW))

    def shown():
        unix = F.unix_timestamp("start").alias("start")
        return rows_of(windows.read(spark).select(unix, "count", "late", "closed"), ["start", "count", "late", "closed"])

    seconds(spark, f"{tmp_path}/in", [0, 1, 4, 5, 9])
    run()
    assert shown() == [(0, 3, 0, False), (5, 2, 0, False)]
    seconds(spark, f"{tmp_path}/in", [3, 12])
    run()
    assert shown() == [(0, 4, 0, True), (10, 1, 0, False), (5, 2, 0, False)]
    seconds(spark, f"{tmp_path}/in", [2, 6, 30, 1])
    with pytest.raises(Exception, match="FOREACH_BATCH"):
        run()
    run()  # the batch runs again and counts once
    assert shown() == [(0, 6, 2, True), (10, 1, 0, True), (30, 1, 0, False), (5, 3, 0, True)]
    unix = F.unix_timestamp("start").alias("start")
    assert rows_of(windows.changes(spark, 2).select(unix, "count", "late"), ["start", "count", "late"]) == [(0, 2, 2), (30, 1, 0), (5, 1, 0)]
    folders = json.loads(Path(windows.path, "current.json").read_text())
    assert list(folders) == ["0", "1", "2"]


def test_windows_of_nothing(spark, tmp_path):
    windows = AmendedWindows(str(tmp_path / "out"), "ts")
    windows(spark.createDataFrame([(None,)], "ts timestamp"), 0)
    assert windows.read(spark).collect() == []

from pathlib import Path

import pytest
from helpers import finish, rows_of, same
from pyspark.sql import functions as F

from stayscope.schemas import POPULAR_BY_HOTEL
from stayscope.sources.topics import decode_json, encode_json
from stayscope.streaming.runner import Target, run_stream
from stayscope.streaming.sinks import (
    ChangeTable,
    DocumentIndex,
    SnapshotTable,
    Versions,
    stamped,
    with_doc_id,
)

# Two rows of a result.
RESULT_ROWS = [
    ("Southside Motel", 68719476738, 0, 2, 0, 0, 0, "short_stay_cnt"),
    ("Royal Inn Motel", 42949672966, 0, 0, 3, 0, 0, "standart_stay_cnt"),
]


def test_batch_result_replaces_the_one_before(spark, tmp_path):
    path = str(tmp_path / "result")
    frame = spark.createDataFrame(RESULT_ROWS, POPULAR_BY_HOTEL)
    spark.range(10).write.mode("overwrite").parquet(path)
    frame.write.mode("overwrite").parquet(path)
    same(spark.read.parquet(path), frame)


def table(spark, rows):
    return spark.createDataFrame(rows, "name string, children int, n bigint, top string")


def test_change_table_keeps_the_latest_row_per_key(spark, tmp_path):
    changes = ChangeTable(str(tmp_path / "changes"), ["name", "children"])
    changes(table(spark, [("A", 0, 1, "x"), ("A", None, 5, "x"), (None, 0, 7, None)]), 0)
    changes(table(spark, [("A", 0, 2, "y"), ("B", 1, 1, "x")]), 1)
    changes(table(spark, [("A", 0, 2, "y"), ("B", 1, 1, "x")]), 1)
    for batch_id in range(2, 12):
        changes(table(spark, [("B", 1, batch_id, None)]), batch_id)
    assert rows_of(changes.read(spark), ["name", "children", "n", "top"]) == sorted(
        [("A", 0, 2, "y"), ("A", None, 5, "x"), ("B", 1, 11, None), (None, 0, 7, None)], key=repr
    )


def test_change_table_is_read_from_its_last_merge(spark, tmp_path):
    changes = ChangeTable(str(tmp_path / "changes"), ["name", "children"], merge_every=3)
    for batch_id in range(8):
        changes(table(spark, [(f"h{batch_id % 5}", batch_id % 5, batch_id, None)]), batch_id)
    for batch_id in (6, 7):
        changes(table(spark, [(f"h{batch_id % 5}", batch_id % 5, batch_id, None)]), batch_id)
    current = changes.read(spark)
    assert rows_of(current, ["name", "n"]) == [
        ("h0", 5), ("h1", 6), ("h2", 7), ("h3", 3), ("h4", 4)
    ]
    read = {file.rsplit("/", 2)[1] for file in current.inputFiles()}
    assert read == set(Versions(changes.path).current(spark).values())
    assert len(read) == 2
    # the merge before, which readers may still be at, and nothing older
    assert len(list((tmp_path / "changes" / "data").iterdir())) <= 5


def half_committed(spark, path, frame):
    """What a write leaves that is lost on its way."""
    frame.write.parquet(f"{path}/data/v-lost")
    next(Path(f"{path}/data/v-lost").glob("_SUCCESS")).unlink()


def test_a_batch_that_was_not_published_is_not_seen(spark, tmp_path):
    changes = ChangeTable(str(tmp_path / "changes"), ["name", "children"], merge_every=2)
    changes(table(spark, [("A", 0, 1, "x")]), 0)
    half_committed(spark, changes.path, table(spark, [("A", 0, 2, "x"), ("B", 0, 2, "x")]))
    assert rows_of(changes.read(spark), ["name", "n"]) == [("A", 1)]
    changes(table(spark, [("A", 0, 3, "x")]), 1)
    changes(table(spark, [("C", 0, 4, "x")]), 2)
    assert rows_of(changes.read(spark), ["name", "n"]) == [("A", 3), ("C", 4)]
    assert not (tmp_path / "changes" / "data" / "v-lost").exists()

    snapshot = SnapshotTable(str(tmp_path / "snapshot"))
    snapshot(spark.range(5), 0)
    half_committed(spark, snapshot.path, spark.range(2))
    assert snapshot.read(spark).count() == 5


def test_readers_finish_while_the_next_batch_is_published(spark, tmp_path):
    snapshot = SnapshotTable(str(tmp_path / "snapshot"))
    snapshot(spark.range(5), 0)
    before = snapshot.read(spark)
    snapshot(spark.range(7), 1)
    assert before.count() == 5
    assert snapshot.read(spark).count() == 7

    changes = ChangeTable(str(tmp_path / "changes"), ["name", "children"], merge_every=1)
    changes(table(spark, [("A", 0, 1, "x")]), 0)
    seen = changes.read(spark)
    changes(table(spark, [("A", 0, 2, "x")]), 1)
    assert rows_of(seen, ["n"]) == [(1,)]
    assert rows_of(changes.read(spark), ["n"]) == [(2,)]


def test_a_new_checkpoint_starts_the_result_anew(spark, tmp_path):
    changes = ChangeTable(str(tmp_path / "changes"), ["name", "children"])
    snapshot = SnapshotTable(str(tmp_path / "snapshot"))
    for batch_id in (0, 1, 2, 3, 4, 5, 0):
        changes(table(spark, [(f"h{batch_id}", 0, 7, "x")]), batch_id)
        snapshot(spark.range(batch_id, 7), batch_id)
    assert rows_of(changes.read(spark), ["name", "n"]) == [("h0", 7)]
    assert snapshot.read(spark).count() == 7


def test_a_result_is_not_read_before_it_is_there(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        SnapshotTable(str(tmp_path / "snapshot")).read(spark)


def test_change_table_without_rows(spark, tmp_path):
    changes = ChangeTable(str(tmp_path / "changes"), ["name", "children"])
    changes(table(spark, []), 0)
    assert changes.read(spark).count() == 0


def test_snapshot_table_shows_the_newest_snapshot_only(spark, tmp_path):
    snapshot = SnapshotTable(str(tmp_path / "snapshot"))
    for batch_id in range(4):
        snapshot(spark.range(batch_id, 5), batch_id)
    snapshot(spark.range(3, 5), 3)
    assert rows_of(snapshot.read(spark)) == [(3,), (4,)]


def test_document_ids_stand_for_their_keys(spark):
    keys = [("A", 0), ("A", 0), ("A", None), ("", 0), (None, 0)]
    rows = table(spark, [(*key, n, "x") for n, key in enumerate(keys)])
    ids = [r["doc_id"] for r in with_doc_id(rows, ["name", "children"]).orderBy("n").collect()]
    assert ids[0] == ids[1]
    assert len(set(ids)) == 4


def test_document_index_sends_rows_with_id_and_time(spark, tmp_path):
    path = str(tmp_path / "index")
    index = DocumentIndex(path, ["name", "children"], fmt="json", options={"compression": "gzip"})
    index(table(spark, [("A", 0, 1, "x")]), 0)
    index(table(spark, [("A", 0, 2, "x")]), 1)
    sent = spark.read.json(path)
    assert sent.count() == 2
    assert sent.select("doc_id").distinct().count() == 1
    assert sent.where(F.col("timestamp").isNull()).count() == 0


def test_one_time_per_batch(spark):
    times = stamped(spark.range(1000).repartition(4)).select("timestamp").distinct()
    assert times.count() == 1


def test_memory_table_and_handle(spark, tmp_path):
    source = str(tmp_path / "source")
    spark.range(3).write.parquet(source)
    stream = spark.readStream.schema("id bigint").parquet(source)
    query = run_stream(stream, Target("memory", name="kept_in_memory"), None)
    try:
        assert query.isActive
        query.processAllAvailable()
        assert spark.sql("SELECT * FROM kept_in_memory").count() == 3
    finally:
        query.stop()
    assert not query.isActive


def test_counts_as_messages_in_complete_mode(spark, tmp_path):
    source = str(tmp_path / "source")
    spark.createDataFrame([("a",), ("a",), ("b",)], "top string").write.parquet(source)
    stream = spark.readStream.schema("top string").parquet(source)
    encoded = encode_json(stream.groupBy("top").count())
    target = Target("memory", name="counts_as_messages")
    query = run_stream(encoded, target, None, "complete")
    try:
        query.processAllAvailable()
        received = decode_json(spark.table("counts_as_messages"), "top string, count bigint")
        assert rows_of(received, ["top", "count"]) == [("a", 2), ("b", 1)]
    finally:
        query.stop()


def test_complete_mode_counts(spark, tmp_path):
    source = str(tmp_path / "source")
    spark.range(10).repartition(5).write.parquet(source)
    stream = spark.readStream.schema("id bigint").option("maxFilesPerTrigger", 1).parquet(source)
    snapshot = SnapshotTable(str(tmp_path / "out"))
    counts = stream.groupBy((F.col("id") % 2).alias("odd")).count()
    finish(counts, snapshot, str(tmp_path / "cp"), "complete")
    assert rows_of(snapshot.read(spark), ["odd", "count"]) == [(0, 5), (1, 5)]

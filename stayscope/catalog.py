"""Every operator as a query over the test tables; ``equivalents`` has the SQL of each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from stayscope import fixtures
from stayscope.categories import STAY_CATEGORIES
from stayscope.operators.bookings import distinct_bookings, project_bookings, with_stay_days
from stayscope.operators.classify import classify
from stayscope.operators.counts import category_counts
from stayscope.operators.enrich import COPY_SALTS, enrich, enrich_with_days, finish_batch
from stayscope.operators.popular import GRAINS, popular
from stayscope.operators.weather import above_temperature, project_weather, weather_means
from stayscope.plans.adaptive import popular_stays_adaptive
from stayscope.plans.batch import popular_stays, popular_stays_counting_first
from stayscope.plans.exact import start_exact
from stayscope.plans.incremental import PopularityView
from stayscope.plans.live import counts_table, popular_so_far, start_live
from stayscope.plans.stream import (
    popular_stays_collapsed,
    popular_stays_stream,
    preferences_stream,
    start_collapsing,
    static_days,
)
from stayscope.schemas import ENRICHED, POPULAR_BY_HOTEL, PREFERENCES
from stayscope.session import settings, work_dir
from stayscope.sources.files import append_files, read_table, read_table_stream, write_table
from stayscope.sources.layout import bucketed_inputs, buckets_for, enrich_in_place, join_days_by_month, write_by_month
from stayscope.sources.tables import AtomicTable
from stayscope.sources.topics import (
    decode_json,
    decode_variants,
    encode_json,
    infer_json_schema,
    merged_schema,
    read_json_topic,
    read_topic_stream,
    schema_of_variants,
    stored_variants,
)
from stayscope.streaming.runner import AVAILABLE_NOW, Target, run_out, run_stream
from stayscope.streaming.sinks import ChangeTable, SnapshotTable, stamped
from stayscope.streaming.windows import AmendedWindows, windowed_count

Query = Callable[[SparkSession, str], DataFrame]

PARTITION_YEAR = 1996
WARM = 20
SLICES = 4
VERSIONS = 3
BUCKETS = 8


def _inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return fixtures.bookings(spark, sf_dir), fixtures.weather(spark, sf_dir)


def _merged_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Hotels that share seven names, and bookings whose children are partly unknown."""
    number = F.col("l_linenumber")
    children = F.when(number != 7, number % 4)
    name = F.concat(F.lit("Hotel "), (F.col("s_suppkey") % 7).cast("string"))
    lineitem = fixtures.table(spark, sf_dir, "lineitem")
    return fixtures.as_bookings(lineitem, children), fixtures.weather(spark, sf_dir, name)


def _preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(enrich(*_inputs(spark, sf_dir)))


# --- batch ----------------------------------------------------------------------------


def batch_popular_by_hotel(spark, sf_dir):
    return popular_stays(*_inputs(spark, sf_dir))


def batch_popular_by_hotel_counting_first(spark, sf_dir):
    return popular_stays_counting_first(*_inputs(spark, sf_dir))


def batch_popular_by_hotel_copies(spark, sf_dir):
    bookings, weather = _inputs(spark, sf_dir)
    return popular_stays(fixtures.sent_again(bookings), weather)


def batch_popular_by_hotel_adaptive(spark, sf_dir):
    return popular_stays_adaptive(*_inputs(spark, sf_dir))


def query_project_weather(spark, sf_dir):
    return project_weather(fixtures.weather(spark, sf_dir))


def filter_min_temperature(spark, sf_dir):
    readings = project_weather(fixtures.weather(spark, sf_dir))
    return above_temperature(readings, WARM)


def enrich_bookings(spark, sf_dir):
    return enrich(*_inputs(spark, sf_dir))


def query_distinct_bookings(spark, sf_dir):
    return distinct_bookings(fixtures.bookings(spark, sf_dir))


def stay_duration(spark, sf_dir):
    bookings = project_bookings(fixtures.bookings(spark, sf_dir))
    return with_stay_days(bookings).select("order_id", "duration_stay")


def classify_stay(spark, sf_dir):
    return _preferences(spark, sf_dir)


def _counts(preferences: DataFrame, grain: str) -> DataFrame:
    level = GRAINS[grain]
    return category_counts(preferences, level.keys, level.counters(STAY_CATEGORIES))


def stay_counts_by_hotel(spark, sf_dir):
    return _counts(_preferences(spark, sf_dir), "hotel")


def stay_counts_by_hotel_children(spark, sf_dir):
    return _counts(_preferences(spark, sf_dir), "hotel_children")


def most_popular(spark, sf_dir):
    result = popular(_preferences(spark, sf_dir))
    return result.select("hotel_id", "most_popular_stay_type")


def popular_by_children(spark, sf_dir):
    return popular_stays(*_inputs(spark, sf_dir), grain="hotel_children")


def popular_by_children_counting_first(spark, sf_dir):
    return popular_stays_counting_first(*_inputs(spark, sf_dir), grain="hotel_children")


def popular_merged_names(spark, sf_dir):
    return popular_stays(*_merged_inputs(spark, sf_dir))


def popular_by_children_merged_names(spark, sf_dir):
    return popular_stays(*_merged_inputs(spark, sf_dir), grain="hotel_children")


def count_by_type(spark, sf_dir):
    events = fixtures.table(spark, sf_dir, "events")
    return events.groupBy("event_type").agg(F.count("*").alias("n"))


# --- messages -------------------------------------------------------------------------


def _event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = fixtures.table(spark, sf_dir, "events")
    return events.select("event_id", F.col("props").alias("value"))


def json_encode(spark, sf_dir):
    events = fixtures.table(spark, sf_dir, "events").select("event_id", "event_type")
    return encode_json(events, keep=("event_id",))


def encode_preferences(spark, sf_dir):
    return encode_json(_preferences(spark, sf_dir))


def json_topic_parse(spark, sf_dir):
    return decode_json(_event_messages(spark, sf_dir), "k bigint", keep=("event_id",))


def json_topic_infer(spark, sf_dir):
    messages = _event_messages(spark, sf_dir)
    return decode_json(messages, infer_json_schema(messages), keep=("event_id",))


def json_topic_stored(spark, sf_dir):
    """A topic read in two runs, each parsed once; the second brings a field that the first did not have."""
    path = work_dir(spark, "json-topic")
    events = fixtures.table(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k").cast("bigint"))
    schema = StructType()
    for odd, fields in ((0, ["k"]), (1, ["k", "event_type"])):
        messages = events.where(F.col("event_id") % 2 == odd).select("event_id", F.to_json(F.struct(*fields)).alias("value"))
        stored = stored_variants(messages, path, keep=("event_id",))
        schema = merged_schema(schema, DataType.fromDDL(schema_of_variants(stored)))
    return decode_variants(spark.read.parquet(f"{path}/*"), schema, keep=("event_id",))


def popular_from_topic(spark, sf_dir):
    """The weather as JSON messages whose schema is inferred, ids as doubles."""
    bookings, weather = _inputs(spark, sf_dir)
    messages = encode_json(weather.withColumn("Id", F.col("Id").cast("double")))
    return popular_stays(bookings, read_json_topic(messages))


# --- files ----------------------------------------------------------------------------


def bookings_by_month(spark, sf_dir):
    """Enriched bookings from folders by month, of which only those with weather are read."""
    root = work_dir(spark, "by-month")
    bookings, weather = _inputs(spark, sf_dir)
    write_by_month(bookings, f"{root}/bookings")
    days = static_days(weather, f"{root}/days").frame
    return finish_batch(join_days_by_month(read_table(spark, f"{root}/bookings"), days))


def enrich_bucketed(spark, sf_dir):
    """Enriched bookings from tables in buckets, joined and made distinct where they lie."""
    root = work_dir(spark, "bucketed")
    bookings, weather = _inputs(spark, sf_dir)
    name = f"stays_{root.rsplit('-', 1)[1]}"
    bookings = fixtures.sent_again(bookings)
    buckets = buckets_for(bookings.count(), BUCKETS)
    tables = bucketed_inputs(spark, bookings, weather_means(weather), name, root, buckets)
    return enrich_in_place(*tables)


def scan_bookings(spark, sf_dir):
    return fixtures.as_bookings(read_table(spark, f"{sf_dir}/lineitem.parquet"))


def partition_scan(spark, sf_dir):
    root = work_dir(spark, "partition-scan")
    year = F.substring("srch_ci", 1, 4).cast("int")
    bookings = fixtures.bookings(spark, sf_dir).withColumn("year", year)
    write_table(bookings, root, partition_by=["year"])
    return read_table(spark, root).where(F.col("year") == PARTITION_YEAR).drop("year")


def parquet_roundtrip(spark, sf_dir):
    path = work_dir(spark, "parquet-roundtrip")
    write_table(fixtures.table(spark, sf_dir, "nation"), path)
    write_table(batch_popular_by_hotel(spark, sf_dir), path)
    return read_table(spark, path)


# --- streams --------------------------------------------------------------------------


def _run(frame: DataFrame, sink, root: str, mode: str) -> None:
    run_out(run_stream(frame, sink, f"{root}/checkpoint", mode, AVAILABLE_NOW))


def _days(spark: SparkSession, sf_dir: str, root: str):
    return static_days(fixtures.weather(spark, sf_dir), f"{root}/days")


def stream_scan_bookings(spark, sf_dir):
    root = work_dir(spark, "stream-scan")
    bookings = fixtures.booking_stream(spark, sf_dir)
    _run(bookings, Target("parquet", f"{root}/out"), root, "append")
    return read_table(spark, f"{root}/out")


def stream_enrich(spark, sf_dir):
    root = work_dir(spark, "stream-enrich")
    days = _days(spark, sf_dir, root)
    bookings = fixtures.booking_stream(spark, sf_dir)
    enriched = enrich_with_days(bookings, days.frame, days.join_salts)
    _run(enriched, Target("parquet", f"{root}/out"), root, "append")
    return read_table(spark, f"{root}/out")


def _popular_stream(spark: SparkSession, sf_dir: str, grain: str, again=False) -> DataFrame:
    root = work_dir(spark, f"stream-{grain}")
    days = _days(spark, sf_dir, root)
    table = ChangeTable(f"{root}/out", GRAINS[grain].keys)
    bookings = fixtures.booking_stream(spark, sf_dir)
    if again:
        bookings = fixtures.sent_again(bookings)
    # with many copies of a booking, they are split before they are removed
    result = popular_stays_stream(bookings, days, grain, copy_salts=COPY_SALTS if again else 0)
    _run(result, table, root, "update")
    return GRAINS[grain].visible(table.read(spark))


def stream_popular_by_children(spark, sf_dir):
    return _popular_stream(spark, sf_dir, "hotel_children")


def stream_popular_by_hotel(spark, sf_dir):
    return _popular_stream(spark, sf_dir, "hotel")


def stream_popular_by_children_copies(spark, sf_dir):
    return _popular_stream(spark, sf_dir, "hotel_children", again=True)


def stream_popular_collapsed(spark, sf_dir):
    """Two queries with files between them, for bookings with many copies."""
    root = work_dir(spark, "stream-collapsed")
    days = _days(spark, sf_dir, root)
    bookings = fixtures.sent_again(fixtures.booking_stream(spark, sf_dir))
    run_out(start_collapsing(bookings, days, f"{root}/stage", f"{root}/first", AVAILABLE_NOW))

    table = ChangeTable(f"{root}/out", GRAINS["hotel"].keys)
    enriched = read_table_stream(spark, f"{root}/stage", ENRICHED)
    _run(popular_stays_collapsed(enriched, "hotel"), table, f"{root}/second", "update")
    return table.read(spark)


def _arriving(bookings: DataFrame, path: str) -> DataFrame:
    """More bookings in the files at ``path``, as a stream that takes them in two micro-batches."""
    files = append_files(bookings, path, 2, "hotel_id")
    return read_table_stream(bookings.sparkSession, path, bookings.schema, files_per_trigger=max(1, -(-files // 2)))


def _popular_resumed(spark: SparkSession, sf_dir: str, label: str, **dedup) -> DataFrame:
    """A stream that is stopped after the newer half of the check-in days has arrived.

    The older half comes after it, each in several micro-batches, with copies everywhere.
    """
    root = work_dir(spark, label)
    days = _days(spark, sf_dir, root)
    table = ChangeTable(f"{root}/out", GRAINS["hotel"].keys)
    bookings = fixtures.sent_again(fixtures.bookings(spark, sf_dir))
    newer = F.col("srch_ci") >= str(PARTITION_YEAR)
    for half in (newer, ~newer):
        stream = _arriving(bookings.where(half), f"{root}/in")
        _run(popular_stays_stream(stream, days, "hotel", **dedup), table, root, "update")
    return table.read(spark)


def stream_restart(spark, sf_dir):
    return _popular_resumed(spark, sf_dir, "stream-restart")


def stream_late_bookings(spark, sf_dir):
    """With a bound on the memory of copies, no booking is too old to be counted."""
    return _popular_resumed(spark, sf_dir, "stream-late", copies_within="1 day")


def _slice(count: int, *columns: str) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(count))


def stream_weather_later(spark, sf_dir):
    """Weather that arrives in three versions, each after bookings that need it, with copies everywhere."""
    root = work_dir(spark, "stream-weather-later")
    bookings, weather = fixtures.sent_again(fixtures.bookings(spark, sf_dir)), fixtures.weather(spark, sf_dir)
    parts = {
        "bookings": (bookings, _slice(VERSIONS, "id", "hotel_id")),
        "weather": (weather, _slice(VERSIONS, "Id", "wthrDate", "avgTmprC")),
    }
    for name, (frame, _) in parts.items():
        frame.limit(0).write.parquet(f"{root}/{name}")
    for step in range(VERSIONS + 1):
        for name, number in (("bookings", step), ("weather", step - 1)):
            frame, part = parts[name]
            frame.where(part == number).write.mode("append").parquet(f"{root}/{name}")
        streams = [read_table_stream(spark, f"{root}/{name}", frame.schema) for name, (frame, _) in parts.items()]
        run_out(start_live(*streams, f"{root}/out", f"{root}/checkpoint", "hotel", AVAILABLE_NOW))
    return popular_so_far(spark, counts_table(f"{root}/out", "hotel"), "hotel")


def stream_copies_after_bound(spark, sf_dir):
    """Bookings that are sent again after the state has forgotten them, by a query that is started again."""
    root = work_dir(spark, "stream-copies-after-bound")
    days = _days(spark, sf_dir, root)
    bookings = fixtures.sent_again(fixtures.bookings(spark, sf_dir))
    half = _slice(2, "id", "hotel_id")
    for arrived in (bookings.where(half == 0), bookings, bookings.where(half == 1)):
        stream = _arriving(arrived, f"{root}/in")
        run_out(
            start_exact(
                stream,
                days,
                f"{root}/out",
                f"{root}/checkpoint",
                "hotel",
                "0 seconds",
                buckets=BUCKETS,
                trigger=AVAILABLE_NOW,
            )
        )
    return popular_so_far(spark, counts_table(f"{root}/out/counts", "hotel"), "hotel")


def topic_complete(spark, sf_dir):
    """The whole result as messages, sent anew by every micro-batch."""
    root = work_dir(spark, "topic-complete")
    days = _days(spark, sf_dir, root)
    topic = SnapshotTable(f"{root}/out")
    result = popular_stays_stream(fixtures.booking_stream(spark, sf_dir), days, "hotel")
    _run(encode_json(result), topic, root, "complete")
    return decode_json(topic.read(spark), POPULAR_BY_HOTEL)


def stamped_snapshot(spark, sf_dir):
    root = work_dir(spark, "stamped-snapshot")
    days = _days(spark, sf_dir, root)
    table = SnapshotTable(f"{root}/out")
    result = popular_stays_stream(fixtures.booking_stream(spark, sf_dir), days, "hotel")
    _run(stamped(result), table, root, "complete")
    return table.read(spark).drop("timestamp")


def stream_via_topic(spark, sf_dir):
    """Two queries with a topic between them: preferences as messages, then counts."""
    root = work_dir(spark, "stream-via-topic")
    topic = f"{root}/topic"
    days = _days(spark, sf_dir, root)
    preferences = preferences_stream(fixtures.booking_stream(spark, sf_dir), days)
    _run(encode_json(preferences), Target("text", topic), f"{root}/first", "append")

    grain = "hotel_children"
    table = ChangeTable(f"{root}/out", GRAINS[grain].keys)
    messages = read_topic_stream(spark, {}, "text", topic)
    received = decode_json(messages, PREFERENCES)
    _run(popular(received, grain, keep_keys=True), table, f"{root}/second", "update")
    return GRAINS[grain].visible(table.read(spark))


def _windows(events: DataFrame, root: str) -> None:
    """Count events by the hour, as far as the windows are closed."""
    timed = events.select(F.col("ts").cast("timestamp").alias("ts"))
    counted = windowed_count(timed, "ts", "1 hour", "5 seconds")
    out = counted.select(F.col("window.start").alias("start"), F.col("count").alias("n"))
    _run(out, Target("parquet", f"{root}/out"), root, "append")


def _closed_windows(spark: SparkSession, root: str) -> DataFrame:
    written = read_table(spark, f"{root}/out")
    return written.withColumn("start", F.col("start").cast("timestamp_ntz"))


def query_windowed_count(spark, sf_dir):
    """The events carry wall-clock times, which are read as UTC in any session."""
    root = work_dir(spark, "windowed-count")
    with settings(spark, {"spark.sql.session.timeZone": "UTC"}):
        _windows(fixtures.table_stream(spark, sf_dir, "events"), root)
        return _closed_windows(spark, root)


def windowed_count_resumed(spark, sf_dir):
    """The same over events that arrive in slices of time, each a micro-batch of its own.

    Slices are not in order within, but no event is older than the slice before it.
    """
    root = work_dir(spark, "windowed-count-resumed")
    with settings(spark, {"spark.sql.session.timeZone": "UTC"}):
        events = fixtures.table(spark, sf_dir, "events").select("ts")
        second = F.unix_timestamp(F.col("ts").cast("timestamp"))
        first, last = events.agg(F.min(second), F.max(second)).first()
        slice_of = F.floor((second - F.lit(first)) * SLICES / F.lit((last or 0) - (first or 0) + 1))
        for n in range(SLICES):
            events.where(slice_of == n).write.mode("append").parquet(f"{root}/in")
            _windows(read_table_stream(spark, f"{root}/in", events.schema), root)
        return _closed_windows(spark, root)


def windowed_count_amended(spark, sf_dir):
    """The same windows over slices of time that arrive newest first, so that most events are late."""
    root = work_dir(spark, "windowed-count-amended")
    with settings(spark, {"spark.sql.session.timeZone": "UTC"}):
        events = fixtures.table(spark, sf_dir, "events").select(F.col("ts").cast("timestamp").alias("ts"))
        slice_of = F.pmod(F.floor(F.unix_timestamp("ts") / 1000), F.lit(SLICES))
        windows = AmendedWindows(f"{root}/out", "ts", "1 hour", "5 seconds")
        for n in reversed(range(SLICES)):
            events.where(slice_of == n).write.mode("append").parquet(f"{root}/in")
            stream = read_table_stream(spark, f"{root}/in", events.schema)
            run_out(run_stream(stream, windows, f"{root}/checkpoint", trigger=AVAILABLE_NOW))
        closed = windows.read(spark).where("closed")
        return closed.select(F.col("start").cast("timestamp_ntz").alias("start"), F.col("count").alias("n"))


def atomic_replace(spark, sf_dir):
    """A table by year that is first published wrong, then corrected year by year."""
    table = AtomicTable(work_dir(spark, "atomic-replace"), ["year"])
    bookings = fixtures.bookings(spark, sf_dir).withColumn("year", F.substring("srch_ci", 1, 4).cast("int"))
    table.replace(bookings.withColumn("srch_children_cnt", F.lit(9)))
    for odd in (0, 1):
        table.replace_partitions(bookings.where(F.col("year") % 2 == odd))
    return table.read(spark).drop("year")


def batch_popular_incremental(spark, sf_dir):
    """A result that follows a year of bookings that comes later, and corrected weather, by months."""
    view = PopularityView(work_dir(spark, "incremental"))
    bookings, weather = _inputs(spark, sf_dir)
    later = F.col("srch_ci").startswith(str(PARTITION_YEAR))
    summer = F.substring("wthrDate", 6, 2).isin("06", "07", "08")
    view.replace_bookings(fixtures.sent_again(bookings.where(~later)))
    view.replace_weather(weather.withColumn("avgTmprC", F.when(summer, -F.col("avgTmprC")).otherwise(F.col("avgTmprC"))))
    view.refresh(spark)
    view.replace_bookings(bookings.where(later))
    view.refresh(spark)
    view.replace_weather(weather.where(summer))
    view.refresh(spark)
    return view.read(spark)


QUERIES: dict[str, Query] = {
    "batch_popular_by_hotel": batch_popular_by_hotel,
    "batch_popular_by_hotel_counting_first": batch_popular_by_hotel_counting_first,
    "batch_popular_by_hotel_copies": batch_popular_by_hotel_copies,
    "batch_popular_by_hotel_adaptive": batch_popular_by_hotel_adaptive,
    "project_weather": query_project_weather,
    "filter_min_temperature": filter_min_temperature,
    "enrich_bookings": enrich_bookings,
    "distinct_bookings": query_distinct_bookings,
    "stay_duration": stay_duration,
    "classify_stay": classify_stay,
    "stay_counts_by_hotel": stay_counts_by_hotel,
    "stay_counts_by_hotel_children": stay_counts_by_hotel_children,
    "most_popular": most_popular,
    "popular_by_children": popular_by_children,
    "popular_by_children_counting_first": popular_by_children_counting_first,
    "popular_merged_names": popular_merged_names,
    "popular_by_children_merged_names": popular_by_children_merged_names,
    "count_by_type": count_by_type,
    "json_encode": json_encode,
    "encode_preferences": encode_preferences,
    "json_topic_parse": json_topic_parse,
    "json_topic_infer": json_topic_infer,
    "json_topic_stored": json_topic_stored,
    "popular_from_topic": popular_from_topic,
    "scan_bookings": scan_bookings,
    "partition_scan": partition_scan,
    "bookings_by_month": bookings_by_month,
    "enrich_bucketed": enrich_bucketed,
    "parquet_roundtrip": parquet_roundtrip,
    "stream_scan_bookings": stream_scan_bookings,
    "stream_enrich": stream_enrich,
    "stream_popular_by_children": stream_popular_by_children,
    "stream_popular_by_children_copies": stream_popular_by_children_copies,
    "stream_popular_by_hotel": stream_popular_by_hotel,
    "stream_popular_collapsed": stream_popular_collapsed,
    "stream_restart": stream_restart,
    "stream_late_bookings": stream_late_bookings,
    "stream_copies_after_bound": stream_copies_after_bound,
    "stream_weather_later": stream_weather_later,
    "stream_via_topic": stream_via_topic,
    "topic_complete": topic_complete,
    "stamped_snapshot": stamped_snapshot,
    "windowed_count": query_windowed_count,
    "windowed_count_resumed": windowed_count_resumed,
    "windowed_count_amended": windowed_count_amended,
    "atomic_replace": atomic_replace,
    "batch_popular_incremental": batch_popular_incremental,
}

"""The two jobs end to end, from a configuration: files and a topic in, results out."""

from __future__ import annotations

import argparse
import json
import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql.streaming import StreamingQuery

from stayscope.operators.enrich import COPY_SALTS
from stayscope.operators.popular import GRAINS
from stayscope.operators.weather import MIN_TMPR
from stayscope.plans.adaptive import in_best_order
from stayscope.plans.batch import count_first, join_first
from stayscope.plans.exact import start_exact
from stayscope.plans.live import counts_table, popular_so_far, start_live
from stayscope.plans.stream import (
    StaticDays,
    popular_stays_collapsed,
    popular_stays_stream,
    preferences_stream,
    start_collapsing,
    static_days,
)
from stayscope.schemas import BOOKINGS, ENRICHED, WEATHER_MESSAGES
from stayscope.session import settings, settings_for, stored_bytes, work_dir
from stayscope.sources.files import archived, read_table, read_table_stream, write_table
from stayscope.sources.tables import AtomicTable
from stayscope.sources.topics import (
    decode_variants,
    encode_json,
    read_json_topic,
    read_topic,
    read_topic_stream,
    schema_of_variants,
    stored_variants,
)
from stayscope.streaming.accounts import Accounts, observed_bookings, observed_messages
from stayscope.streaming.runner import BatchWriter, Target, run_stream
from stayscope.streaming.sinks import ChangeTable, DocumentIndex


ORDERS = {"join_first": join_first, "count_first": count_first, "measured": in_best_order}
MEMORIES = ("state", "files")


@dataclass(frozen=True)
class TopicConfig:
    """A topic of JSON messages.

    Weather has the fields of ``WEATHER_MESSAGES`` unless ``schema`` says otherwise; with
    "infer" it is inferred from all messages, which are parsed once and kept for that while the job runs.
    """

    fmt: str = "kafka"
    path: str | None = None
    options: Mapping[str, str] = field(default_factory=dict)
    schema: str | None = None


@dataclass(frozen=True)
class JobConfig:
    """Where the jobs read and write.

    ``order`` is that of the batch, "join_first", "count_first" or "measured", which sketches the
    inputs first and also splits heavy hotel-days. ``input_bytes`` sizes the
    session's shuffles; left out, it is the size of the files of the bookings.

    With ``atomic_output`` the batch publishes its result as a version of an ``AtomicTable``, so that a run that fails leaves
    the result before; readers go through that table.

    The stream writes a change table at ``stream_output``, or, if ``index_format`` names
    a deployed connector, documents to that index. With ``stage``, a folder, it runs as
    two queries, the first of which collapses copies into that folder; ``stage_archive`` is where the second moves
    what it has counted, or the folder and its listing grow for ever. ``preferences`` is a
    topic that gets every classified booking as a message, from a query of its own.

    With ``live`` the stream follows the weather topic too: bookings wait for their weather,
    for ``patience`` if it is given (``plans.live``). With ``memory`` "files" it counts a booking once however late
    its copies come, with bounded state (``plans.exact``). Both add counts up at ``stream_output``; ``stream_result`` reads them.

    With ``accounts`` the job counts what it leaves out (``streaming.accounts``): stray messages, null keys,
    bookings without weather, late rows, expired messages. ``main`` returns the counts and prints those of the batch.

    ``days_path`` keeps the weather that a stream reads again at every trigger, so it must
    last; each start adds a version. ``state_partitions`` stay as they are for as long as a
    checkpoint does. ``copies_within``, ``copy_salts`` and ``join_salts`` are explained at
    ``enrich_with_days``, ``trigger`` is the time between micro-batches. Passwords and the
    like belong into the options that the caller adds, not into code.
    """

    weather: TopicConfig
    batch_bookings: str
    batch_output: str
    stream_bookings: str
    stream_output: str
    stream_checkpoint: str
    bookings_format: str = "avro"
    grain: str = "hotel_children"
    min_tmpr: float = MIN_TMPR
    files_per_trigger: int | None = None
    bytes_per_trigger: int | None = None
    bookings_options: Mapping[str, str] = field(default_factory=dict)
    trigger: str | None = None
    state_partitions: int | None = None
    copies_within: str | None = None
    copy_salts: int = 0
    join_salts: int = COPY_SALTS
    order: str = "join_first"
    input_bytes: int | None = None
    days_path: str | None = None
    preferences: TopicConfig | None = None
    preferences_checkpoint: str | None = None
    accounts: bool = False
    atomic_output: bool = False
    live: bool = False
    patience: str | None = None
    memory: str = "state"
    stage: str | None = None
    stage_checkpoint: str | None = None
    stage_archive: str | None = None
    index_format: str | None = None
    index_options: Mapping[str, str] = field(default_factory=dict)

    @classmethod
    def load(cls, path: str) -> JobConfig:
        with open(path, encoding="utf-8") as file:
            values = json.load(file)
        topics = {
            name: TopicConfig(**values[name]) for name in ("weather", "preferences") if name in values
        }
        return cls(**{**values, **topics})


def job_settings(spark: SparkSession, config: JobConfig) -> dict[str, str]:
    """``settings_for`` the bookings of the batch."""
    size = config.input_bytes or stored_bytes(spark, config.batch_bookings)
    return settings_for(size, spark.sparkContext.defaultParallelism)


def hotel_days(
    spark: SparkSession, config: JobConfig, accounts: Accounts | None = None
) -> StaticDays:
    """The weather topic, read once for both jobs."""
    topic = config.weather
    messages = read_topic(spark, topic.options, topic.fmt, topic.path)
    seen = Observation("weather")
    if accounts is not None:
        messages = observed_messages(messages, seen)
    if topic.schema == "infer":
        # parsed once, so that the messages that are decoded are those that the schema is of
        stored = stored_variants(messages, work_dir(spark, "weather-topic"))
        weather = decode_variants(stored, schema_of_variants(stored))
    else:
        weather = read_json_topic(messages, topic.schema or WEATHER_MESSAGES)
    path = f"{config.days_path}/version-{uuid.uuid4().hex}" if config.days_path else None
    path = path or work_dir(spark, "days")
    days = static_days(weather, path, config.min_tmpr, salts=config.join_salts)
    if accounts is not None:
        accounts.add("weather", seen.get)
    return days


def batch_result(
    spark: SparkSession, config: JobConfig, days: StaticDays, seen: Observation | None = None
) -> DataFrame:
    """The result per hotel, in the configured order of work."""
    bookings = read_table(
        spark, config.batch_bookings, config.bookings_format, options=config.bookings_options
    )
    if seen is not None:
        bookings = observed_bookings(bookings, seen)
    return ORDERS[config.order](bookings, days.frame)


def run_batch(
    spark: SparkSession, config: JobConfig, days: StaticDays, accounts: Accounts | None = None
) -> None:
    """Replace the result per hotel at ``batch_output``, in one step if ``atomic_output`` says so."""
    seen = Observation("batch_bookings") if accounts is not None else None
    result = batch_result(spark, config, days, seen)
    if config.atomic_output:
        AtomicTable(config.batch_output).replace(result)
    else:
        write_table(result, config.batch_output)
    if accounts is not None:
        accounts.add("batch_bookings", seen.get)


def stream_sink(config: JobConfig) -> BatchWriter:
    keys = GRAINS[config.grain].keys
    if config.index_format is None:
        return ChangeTable(config.stream_output, keys)
    return DocumentIndex(
        config.stream_output, keys, config.index_format, options=config.index_options
    )


def trigger_options(config: JobConfig) -> dict[str, str]:
    """What bounds a micro-batch in bytes."""
    return {"maxBytesPerTrigger": str(config.bytes_per_trigger)} if config.bytes_per_trigger else {}


def trigger_of(config: JobConfig) -> dict[str, object] | None:
    return {"processingTime": config.trigger} if config.trigger else None


def bookings_stream(spark: SparkSession, config: JobConfig) -> DataFrame:
    options = {**trigger_options(config), **config.bookings_options}
    bookings = read_table_stream(
        spark,
        config.stream_bookings,
        BOOKINGS,
        config.bookings_format,
        config.files_per_trigger,
        options,
    )
    return observed_bookings(bookings) if config.accounts else bookings


def removal_of_copies(config: JobConfig) -> dict[str, object]:
    return {"copy_salts": config.copy_salts, "copies_within": config.copies_within}


def start_stage(
    spark: SparkSession,
    config: JobConfig,
    days: StaticDays,
    trigger: Mapping[str, object] | None = None,
) -> StreamingQuery:
    """The first of two queries, for a configuration with a ``stage``."""
    bookings = bookings_stream(spark, config)
    trigger = trigger or trigger_of(config)
    return start_collapsing(bookings, days, config.stage, config.stage_checkpoint, trigger)


def start_preferences(
    spark: SparkSession,
    config: JobConfig,
    days: StaticDays,
    trigger: Mapping[str, object] | None = None,
) -> StreamingQuery:
    """Every classified booking as a message of the topic ``preferences``."""
    topic = config.preferences
    found = preferences_stream(bookings_stream(spark, config), days, **removal_of_copies(config))
    return run_stream(
        encode_json(found),
        Target(topic.fmt, topic.path, topic.options),
        config.preferences_checkpoint,
        trigger=trigger or trigger_of(config),
        partitions=config.state_partitions,
    )


def start_stream(
    spark: SparkSession,
    config: JobConfig,
    days: StaticDays,
    trigger: Mapping[str, object] | None = None,
) -> StreamingQuery:
    """Keep the result per group at ``stream_output`` up to date; returns the query.

    With a ``stage`` this is the second query, which follows what the first puts there.
    """
    if config.stage is None:
        bookings = bookings_stream(spark, config)
        join = {"unmatched": "join"} if config.accounts else {}
        result = popular_stays_stream(bookings, days, config.grain, **removal_of_copies(config), **join)
    else:
        enriched = read_table_stream(
            spark,
            config.stage,
            ENRICHED,
            files_per_trigger=config.files_per_trigger,
            options={**trigger_options(config), **(archived(config.stage_archive) if config.stage_archive else {})},
        )
        result = popular_stays_collapsed(enriched, config.grain)
    return run_stream(
        result,
        stream_sink(config),
        config.stream_checkpoint,
        "update",
        trigger or trigger_of(config),
        partitions=config.state_partitions,
    )


def weather_stream(spark: SparkSession, config: JobConfig) -> DataFrame:
    """Readings as the weather topic brings them, with a schema that is known beforehand."""
    topic = config.weather
    if topic.schema == "infer":
        raise ValueError("a stream of weather needs a schema")
    messages = read_topic_stream(spark, topic.options, topic.fmt, topic.path)
    if config.accounts:
        messages = observed_messages(messages, "weather")
    return read_json_topic(messages, topic.schema or WEATHER_MESSAGES)


def start_adding(
    spark: SparkSession,
    config: JobConfig,
    days: StaticDays | None = None,
    trigger: Mapping[str, object] | None = None,
) -> StreamingQuery:
    """The stream of a configuration that is ``live`` or has its ``memory`` in files."""
    bookings = bookings_stream(spark, config)
    place = (config.stream_output, config.stream_checkpoint, config.grain)
    shared = {
        "copy_salts": config.copy_salts,
        "trigger": trigger or trigger_of(config),
        "partitions": config.state_partitions,
    }
    if config.live:
        return start_live(
            bookings,
            weather_stream(spark, config),
            *place,
            min_tmpr=config.min_tmpr,
            patience=config.patience,
            copies_within=config.copies_within,
            join_salts=config.join_salts,
            **shared,
        )
    return start_exact(bookings, days, *place, copies_within=config.copies_within or "1 hour", **shared)


def stream_result(spark: SparkSession, config: JobConfig) -> DataFrame:
    """The result that the stream has published so far."""
    if config.live or config.memory == "files":
        counts = config.stream_output if config.live else f"{config.stream_output}/counts"
        return popular_so_far(spark, counts_table(counts, config.grain), config.grain)
    return GRAINS[config.grain].visible(ChangeTable(config.stream_output, GRAINS[config.grain].keys).read(spark))


def main(arguments: list[str] | None = None) -> dict[str, dict[str, int]]:
    parser = argparse.ArgumentParser(description="Most popular stays per hotel")
    parser.add_argument("config", help="JSON file with the fields of JobConfig")
    parser.add_argument("--mode", choices=["batch", "stream", "both"], default="both")
    parsed = parser.parse_args(arguments)

    config = JobConfig.load(parsed.config)
    if config.memory not in MEMORIES or (config.live and config.memory != "state"):
        raise ValueError("memory is state or files, and a live stream has its own")
    if parsed.mode != "batch" and not config.days_path and not config.live:
        raise ValueError("a stream needs days_path, a folder that lasts as long as it runs")
    spark = SparkSession.builder.appName("stayscope").getOrCreate()
    accounts = Accounts().listen(spark) if config.accounts else None
    with settings(spark, job_settings(spark, config)):
        # a live stream reads the weather itself
        days = None if config.live and parsed.mode == "stream" else hotel_days(spark, config, accounts)
        if parsed.mode != "stream":
            if accounts is None:
                run_batch(spark, config, days)
            else:
                run_batch(spark, config, days, accounts)
                print(json.dumps(accounts.totals))
        if parsed.mode != "batch":
            if config.stage is not None:
                start_stage(spark, config, days)
            if config.preferences is not None:
                start_preferences(spark, config, days)
            adds = config.live or config.memory == "files"
            (start_adding if adds else start_stream)(spark, config, days)
            spark.streams.awaitAnyTermination()
    return accounts.totals if accounts is not None else {}


if __name__ == "__main__":
    main()

import pytest
from helpers import finish, plan_of, rows_of, same
from pyspark.sql import functions as F

from stayscope import fixtures, project_weather
from stayscope.schemas import BOOKINGS, PREFERENCES, WEATHER_MESSAGES
from stayscope.session import materialize, settings, settings_for, work_dir
from stayscope.sources.files import read_table, read_table_stream, write_table
from stayscope.sources.topics import (
    CORRUPT,
    decode_json,
    encode_json,
    infer_json_schema,
    kafka_options,
    kafka_sink_options,
    read_json_topic,
    read_topic,
    read_topic_stream,
)
from stayscope.streaming.runner import Target

# Two weather messages as they are sent.
WEATHER_TEXTS = [
    '{"wthrDate":"2017-08-24","avgTmprF":null,"avgTmprC":null,"Id":9.70663E11,'
    '"Name":"Villa Carlotta","Country":"US","City":"Medina","Address":"Via Pirandello 81",'
    '"Latitude":37.850643,"Longitude":15.293988,"Geohash":"sqdz"}',
    '{"wthrDate":"2016-10-31","avgTmprF":24.1,"avgTmprC":75.45,"Id":9.10533E11,'
    '"Name":"Cliffs 7305 By Redawning","Country":"US","City":"Princeville",'
    '"Address":"3811 Edward Rd","Latitude":22.226328,"Longitude":-159.481416,'
    '"Geohash":"87yw"}',
]


def messages_of(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_inferred_weather_has_the_pinned_types(spark):
    messages = messages_of(spark, WEATHER_TEXTS)
    inferred = read_json_topic(messages)
    pinned = read_json_topic(messages, WEATHER_MESSAGES)
    assert inferred.count() == 2
    assert dict(inferred.dtypes) == dict(pinned.dtypes)
    same(inferred, pinned)
    assert rows_of(project_weather(inferred), ["Id", "avgTmprC"]) == [
        (910533000000, 75.45),
        (970663000000, None),
    ]


def test_inference_sees_every_message(spark):
    texts = ['{"a":1}'] * 500 + ['{"a":2.5,"late":true}']
    schema = infer_json_schema(messages_of(spark, texts).repartition(4))
    decoded = decode_json(messages_of(spark, texts), schema)
    assert dict(decoded.dtypes) == {"a": "double", "late": "boolean"}


def test_inference_of_nulls_conflicts_nesting_and_odd_names(spark):
    texts = [
        '{"n":null,"mixed":1,"deep":{"list":[1,2.5]},"OBJECT< VOID":1,"DECIMAL(1,1)":"x",'
        '"AVOID":1.5,"VOID":[null],"OBJECT":[[{"VARIANT":{}}]]}',
        '{"n":null,"mixed":"s","deep":{"list":[]}}',
    ]
    messages = messages_of(spark, texts)
    decoded = decode_json(messages, infer_json_schema(messages))
    assert dict(decoded.dtypes) == {
        "n": "string",
        "mixed": "string",
        "deep": "struct<list:array<double>>",
        "OBJECT< VOID": "bigint",
        "DECIMAL(1,1)": "string",
        "AVOID": "double",
        "VOID": "array<string>",
        "OBJECT": "array<array<struct<VARIANT:struct<>>>>",
    }
    assert sorted(r["mixed"] for r in decoded.collect()) == ["1", "s"]


def test_malformed_messages_are_kept_apart(spark):
    messages = messages_of(spark, ['{"a":1}', "{broken", None])
    decoded = read_json_topic(messages)
    assert rows_of(decoded, ["a", CORRUPT]) == [
        (1, None),
        (None, "{broken"),
        (None, None),
    ]
    assert rows_of(decode_json(messages, "a int"), ["a"]) == [(1,), (None,), (None,)]


def test_no_messages_no_schema(spark):
    with pytest.raises(ValueError):
        infer_json_schema(messages_of(spark, []))
    assert read_json_topic(messages_of(spark, []), WEATHER_MESSAGES).columns == (
        WEATHER_MESSAGES.names
    )


def test_encoding_leaves_nulls_out_and_decodes_to_the_same(spark):
    rows = [("A", 1, 2, None, 0, "Erroneous data", "x"), ("B", 1, 2, 3, None, "s", 'a "b"\n')]
    frame = spark.createDataFrame(rows, PREFERENCES)
    encoded = encode_json(frame)
    assert "duration_stay" not in encoded.where("value like '%\"A\"%'").first()["value"]
    same(decode_json(encoded, PREFERENCES), frame)


def test_kafka_options_read_from_the_start_and_survive_expiry():
    options = kafka_options("broker:9092", "weather", maxOffsetsPerTrigger="10")
    assert options["subscribe"] == "weather"
    assert options["startingOffsets"] == "earliest"
    assert options["failOnDataLoss"] == "false"
    assert options["maxOffsetsPerTrigger"] == "10"


def test_kafka_sink_options():
    assert kafka_sink_options("broker:9092", "counts", **{"kafka.acks": "all"}) == {
        "kafka.bootstrap.servers": "broker:9092",
        "topic": "counts",
        "kafka.acks": "all",
    }


def test_topic_in_files_as_batch_and_as_stream(spark, tmp_path):
    topic = str(tmp_path / "topic")
    messages_of(spark, WEATHER_TEXTS).write.text(topic)
    assert read_topic(spark, {}, "text", topic).count() == 2
    stream = read_topic_stream(spark, {}, "text", topic)
    assert stream.isStreaming
    decoded = decode_json(stream, WEATHER_MESSAGES)
    finish(decoded, Target("parquet", str(tmp_path / "out")), str(tmp_path / "cp"), "append")
    same(
        spark.read.parquet(str(tmp_path / "out")),
        read_json_topic(messages_of(spark, WEATHER_TEXTS)),
    )


def test_binary_values_are_read_as_text(spark, tmp_path):
    topic = str(tmp_path / "topic")
    binary = F.encode("value", "UTF-8").alias("value")
    messages_of(spark, WEATHER_TEXTS).select(binary).write.parquet(topic)
    assert read_json_topic(read_topic(spark, {}, "parquet", topic)).count() == 2


@pytest.mark.parametrize("fmt", ["parquet", "json", "orc"])
def test_tables_in_files(spark, tmp_path, fmt):
    path = str(tmp_path / "table")
    row = {f.name: None for f in BOOKINGS} | {"id": 1, "hotel_id": 2, "srch_ci": "2016-01-01"}
    frame = spark.createDataFrame([tuple(row[n] for n in BOOKINGS.names)], BOOKINGS)
    frame.write.format(fmt).save(path)
    schema = BOOKINGS if fmt == "json" else None
    same(read_table(spark, path, fmt, schema), frame)

    stream = read_table_stream(spark, path, BOOKINGS, fmt, files_per_trigger=1)
    assert stream.isStreaming
    assert stream.schema == BOOKINGS
    finish(stream, Target("parquet", str(tmp_path / "out")), str(tmp_path / "cp"), "append")
    same(spark.read.parquet(str(tmp_path / "out")), frame)


def test_only_the_asked_for_partition_is_read(spark, sf_dir, tmp_path):
    path = str(tmp_path / "by_year")
    bookings = fixtures.bookings(spark, sf_dir)
    year = F.substring("srch_ci", 1, 4).cast("int")
    bookings.withColumn("year", year).write.partitionBy("year").parquet(path)

    from_root = read_table(spark, path).where("year = 1996")
    assert "PartitionFilters: [isnotnull(year" in plan_of(from_root)
    leaf = read_table(spark, f"{path}/year=1996")
    assert "year" not in leaf.columns
    same(from_root.drop("year"), leaf)
    assert {f.split("year=")[1][:4] for f in from_root.inputFiles()} >= {"1996"}


def test_partitioned_tables_have_few_files(spark, sf_dir, tmp_path):
    path = tmp_path / "by_year"
    year = F.substring("srch_ci", 1, 4).cast("int")
    bookings = fixtures.bookings(spark, sf_dir).withColumn("year", year).repartition(20)
    write_table(spark.range(3).withColumn("year", F.lit(1)), str(path), partition_by=["year"])
    write_table(bookings, str(path), partition_by=["year"])
    years = sorted(p.name for p in path.glob("year=*"))
    assert years[0] == "year=1995"
    assert len(list(path.rglob("*.parquet"))) == len(years)
    same(read_table(spark, str(path)), bookings)


def test_a_large_partition_is_spread_over_files(spark, tmp_path):
    path = tmp_path / "skewed"
    rows = spark.range(200_000, numPartitions=8)
    skewed = rows.select("id", F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 5).alias("k"))
    with settings(spark, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k"}):
        write_table(skewed, str(path), partition_by=["k"])
    assert len(list((path / "k=1").glob("*.parquet"))) > 1
    assert spark.read.parquet(str(path)).count() == 200_000


def test_work_dir_lies_in_the_shared_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    first, second = work_dir(spark, "x"), work_dir(spark, "x")
    assert first.startswith(f"{root}/stayscope/x-")
    assert first != second


def test_materialize_replaces(spark, tmp_path):
    path = str(tmp_path / "t")
    materialize(spark.range(5), path)
    assert materialize(spark.range(2), path).count() == 2


def test_settings_are_put_back(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with settings(spark, {"spark.sql.shuffle.partitions": "3", "spark.stayscope.x": "1"}):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "3"
        assert spark.conf.get("spark.stayscope.x") == "1"
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert spark.conf.get("spark.stayscope.x", None) is None


def test_settings_grow_with_the_input():
    def tasks(input_bytes):
        values = settings_for(input_bytes, cores=8)
        scanned = int(values["spark.sql.files.maxPartitionBytes"])
        return input_bytes / scanned, int(values["spark.sql.shuffle.partitions"])

    assert tasks(10**6) == (pytest.approx(0, abs=0.01), 8)
    assert tasks(10**12) == (pytest.approx(7450, abs=5), 3726)
    assert tasks(100 * 10**12) == (pytest.approx(100_000), 40_000)

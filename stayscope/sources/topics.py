"""Message topics: JSON objects in a column ``value``.

Any format whose rows have such a column can stand for a topic. The default is Kafka,
which needs its package deployed; a folder of ``text`` files works the same.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DataType,
    DoubleType,
    NumericType,
    StringType,
    StructField,
    StructType,
)

CORRUPT = "_corrupt_record"


def kafka_options(servers: str, topic: str, **more: str) -> dict[str, str]:
    """Options to read ``topic`` from its beginning, even where its head has expired."""
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
        **more,
    }


def kafka_sink_options(servers: str, topic: str, **more: str) -> dict[str, str]:
    """Options to write messages to ``topic``."""
    return {"kafka.bootstrap.servers": servers, "topic": topic, **more}


def read_topic(
    spark: SparkSession, options: Mapping[str, str], fmt: str = "kafka", path: str | None = None
) -> DataFrame:
    """All messages of a topic, as text in ``value``."""
    return _text(spark.read.format(fmt).options(**options).load(path))


def read_topic_stream(
    spark: SparkSession, options: Mapping[str, str], fmt: str = "kafka", path: str | None = None
) -> DataFrame:
    """Messages of a topic as they arrive, as text in ``value``."""
    return _text(spark.readStream.format(fmt).options(**options).load(path))


def _text(messages: DataFrame) -> DataFrame:
    return messages.select(F.col("value").cast("string").alias("value"))


def decode_json(
    messages: DataFrame, schema: StructType | str, column: str = "value", keep: tuple[str, ...] = ()
) -> DataFrame:
    """One column per field of ``schema``, next to the columns in ``keep``.

    A malformed message gives nulls; its text is in ``_corrupt_record`` if the schema
    has that field.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    fields = F.from_json(F.col(column), schema, options).alias("fields")
    return messages.select(*keep, fields).select(*keep, "fields.*")


def encode_json(frame: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Each row as one JSON object in ``value``; null fields are left out."""
    return frame.select(*keep, F.to_json(F.struct("*")).alias("value"))


def infer_json_schema(messages: DataFrame, column: str = "value") -> str:
    """Schema of the JSON objects in ``column``, as DDL, from all of them.

    One distributed aggregate; only the schema reaches the driver. Fractions become
    doubles, fields that are always null or differ in type become strings, and
    ``_corrupt_record`` is added if a message is malformed or no object.
    """
    # parsed in a step of its own, as both aggregates use it; only objects have fields
    parsed = messages.select(
        F.col(column).isNotNull().alias("sent"), F.try_parse_json(column).alias("json")
    )
    is_object = F.schema_of_variant("json").startswith("OBJECT<")
    parsed = parsed.select("sent", F.when(is_object, F.col("json")).alias("json"))
    found = parsed.agg(
        F.schema_of_variant_agg("json").alias("shape"),
        F.count_if(F.col("sent") & F.col("json").isNull()).alias("malformed"),
    ).first()
    if not found["shape"].startswith("OBJECT<"):
        raise ValueError(f"no JSON objects to infer a schema from, only {found['shape']}")
    fields = _as_ddl(found["shape"])[len("STRUCT<") : -1]
    if found["malformed"]:
        fields = ", ".join(filter(None, [fields, f"{CORRUPT}: STRING"]))
    return f"STRUCT<{fields}>"


def _as_ddl(shape: str) -> str:
    """A variant shape as a Spark type; field names are left as they are."""
    types = {"OBJECT": "STRUCT", "VOID": "STRING", "VARIANT": "STRING", "DECIMAL": "DOUBLE"}
    # a type stands at the start, after the colon of a field, or inside of ARRAY<>
    found = r"(?:(?<=: )|(?<=ARRAY<)|^)(OBJECT|VOID|VARIANT|DECIMAL)(?:\(\d+,\s*\d+\))?"
    quoted_or_not = re.split(r"(`(?:[^`]|``)*`)", shape)
    for i in range(0, len(quoted_or_not), 2):
        quoted_or_not[i] = re.sub(found, lambda type_: types[type_[1]], quoted_or_not[i])
    return "".join(quoted_or_not)


def read_json_topic(messages: DataFrame, schema: StructType | str | None = None) -> DataFrame:
    """Decoded messages; without ``schema`` it is inferred from all of them first."""
    return decode_json(messages, schema or infer_json_schema(messages))


def stored_variants(messages: DataFrame, path: str, column: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Parse messages once, into VARIANT, and append them to the files at ``path``; returns what was appended.

    ``json`` is null where the text is no JSON object; ``text`` has such a text. The topic is read once, so
    the schema is inferred from the very messages that are decoded, also while it grows.
    """
    parsed = messages.select(*keep, F.col(column).alias("text"), F.try_parse_json(column).alias("json"))
    is_object = F.coalesce(F.schema_of_variant("json").startswith("OBJECT<"), F.lit(False))
    kept = parsed.select(*keep, F.when(is_object, F.col("json")).alias("json"), F.when(~is_object, F.col("text")).alias("text"))
    folder = f"{path}/run-{uuid.uuid4().hex}"
    kept.write.parquet(folder)
    return messages.sparkSession.read.parquet(folder)


def schema_of_variants(stored: DataFrame) -> str:
    """The schema of ``stored_variants``, as ``infer_json_schema`` gives it, from one pass over the files."""
    found = stored.agg(F.schema_of_variant_agg("json").alias("shape"), F.count("text").alias("malformed")).first()
    if not found["shape"].startswith("OBJECT<"):
        raise ValueError(f"no JSON objects to infer a schema from, only {found['shape']}")
    fields = _as_ddl(found["shape"])[len("STRUCT<") : -1]
    if found["malformed"]:
        fields = ", ".join(filter(None, [fields, f"{CORRUPT}: STRING"]))
    return f"STRUCT<{fields}>"


def decode_variants(stored: DataFrame, schema: StructType | str, keep: tuple[str, ...] = ()) -> DataFrame:
    """One column per field of ``schema``, from ``stored_variants``; what has another type is null."""
    if isinstance(schema, str):
        schema = DataType.fromDDL(schema)
    columns = []
    for field in schema.fields:
        if field.name == CORRUPT:
            columns.append(F.col("text").alias(CORRUPT))
            continue
        quoted = field.name.replace("\\", "\\\\").replace("'", "\\'")
        kind = field.dataType.simpleString()
        columns.append(F.try_variant_get("json", f"$['{quoted}']", kind).alias(field.name))
    return stored.select(*keep, *columns)


def merged_schema(old: StructType, new: StructType) -> StructType:
    """The fields of both; a field whose type differs becomes the wider number, or a string."""
    known = {f.name: f.dataType for f in old.fields}
    for f in new.fields:
        known[f.name] = _merged_type(known[f.name], f.dataType) if f.name in known else f.dataType
    return StructType([StructField(name, kind) for name, kind in known.items()])


def _merged_type(a: DataType, b: DataType) -> DataType:
    if a == b:
        return a
    if isinstance(a, StructType) and isinstance(b, StructType):
        return merged_schema(a, b)
    if isinstance(a, ArrayType) and isinstance(b, ArrayType):
        return ArrayType(_merged_type(a.elementType, b.elementType))
    if isinstance(a, NumericType) and isinstance(b, NumericType):
        return DoubleType()
    return StringType()

"""Streaming sources, read from the earliest record on."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartspark.sources.events import EVENT_SCHEMA, TEXT_SCHEMA, conform_events


def stream_events(
    spark: SparkSession,
    path: str,
    fmt: str = "json",
    max_files: int | None = None,
    schema: T.StructType | None = None,
) -> DataFrame:
    """Events from a folder of csv, json, parquet or orc files, those already there first.

    ``schema`` is for files that do not hold the event columns; their rows are returned as they are.
    """
    text = fmt in ("csv", "json")
    reader = spark.readStream.format(fmt).schema(schema or (TEXT_SCHEMA if text else EVENT_SCHEMA))
    if fmt == "csv":
        # The schema goes by position; a header that differs from it is an error, not a silent mix-up.
        reader = reader.option("header", True).option("enforceSchema", False)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    raw = reader.load(path)
    return raw if schema is not None else conform_events(raw)


def stream_values(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    """Key and JSON text of the records of a Kafka topic, from the earliest offset unless ``options`` differ.

    Needs the Kafka connector package on the class path of the session.
    """
    settings = {"startingOffsets": "earliest", **options}
    topic = spark.readStream.format("kafka").options(**settings).load()
    return topic.select(F.col("key").cast("string"), F.col("value").cast("string"))


def record_values(
    spark: SparkSession, path: str, fmt: str = "json", max_files: int | None = None, *, stream: bool = True
) -> DataFrame:
    """The records of a folder of files as text in a column ``value``, as a stream or as a table.

    Lines of JSON come as they are. Rows of csv, parquet and orc files become JSON objects of all their columns, nulls
    included.
    """
    reader = spark.readStream if stream else spark.read
    if stream and max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if fmt == "json":
        return reader.text(path)
    if fmt == "csv":
        schema = spark.read.option("header", True).csv(path).schema
        reader = reader.option("header", True).option("enforceSchema", False)
    else:
        schema = spark.read.format(fmt).load(path).schema
    rows = reader.format(fmt).schema(schema).load(path)
    return rows.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))

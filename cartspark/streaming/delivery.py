"""Publishing a stream of events, with a tally of what was delivered in every micro-batch."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cartspark.sources.versions import names_in, remove_table, write_text
from cartspark.streaming.archive import BATCH, keyed_envelope, stamp_ingestion

# Parts of the output folder.
SENT, FAILED, TALLY = "sent", "failed", "tally"
Sink = Callable[[DataFrame, int], None]


def file_sink(path: str, fmt: str = "json") -> Sink:
    """Writes the key and value of a micro-batch into a folder of its own, which a rerun replaces."""

    def send(records: DataFrame, batch_id: int) -> None:
        records.write.mode("overwrite").format(fmt).save(f"{path.rstrip('/')}/{SENT}/{BATCH}={batch_id}")

    return send


def topic_sink(options: dict[str, str]) -> Sink:
    """Sends key and value of a micro-batch to a Kafka topic; needs the connector, and a rerun sends again."""

    def send(records: DataFrame, batch_id: int) -> None:
        records.write.format("kafka").options(**options).save()

    return send


def publish_stream(
    events: DataFrame,
    path: str,
    checkpoint: str,
    send: Sink | None = None,
    key: str = "visitorid",
    largest: int | None = None,
    at: Column | None = None,
    *,
    drain: bool = True,
) -> StreamingQuery:
    """Send the stream's events as stamped, keyed JSON, and keep a tally of each micro-batch below ``path``.

    A record without a key is sent, and counted as unkeyed. One whose value has more than ``largest`` bytes would be
    refused by a broker: it is not sent, but kept in ``path/failed`` and counted as failed. ``send`` defaults to files
    below ``path/sent``. Counts are taken while the records are sent, so the micro-batch is read once (and a second time
    only for failed records), and are written after it was delivered: a rerun sends and counts it anew.
    """
    spark, path = events.sparkSession, path.rstrip("/")
    send = send or file_sink(path)

    def deliver(batch: DataFrame, batch_id: int) -> None:
        tally, fits = Observation(), F.lit(True) if largest is None else F.octet_length("value") <= largest
        records = keyed_envelope(stamp_ingestion(batch, at), key).withColumn("fits", fits)
        counted = records.observe(
            tally,
            F.count_if("fits").alias("sent"),
            F.count_if(F.col("fits") & F.col("key").isNull()).alias("unkeyed"),
            F.count_if(~F.col("fits")).alias("failed"),
        )
        send(counted.filter("fits").select("key", "value"), batch_id)
        counts, failed = tally.get, f"{path}/{FAILED}/{BATCH}={batch_id}"
        if counts["failed"]:
            records.filter("NOT fits").select("key", "value").write.mode("overwrite").json(failed)
        else:
            remove_table(spark, failed)
        write_text(spark, f"{path}/{TALLY}/{BATCH}={batch_id}/tally.json", json.dumps(counts))

    writer = events.writeStream.option("checkpointLocation", checkpoint)
    if drain:
        writer = writer.trigger(availableNow=True)
    return writer.foreachBatch(deliver).start()


def read_tally(spark: SparkSession, path: str) -> DataFrame:
    """batch_id, sent, unkeyed and failed of every micro-batch."""
    fields, names = f"sent bigint, unkeyed bigint, failed bigint, {BATCH} bigint", (BATCH, "sent", "unkeyed", "failed")
    folder = f"{path.rstrip('/')}/{TALLY}"
    if not names_in(spark, folder):
        return spark.createDataFrame([], fields).select(*names)
    return spark.read.schema(fields).json(folder).select(*names)


def read_sent(spark: SparkSession, path: str) -> DataFrame:
    """Key and value of everything that ``file_sink`` wrote as JSON."""
    return spark.read.schema("key string, value string").json(f"{path.rstrip('/')}/{SENT}").select("key", "value")

"""A count estimate for every micro-batch of a stream, without any state."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cartspark.functions.expressions import ALERT_THRESHOLD
from cartspark.operators.trends import micro_batch_estimate
from cartspark.streaming.archive import BATCH
from cartspark.streaming.envelope import failed_records


def stream_batch_estimates(
    records: DataFrame,
    path: str,
    checkpoint: str,
    threshold: float = ALERT_THRESHOLD,
    dead_letters: str | None = None,
    *,
    drain: bool = True,
) -> StreamingQuery:
    """One estimate row per micro-batch, written to ``path``.

    ``records`` are events or decoded records. ``dead_letters`` is a folder for the records that could not be
    decoded; plain events have none. A micro-batch is read and decoded once for both.
    """
    apart = dead_letters is not None and "failure_reason" in records.columns

    def write_estimate(batch: DataFrame, batch_id: int) -> None:
        if apart:
            batch.persist()
        try:
            estimate = micro_batch_estimate(batch, threshold=threshold)
            estimate.coalesce(1).write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")
            if apart:
                failed_records(batch).write.mode("overwrite").json(f"{dead_letters}/{BATCH}={batch_id}")
        finally:
            if apart:
                batch.unpersist()

    writer = records.writeStream.option("checkpointLocation", checkpoint)
    if drain:
        writer = writer.trigger(availableNow=True)
    return writer.foreachBatch(write_estimate).start()


def read_estimates(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).withColumn(BATCH, F.col(BATCH).cast("bigint"))

"""Counts of events: per hour of the history, and per micro-batch of the stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartspark.functions import alert_status, hour_of, percent, round_half_even
from cartspark.functions.expressions import ALERT_THRESHOLD
from cartspark.sources.events import ADD_TO_CART, EVENT_TYPES, PURCHASE, VIEW


def event_counters(event: Column) -> list[Column]:
    """view_count, addtocart_count, transaction_count; zero where an event does not occur."""
    return [F.count_if(event == name).alias(f"{name}_count") for name in EVENT_TYPES]


def hourly_event_trend(events: DataFrame) -> DataFrame:
    """Views, adds and purchases per hour. An hour with other events only is kept, with zeros."""
    return (
        events.groupBy(hour_of(F.col("timestamp")).alias("hour"))
        .agg(*event_counters(F.col("event")))
        .filter(F.col("hour").isNotNull())
        .withColumn("total_event_count", sum_of_counters())
    )


def sum_of_counters() -> Column:
    return F.col(f"{VIEW}_count") + F.col(f"{ADD_TO_CART}_count") + F.col(f"{PURCHASE}_count")


def micro_batch_estimate(
    records: DataFrame, by: tuple[str, ...] = (), threshold: float = ALERT_THRESHOLD
) -> DataFrame:
    """A quick estimate per micro-batch from counts alone: adds minus purchases, not below zero.

    ``records`` are events or decoded records; where they carry a ``failure_reason``, the failed ones are counted
    apart, and where they carry a ``record_number``, a row without one stands for a batch without records.
    ``by`` names the columns that tell the batches apart; without it the whole frame is one batch.
    """
    failed = (
        F.col("failure_reason").isNotNull() if "failure_reason" in records.columns else F.lit(False)
    )
    there = F.col("record_number").isNotNull() if "record_number" in records.columns else F.lit(True)
    adds, purchases = F.col(f"{ADD_TO_CART}_count"), F.col(f"{PURCHASE}_count")
    abandoned = F.greatest(adds - purchases, F.lit(0))
    rate = percent(abandoned, adds)
    return (
        records.groupBy(*by)
        .agg(
            F.count_if(there & ~failed).alias("processed_record_count"),
            F.count_if(there & failed).alias("failed_record_count"),
            *event_counters(F.when(~failed, F.col("event"))),
        )
        .select(
            *by,
            "processed_record_count",
            "failed_record_count",
            F.create_map(
                *(part for name in EVENT_TYPES for part in (F.lit(name), F.col(f"{name}_count")))
            ).alias("event_counts"),
            adds,
            purchases,
            abandoned.alias("estimated_abandoned_count"),
            round_half_even(rate, 2).alias("estimated_abandonment_rate"),
            alert_status(rate, threshold).alias("alert_status"),
        )
    )

"""Approximate distinct counts for any range of hours, from one stored row per hour.

Exact counts of visitors or items over a range need its events again, because a visitor of two hours is one visitor. A
sketch of each hour can be merged with those of others, so a range of years reads as many rows as it has hours. Exact
counts stay the default everywhere; these are asked for by name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartspark.functions import hour_of

# Base-2 logarithm of a sketch's registers: the standard error is about 1.04 / sqrt(2 ** 14), 0.8 %.
LOG_REGISTERS = 14
COUNTED = ("visitorid", "itemid")


def hourly_sketches(events: DataFrame, log_registers: int = LOG_REGISTERS) -> DataFrame:
    """hour, event_count and a sketch of the visitors and of the items; events without a time have the hour null.

    Map-side aggregation leaves one row per hour and task before the shuffle, however many events an hour has.
    """
    return events.groupBy(hour_of(F.col("timestamp")).alias("hour")).agg(
        F.count(F.lit(1)).alias("event_count"),
        *(F.hll_sketch_agg(F.col(name), F.lit(log_registers)).alias(f"{name}_sketch") for name in COUNTED),
    )


def merge_sketches(sketches: DataFrame) -> DataFrame:
    """One row per hour from the rows of several tables of sketches, each of other events."""
    return sketches.groupBy("hour").agg(F.sum("event_count").alias("event_count"), *_unions())


def approximate_uniques(sketches: DataFrame, by: dict[str, Column] | None = None) -> DataFrame:
    """event_count, approx_unique_visitors and approx_unique_items of the given hours, in all or by columns of ``hour``.

    Filter ``hour`` first for a range; the filter reaches the scan of stored sketches.
    """
    keys = [column.alias(name) for name, column in (by or {}).items()]
    merged = sketches.groupBy(*keys).agg(F.coalesce(F.sum("event_count"), F.lit(0)).alias("event_count"), *_unions())
    names = {"visitorid": "approx_unique_visitors", "itemid": "approx_unique_items"}
    return merged.select(
        *(by or {}),
        "event_count",
        *(F.coalesce(F.hll_sketch_estimate(f"{name}_sketch"), F.lit(0)).alias(names[name]) for name in COUNTED),
    )


def _unions() -> list[Column]:
    return [F.hll_union_agg(f"{name}_sketch").alias(f"{name}_sketch") for name in COUNTED]

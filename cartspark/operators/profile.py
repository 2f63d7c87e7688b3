"""Data checks: how often each event occurs and where values are missing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def event_type_counts(events: DataFrame) -> DataFrame:
    """Rows per event name; events without a name form their own group."""
    return events.groupBy("event").agg(F.count(F.lit(1)).alias("event_count"))


def null_profile(df: DataFrame) -> DataFrame:
    """One row per column with its number of nulls, from a single pass."""
    counts = df.agg(*(F.count_if(F.col(name).isNull()).alias(name) for name in df.columns))
    return counts.unpivot([], df.columns, "column_name", "null_count")

"""Exact abandonment over the full history, one state row per visitor-item pair.

A pair is abandoned when its last add-to-cart has no later purchase; a purchase at the very same time does not
count as later. Every aggregate here is a min, max or count, so map-side partial aggregation shrinks even a pair
that holds a large share of all rows to one row per task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartspark.functions import hour_of, percent
from cartspark.sources.events import ADD_TO_CART, CART_EVENTS, PURCHASE

PAIR = ("visitorid", "itemid")


def pair_times(timestamp: Column, event: Column) -> list[Column]:
    """The aggregates that make up the state of a pair."""
    added = F.when(event == ADD_TO_CART, timestamp)
    return [
        F.min(added).alias("first_add_timestamp"),
        F.max(added).alias("last_add_timestamp"),
        F.max(F.when(event == PURCHASE, timestamp)).alias("last_transaction_timestamp"),
    ]


def pair_state(events: DataFrame) -> DataFrame:
    """First add, last add and last purchase per pair; events without a visitor or an item belong to no pair."""
    return (
        events.filter(F.col("event").isin(*CART_EVENTS))
        .filter(F.col("visitorid").isNotNull() & F.col("itemid").isNotNull())
        .groupBy(*PAIR)
        .agg(*pair_times(F.col("timestamp"), F.col("event")))
    )


def has_add() -> Column:
    return F.col("last_add_timestamp").isNotNull()


def is_abandoned() -> Column:
    purchase = F.col("last_transaction_timestamp")
    return has_add() & (purchase.isNull() | (purchase <= F.col("last_add_timestamp")))


def add_pairs(state: DataFrame) -> DataFrame:
    return state.filter(has_add())


def abandoned_pairs(state: DataFrame) -> DataFrame:
    return state.filter(is_abandoned())


def top_abandoned_products(state: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` items left in most carts; among equals the lower item id comes first."""
    return (
        abandoned_pairs(state)
        .groupBy("itemid")
        .agg(F.count(F.lit(1)).alias("abandoned_count"))
        .orderBy(F.desc("abandoned_count"), F.asc("itemid"))
        .limit(n)
    )


def hourly_abandonment_trend(state: DataFrame) -> DataFrame:
    """Pairs and abandoned pairs per hour of the first add, with the unrounded rate."""
    return (
        add_pairs(state)
        .groupBy(hour_of(F.col("first_add_timestamp")).alias("hour"))
        .agg(
            F.count(F.lit(1)).alias("addtocart_pair_count"),
            F.count_if(is_abandoned()).alias("abandoned_pair_count"),
        )
        .filter(F.col("hour").isNotNull())
        .withColumn(
            "abandonment_rate", percent(F.col("abandoned_pair_count"), F.col("addtocart_pair_count"))
        )
    )

"""The whole batch report from one scan and one shuffle of the history.

Grouping sets count the history by hour, by visitor, by item and by visitor-item pair at once. The summary, the
hourly trend, the top products and the hourly abandonment all follow from that rollup, which is far smaller than
the events: one row per hour, visitor and item, and per pair that was ever in a cart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartspark.functions import hour_of, percent, round_half_even
from cartspark.operators.pairs import has_add, is_abandoned, pair_times
from cartspark.operators.trends import event_counters, sum_of_counters
from cartspark.sources.events import CART_EVENTS, EVENT_SCHEMA

HOUR, VISITOR, ITEM, PAIR = "hour", "visitor", "item", "pair"
# Level of a profile only.
EVENT = "event"
LEVEL_KEYS = {
    HOUR: ("hour",),
    VISITOR: ("visitorid",),
    ITEM: ("itemid",),
    PAIR: ("cart_visitorid", "cart_itemid"),
}

ROLLUP_COLUMNS = (
    *(key for keys in LEVEL_KEYS.values() for key in keys),
    "level",
    "event_count",
    "view_count",
    "addtocart_count",
    "transaction_count",
    "first_add_timestamp",
    "last_add_timestamp",
    "last_transaction_timestamp",
)


def history_rollup(
    events: DataFrame, levels: tuple[str, ...] = tuple(LEVEL_KEYS), *, profile: bool = False
) -> DataFrame:
    """One row per level and key, with event counts and the times of the pair state.

    With ``profile`` there is one more level, by event name, and each row has the number of nulls in every column.

    Only cart events carry pair keys. All others share one empty pair, which map-side aggregation reduces to a
    row per task, so views add nothing to the pair level.
    """
    in_cart = (
        F.col("event").isin(*CART_EVENTS)
        & F.col("visitorid").isNotNull()
        & F.col("itemid").isNotNull()
    )
    nulls = [F.col(name).isNull().alias(f"{name}_null") for name in EVENT_SCHEMA.names] if profile else []
    keyed = events.select(
        *nulls,
        *([F.col("event").alias("event_name")] if profile else []),
        "timestamp",
        "event",
        "visitorid",
        "itemid",
        hour_of(F.col("timestamp")).alias("hour"),
        F.when(in_cart, F.col("visitorid")).alias("cart_visitorid"),
        F.when(in_cart, F.col("itemid")).alias("cart_itemid"),
    )
    level_keys = {name: LEVEL_KEYS[name] for name in levels} | ({EVENT: ("event_name",)} if profile else {})
    keys = [key for names in level_keys.values() for key in names]
    level = F.lit(None).cast("string")
    for name, names in level_keys.items():
        level = F.when(F.grouping(names[0]) == 0, F.lit(name)).otherwise(level)
    return (
        keyed.groupingSets([[F.col(key) for key in names] for names in level_keys.values()], *keys)
        .agg(
            level.alias("level"),
            F.count(F.lit(1)).alias("event_count"),
            *event_counters(F.col("event")),
            *pair_times(F.col("timestamp"), F.col("event")),
            *(F.count_if(f"{name}_null").alias(f"{name}_nulls") for name in EVENT_SCHEMA.names if profile),
        )
    )


def merge_rollups(rollups: DataFrame) -> DataFrame:
    """One rollup from the rows of several: of the whole history, if each holds other events of it.

    Counts add up, first and last times are the first and last of all; so whichever events came together does not matter.
    """
    keys = [key for level in LEVEL_KEYS.values() for key in level]
    merged = rollups.groupBy("level", *keys).agg(
        *(F.sum(name).alias(name) for name in ("event_count", "view_count", "addtocart_count", "transaction_count")),
        F.min("first_add_timestamp").alias("first_add_timestamp"),
        F.max("last_add_timestamp").alias("last_add_timestamp"),
        F.max("last_transaction_timestamp").alias("last_transaction_timestamp"),
    )
    return merged.select(*ROLLUP_COLUMNS)


def rollup_hours(rollup: DataFrame) -> DataFrame:
    """The hourly event trend."""
    counters = ("view_count", "addtocart_count", "transaction_count")
    return (
        rollup.filter((F.col("level") == HOUR) & F.col("hour").isNotNull())
        .select("hour", *counters)
        .withColumn("total_event_count", sum_of_counters())
    )


def rollup_event_types(rollup: DataFrame) -> DataFrame:
    """Rows per event name, from a rollup with ``profile``."""
    return rollup.filter(F.col("level") == EVENT).select(F.col("event_name").alias("event"), "event_count")


def rollup_nulls(rollup: DataFrame) -> DataFrame:
    """Nulls per column, from a rollup with ``profile``. Every event is in exactly one row of the level by name."""
    named = rollup.filter(F.col("level") == EVENT)
    sums = named.agg(*(F.coalesce(F.sum(f"{n}_nulls"), F.lit(0)).alias(n) for n in EVENT_SCHEMA.names))
    return sums.unpivot([], EVENT_SCHEMA.names, "column_name", "null_count")


def rollup_pairs(rollup: DataFrame) -> DataFrame:
    """The state of every pair that was in a cart or bought."""
    return rollup.filter(
        (F.col("level") == PAIR) & F.col("cart_visitorid").isNotNull()
    ).select(
        F.col("cart_visitorid").alias("visitorid"),
        F.col("cart_itemid").alias("itemid"),
        "first_add_timestamp",
        "last_add_timestamp",
        "last_transaction_timestamp",
    )


def rollup_summary(rollup: DataFrame, scale: int | None = 4) -> DataFrame:
    """The one-row summary. ``scale=None`` leaves the rate unrounded."""
    at_item = F.col("level") == ITEM
    is_pair = (F.col("level") == PAIR) & F.col("cart_visitorid").isNotNull()

    def total(counter: str):
        # Every event is in exactly one row of the item level.
        return F.coalesce(F.sum(F.when(at_item, F.col(counter))), F.lit(0))

    pairs, abandoned = (
        F.col("unique_addtocart_visitor_item_pairs"),
        F.col("abandoned_visitor_item_pairs"),
    )
    return rollup.agg(
        total("event_count").alias("total_rows"),
        total("view_count").alias("total_views"),
        total("addtocart_count").alias("total_addtocart_events"),
        total("transaction_count").alias("total_transactions"),
        F.count_if((F.col("level") == VISITOR) & F.col("visitorid").isNotNull()).alias("unique_visitors"),
        F.count_if(at_item & F.col("itemid").isNotNull()).alias("unique_items"),
        F.count_if(is_pair & has_add()).alias("unique_addtocart_visitor_item_pairs"),
        F.count_if(is_pair & is_abandoned()).alias("abandoned_visitor_item_pairs"),
    ).withColumn("overall_cart_abandonment_rate", round_half_even(percent(abandoned, pairs), scale))


def batch_summary(events: DataFrame, scale: int | None = 4) -> DataFrame:
    """Totals, distinct visitors and items, and the overall abandonment rate, as one row."""
    return rollup_summary(history_rollup(events, (VISITOR, ITEM, PAIR)), scale)

"""Abandonment in sliding event-time windows.

Within a window a pair is abandoned when it was added and not bought in that same window, in whatever order.

Copying every event into each of its windows multiplies the data by width / slide before the shuffle. The batch
form avoids that. Time is cut into panes as long as the slide, and each pane in which a pair was added owns a
run of windows: those in which it is the pair's last add. Purchases before and after cut that run shorter. A run
has two ends however wide the window is, so two rows per add are shuffled where copying would shuffle one per
window.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartspark.functions import (
    alert_status,
    event_time,
    pane_ceil,
    pane_floor,
    percent,
    round_half_even,
)
from cartspark.functions.expressions import ALERT_THRESHOLD, MINUTE_MS
from cartspark.sources.events import ADD_TO_CART, CART_EVENTS, PURCHASE

EVENT_COUNTS = ("event_count", "addtocart_count", "transaction_count")
PAIR_COUNTS = ("pair_count", "estimated_abandoned_count")
TOP_ITEMS = 5


def sliding_windows(
    events: DataFrame,
    width_minutes: int = 5,
    slide_minutes: int = 1,
    threshold: float = ALERT_THRESHOLD,
    cart_events: DataFrame | None = None,
    bounds: tuple[int, int] | None = None,
) -> DataFrame:
    """One row per window that holds an event.

    Windows start on multiples of the slide. The first starts at or just before the first event, and the last
    ends at or just after the last event; an event exactly at that end is outside. ``cart_events`` may give the
    add and purchase events alone where the caller can filter them in the file scan. ``bounds`` are the first start
    and the last end where they are known, counted in slides.
    """
    span = _panes_per_window(width_minutes, slide_minutes)
    pane_ms = slide_minutes * MINUTE_MS
    carts = _cart_panes(events if cart_events is None else cart_events, pane_ms)
    totals = _window_totals(events, span, pane_ms, bounds)
    return _joined_windows(totals, carts, span, pane_ms, threshold)


def _joined_windows(
    totals: DataFrame, carts: DataFrame, span: int, pane_ms: int, threshold: float
) -> DataFrame:
    pairs = _summarise_items(_items_per_window(_window_runs(carts, span)), PAIR_COUNTS)
    # Both sides are already partitioned by start, so joining them in place costs no shuffle and no broadcast.
    windows = totals.join(pairs.hint("shuffle_hash"), "start", "left")
    return _window_rows(windows, F.col("start") * pane_ms, span * pane_ms, threshold)


def windows_from_panes(
    panes: DataFrame,
    bounds: tuple[int, int],
    width_minutes: int,
    slide_minutes: int = 1,
    threshold: float = ALERT_THRESHOLD,
) -> DataFrame:
    """The windows within ``bounds`` (first start and last end, counted in slides) from events reduced to panes.

    ``panes`` has pane, visitorid, itemid and the event counts, once for each pane and pair; events other than adds and
    purchases have no pair. All panes of the windows must be there.
    """
    span = _panes_per_window(width_minutes, slide_minutes)
    added, bought = F.col("addtocart_count") > 0, F.col("transaction_count") > 0
    carts = panes.filter(added | bought).select(
        "visitorid",
        "itemid",
        "pane",
        F.when(added, F.col("pane")).alias("add_pane"),
        F.when(bought, F.col("pane")).alias("buy_pane"),
    )
    counts = panes.groupBy("pane").agg(*(F.sum(name).alias(name) for name in EVENT_COUNTS))
    totals = _spread(counts, span, F.lit(bounds[0]), F.lit(bounds[1]))
    return _joined_windows(totals, carts, span, slide_minutes * MINUTE_MS, threshold)


def _panes_per_window(width_minutes: int, slide_minutes: int) -> int:
    if width_minutes <= 0 or slide_minutes <= 0 or width_minutes % slide_minutes:
        raise ValueError("the width must be a positive multiple of the slide")
    return width_minutes // slide_minutes


def last_windows(
    events: DataFrame,
    n: int = 1,
    width_minutes: int = 5,
    slide_minutes: int = 1,
    threshold: float = ALERT_THRESHOLD,
    between: Callable[[int, int], tuple[DataFrame, DataFrame]] | None = None,
) -> DataFrame:
    """The last ``n`` windows that hold an event, without making the others.

    Counts per pane, from the time column alone, give their starts; then only the events of those windows are read.
    ``between`` returns all events and the add and purchase events from one epoch millisecond to another, where the
    caller can filter the scan by it; else the events are filtered by ``timestamp``.
    """
    span, pane_ms = _panes_per_window(width_minutes, slide_minutes), slide_minutes * MINUTE_MS
    panes = (
        events.groupBy(pane_floor(F.col("timestamp"), pane_ms).alias("pane"))
        .agg(F.max(pane_ceil(F.col("timestamp"), pane_ms)).alias("ceil"))
        .filter(F.col("pane").isNotNull())
    )
    ends = panes.agg(F.min("pane"), F.max("ceil")).first()
    starts = []
    if ends[0] is not None:
        starts = (
            panes.selectExpr(f"explode(sequence(pane - {span - 1}, pane)) AS start")
            .filter(F.col("start").between(ends[0], ends[1] - span))
            .distinct()
            .orderBy(F.desc("start"))
            .limit(n)
            .collect()
        )
    first, last = (starts[-1][0], starts[0][0] + span) if starts else (0, 0)
    low, high = first * pane_ms, last * pane_ms - 1
    if between is None:
        part = events.filter(F.col("timestamp").between(low, high))
        carts = part
    else:
        part, carts = between(low, high)
    return sliding_windows(part, width_minutes, slide_minutes, threshold, carts, (first, last))


def _window_totals(
    events: DataFrame, span: int, pane_ms: int, known: tuple[int, int] | None
) -> DataFrame:
    """Event counts per window. Only the counts per pane are copied into windows, not the events."""
    panes = (
        events.groupBy(pane_floor(F.col("timestamp"), pane_ms).alias("pane"))
        .agg(*_event_counts(F.col("event")))
        .filter(F.col("pane").isNotNull())
    )
    if known is None:
        bounds = events.agg(
            F.struct(
                F.min(pane_floor(F.col("timestamp"), pane_ms)).alias("first_start"),
                F.max(pane_ceil(F.col("timestamp"), pane_ms)).alias("last_end"),
            )
        ).scalar()
    else:
        bounds = F.struct(F.lit(known[0]).alias("first_start"), F.lit(known[1]).alias("last_end"))
    return _spread(panes, span, bounds["first_start"], bounds["last_end"])


def _spread(panes: DataFrame, span: int, first_start: Column, last_end: Column) -> DataFrame:
    """Counts of panes summed over the windows that hold them."""
    return (
        panes.selectExpr(f"explode(sequence(pane - {span - 1}, pane)) AS start", *EVENT_COUNTS)
        .filter(F.col("start") >= first_start)
        .filter(F.col("start") + span <= last_end)
        .groupBy("start")
        .agg(*(F.sum(name).alias(name) for name in EVENT_COUNTS))
    )


def _event_counts(event: Column) -> list[Column]:
    counts = (F.count(F.lit(1)), F.count_if(event == ADD_TO_CART), F.count_if(event == PURCHASE))
    return [count.alias(name) for count, name in zip(counts, EVENT_COUNTS)]


def _cart_panes(events: DataFrame, pane_ms: int) -> DataFrame:
    """Panes in which a pair was added or bought. A pair keeps one row per pane, however many events it has."""
    pane = F.col("pane")
    return (
        events.filter(F.col("event").isin(*CART_EVENTS))
        .withColumn("pane", pane_floor(F.col("timestamp"), pane_ms))
        .filter(pane.isNotNull())
        .groupBy("visitorid", "itemid", "pane")
        .agg(
            F.max(F.when(F.col("event") == ADD_TO_CART, pane)).alias("add_pane"),
            F.max(F.when(F.col("event") == PURCHASE, pane)).alias("buy_pane"),
        )
    )


def _window_runs(panes: DataFrame, span: int) -> DataFrame:
    """Per pair and pane with an add: the window starts it owns, and those of them without a purchase."""
    pair = "OVER (PARTITION BY visitorid, itemid ORDER BY pane)"
    neighbours = panes.selectExpr(
        "itemid",
        "add_pane",
        "buy_pane",
        f"lead(add_pane) IGNORE NULLS {pair} AS next_add",
        f"lead(buy_pane) IGNORE NULLS {pair} AS next_buy",
        f"lag(buy_pane) IGNORE NULLS {pair} AS last_buy",
    )
    # least and greatest skip nulls, so a missing neighbour sets no limit.
    return neighbours.filter("add_pane IS NOT NULL").selectExpr(
        "itemid",
        f"add_pane - {span - 1} AS first",
        f"least(add_pane, next_add - {span}) AS last",
        f"greatest(add_pane - {span - 1}, last_buy + 1) AS first_open",
        "CASE WHEN buy_pane IS NULL THEN "
        f"least(add_pane, next_add - {span}, next_buy - {span}) END AS last_open",
    )


def _items_per_window(runs: DataFrame) -> DataFrame:
    """Pairs and abandoned pairs per window and item, as running totals of the ends of the runs."""
    steps = runs.selectExpr(
        "itemid",
        "stack(4, first, 1, 0, last + 1, -1, 0, "
        "if(first_open <= last_open, first_open, NULL), 0, 1, "
        "if(first_open <= last_open, last_open + 1, NULL), 0, -1) AS (at, pair_step, open_step)",
    ).filter("at IS NOT NULL")
    buckets = _buckets(runs.sparkSession)
    totals = (
        steps.groupBy("itemid", "at")
        .agg(F.sum("pair_step").alias("pair_step"), F.sum("open_step").alias("open_step"))
        .filter("pair_step != 0 OR open_step != 0")
        .withColumn("bucket", _bucket(buckets))
        # One bucket per partition: running totals and the ranking in buckets both work on this one shuffle.
        # The rows grow by the runs' length after it, so AQE must not merge partitions by their size before.
        .repartitionById(buckets, "bucket")
    )
    in_time = "OVER (PARTITION BY bucket, itemid ORDER BY at"
    so_far = f"{in_time} ROWS UNBOUNDED PRECEDING)"
    return (
        totals.selectExpr(
            "bucket",
            "itemid",
            "at",
            f"lead(at) {in_time}) AS until",
            f"sum(pair_step) {so_far} AS pair_count",
            f"sum(open_step) {so_far} AS estimated_abandoned_count",
        )
        .filter("pair_count > 0")
        .selectExpr("bucket", "explode(sequence(at, until - 1)) AS start", "itemid", *PAIR_COUNTS)
    )


def _buckets(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("itemid"), F.lit(buckets)).cast("int")


def _summarise_items(items: DataFrame, counts: tuple[str, ...]) -> DataFrame:
    """Per window: the counts summed over its items, and its top items by abandoned pairs.

    Items are ranked in buckets first. Each bucket passes on at most five rows per window, so the number of
    items that share a window has no bearing on the size of the last step.
    """
    abandoned = F.col("estimated_abandoned_count")
    in_top = F.col("itemid").isNotNull() & (abandoned > 0)
    order = (F.desc("in_top"), F.desc("estimated_abandoned_count"), F.asc("itemid"))
    ranking = Window.partitionBy("bucket", "start").orderBy(*order)
    # The sums use the order of the ranking, although they need none, so that one sort serves both.
    whole = ranking.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    best = (
        items.withColumn("in_top", in_top)
        .select(
            "start",
            "itemid",
            *(F.sum(name).over(whole).alias(f"bucket_{name}") for name in counts),
            "in_top",
            "estimated_abandoned_count",
            F.row_number().over(ranking).alias("rank"),
        )
        .filter(F.col("rank") <= TOP_ITEMS)
        .withColumn("place", F.row_number().over(Window.partitionBy("start").orderBy(*order)))
    )
    places = [f"max(if(in_top AND place = {n}, itemid, NULL))" for n in range(1, TOP_ITEMS + 1)]
    return best.groupBy("start").agg(
        *(F.expr(f"sum(if(rank = 1, bucket_{name}, NULL))").alias(name) for name in counts),
        F.expr(f"CAST(array_compact(array({', '.join(places)})) AS ARRAY<STRING>)").alias(
            "top_5_abandoned_item_ids"
        ),
    )


def _window_rows(
    windows: DataFrame, start_ms: Column, width_ms: int, threshold: float
) -> DataFrame:
    abandoned = F.coalesce(F.col("estimated_abandoned_count"), F.lit(0))
    rate = percent(abandoned, F.col("pair_count"))
    return windows.select(
        F.timestamp_millis(start_ms).alias("window_start"),
        F.timestamp_millis(start_ms + width_ms).alias("window_end"),
        *EVENT_COUNTS,
        abandoned.alias("estimated_abandoned_count"),
        round_half_even(rate, 4).alias("estimated_abandonment_rate"),
        F.coalesce("top_5_abandoned_item_ids", F.array().cast("array<string>")).alias(
            "top_5_abandoned_item_ids"
        ),
        alert_status(rate, threshold).alias("alert_status"),
    )


def cart_groups(events: DataFrame, width_minutes: int, slide_minutes: int) -> DataFrame:
    """Event counts per window and visitor-item pair; works on a stream with a watermark on ``event_time``.

    Events other than adds and purchases matter for the event count alone and share one group per window, so
    they take no state per pair.
    """
    _panes_per_window(width_minutes, slide_minutes)
    in_cart = F.col("event").isin(*CART_EVENTS)
    return events.groupBy(
        F.window("event_time", f"{width_minutes} minutes", f"{slide_minutes} minutes"),
        in_cart.alias("in_cart"),
        F.when(in_cart, F.col("visitorid")).alias("visitorid"),
        F.when(in_cart, F.col("itemid")).alias("itemid"),
    ).agg(*_event_counts(F.col("event")))


def windows_from_groups(
    groups: DataFrame, width_minutes: int, threshold: float = ALERT_THRESHOLD
) -> DataFrame:
    """Window rows from ``cart_groups``, for windows whose groups are all present."""
    added = F.col("addtocart_count") > 0
    items = groups.groupBy(
        F.unix_millis("window.start").alias("start"),
        _bucket(_buckets(groups.sparkSession)).alias("bucket"),
        "itemid",
    ).agg(
        *(F.sum(name).alias(name) for name in EVENT_COUNTS),
        F.count_if(added).alias("pair_count"),
        F.count_if(added & (F.col("transaction_count") == 0)).alias("estimated_abandoned_count"),
    )
    windows = _summarise_items(items, EVENT_COUNTS + PAIR_COUNTS)
    return _window_rows(windows, F.col("start"), width_minutes * MINUTE_MS, threshold)


def latest_window(windows: DataFrame) -> DataFrame:
    """The window that ends last; no row when there is no window."""
    latest = windows.agg(F.max_by(F.struct("*"), "window_end").alias("latest"))
    return latest.filter(F.col("latest").isNotNull()).select("latest.*")


def recent_windows(windows: DataFrame, n: int = 10) -> DataFrame:
    return windows.orderBy(F.desc("window_end")).limit(n)

"""The serving view: history and the latest window side by side, as one row, and the alert text made of it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartspark.functions import first_list_item, utc_text
from cartspark.operators.windows import latest_window


def _latest(windows: DataFrame):
    """The latest window as one struct value, null when there is no window."""
    return latest_window(windows).select(F.struct("*").alias("latest")).scalar()


def _top_item(top: DataFrame):
    best = top.agg(F.max_by("itemid", F.struct("abandoned_count", -F.col("itemid"))).alias("itemid"))
    return best.scalar()


def serving_view(summary: DataFrame, top: DataFrame, windows: DataFrame) -> DataFrame:
    """One row. Without any window its latest columns are null; without top products their item is null."""
    items = {field.name: field.dataType for field in windows.schema}["top_5_abandoned_item_ids"]
    latest = F.col("latest")
    return (
        summary.withColumns({"latest": _latest(windows), "top_item": _top_item(top)})
        .select(
            F.col("overall_cart_abandonment_rate").alias("historical_abandonment_rate"),
            latest["estimated_abandonment_rate"].alias("latest_speed_window_abandonment_rate"),
            latest["alert_status"].alias("latest_alert_status"),
            F.col("total_addtocart_events").alias("total_historical_addtocart_events"),
            F.col("total_transactions").alias("total_historical_transactions"),
            F.col("top_item").alias("top_historical_abandoned_item"),
            first_list_item(latest["top_5_abandoned_item_ids"], items).alias(
                "recent_top_abandoned_item"
            ),
        )
    )


def alert_summary(summary: DataFrame, top: DataFrame, windows: DataFrame) -> DataFrame:
    """One row with the end of the latest window, its status and a sentence on both."""
    items = {field.name: field.dataType for field in windows.schema}["top_5_abandoned_item_ids"]
    latest = F.col("latest")
    recent = first_list_item(latest["top_5_abandoned_item_ids"], items)

    def time(name: str):
        return utc_text(latest[name], "yyyy-MM-dd HH:mm:ss")

    historical = F.format_string(
        "Historical abandonment was %.2f%%. ", F.bround("overall_cart_abandonment_rate", 2)
    )
    window = F.format_string(
        "The latest %s to %s window was %.2f%% (%s). ",
        time("window_start"),
        time("window_end"),
        F.bround(latest["estimated_abandonment_rate"], 2),
        latest["alert_status"],
    )
    closing = F.format_string(
        "Top historical abandoned item: %s; recent top abandoned item: %s.",
        F.coalesce(F.col("top_item").cast("string"), F.lit("")),
        F.when(recent == "", F.lit("not available")).otherwise(recent),
    )
    no_window = F.lit("No recent window is available. ")
    return summary.withColumns({"latest": _latest(windows), "top_item": _top_item(top)}).select(
        latest["window_end"].alias("generated_from_window_end"),
        latest["alert_status"].alias("alert_status"),
        F.concat(
            historical, F.when(latest.isNull(), no_window).otherwise(window), closing
        ).alias("report_summary"),
    )

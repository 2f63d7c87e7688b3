from cartspark.functions.expressions import (
    alert_status,
    clean_nan,
    date_of,
    event_time,
    first_list_item,
    hour_of,
    is_one_object,
    json_list,
    pane_ceil,
    pane_floor,
    percent,
    round_half_even,
    to_long,
    utc_text,
    valid_epoch_ms,
)

__all__ = [
    "alert_status",
    "clean_nan",
    "date_of",
    "event_time",
    "first_list_item",
    "hour_of",
    "is_one_object",
    "json_list",
    "pane_ceil",
    "pane_floor",
    "percent",
    "round_half_even",
    "to_long",
    "utc_text",
    "valid_epoch_ms",
]

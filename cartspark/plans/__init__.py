from cartspark.plans.history import counted_parts, read_history, read_sketches, update_history
from cartspark.plans.jobs import (
    archive,
    batch_report,
    history_report,
    profile_report,
    publish,
    scan_report,
    serving_report,
    speed_report,
    stream_estimates,
    stream_publish,
    stream_windows,
)

__all__ = [
    "archive",
    "batch_report",
    "counted_parts",
    "history_report",
    "profile_report",
    "publish",
    "read_history",
    "read_sketches",
    "scan_report",
    "serving_report",
    "speed_report",
    "stream_estimates",
    "stream_publish",
    "stream_windows",
    "update_history",
]

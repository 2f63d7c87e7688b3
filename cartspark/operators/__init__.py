from cartspark.operators.pairs import (
    abandoned_pairs,
    add_pairs,
    hourly_abandonment_trend,
    pair_state,
    top_abandoned_products,
)
from cartspark.operators.profile import event_type_counts, null_profile
from cartspark.operators.ratio import ratio_to_baseline
from cartspark.operators.rollup import (
    ROLLUP_COLUMNS,
    batch_summary,
    history_rollup,
    merge_rollups,
    rollup_event_types,
    rollup_hours,
    rollup_nulls,
    rollup_pairs,
    rollup_summary,
)
from cartspark.operators.serving import alert_summary, serving_view
from cartspark.operators.sketches import approximate_uniques, hourly_sketches, merge_sketches
from cartspark.operators.trends import hourly_event_trend, micro_batch_estimate
from cartspark.operators.windows import (
    cart_groups,
    last_windows,
    latest_window,
    recent_windows,
    sliding_windows,
    windows_from_groups,
    windows_from_panes,
)

__all__ = [
    "ROLLUP_COLUMNS",
    "abandoned_pairs",
    "add_pairs",
    "alert_summary",
    "approximate_uniques",
    "batch_summary",
    "cart_groups",
    "event_type_counts",
    "history_rollup",
    "hourly_abandonment_trend",
    "hourly_event_trend",
    "hourly_sketches",
    "last_windows",
    "latest_window",
    "merge_rollups",
    "merge_sketches",
    "micro_batch_estimate",
    "null_profile",
    "pair_state",
    "ratio_to_baseline",
    "recent_windows",
    "rollup_event_types",
    "rollup_hours",
    "rollup_nulls",
    "rollup_pairs",
    "rollup_summary",
    "serving_view",
    "sliding_windows",
    "top_abandoned_products",
    "windows_from_groups",
    "windows_from_panes",
]

"""The same queries in plain SQL over the ``events`` table, for checking results on another engine.

The SQL is written from the definitions and shares no logic with the Spark plans: windows, for instance, are
made here by copying every event into each of its windows.
"""

from __future__ import annotations

EVENTS = """
ev AS (
  SELECT event_id, epoch_us(ts) // 1000 AS timestamp, user_id AS visitorid,
    CASE event_type WHEN 'click' THEN 'addtocart' WHEN 'purchase' THEN 'transaction' ELSE event_type END AS event,
    CAST(json_extract_string(props, '$.k') AS BIGINT) AS itemid,
    CASE WHEN event_type = 'purchase' THEN event_id END AS transactionid
  FROM events
)"""

PAIRS = f"""{EVENTS},
pairs AS (
  SELECT visitorid, itemid,
    min(CASE WHEN event = 'addtocart' THEN timestamp END) AS first_add_timestamp,
    max(CASE WHEN event = 'addtocart' THEN timestamp END) AS last_add_timestamp,
    max(CASE WHEN event = 'transaction' THEN timestamp END) AS last_transaction_timestamp
  FROM ev WHERE event IN ('addtocart', 'transaction') AND visitorid IS NOT NULL AND itemid IS NOT NULL
  GROUP BY visitorid, itemid
),
added AS (SELECT * FROM pairs WHERE last_add_timestamp IS NOT NULL),
abandoned AS (
  SELECT * FROM added
  WHERE last_transaction_timestamp IS NULL OR last_transaction_timestamp <= last_add_timestamp
)"""

SUMMARY = f"""{PAIRS},
summary AS (
  SELECT count(*) AS total_rows,
    count(*) FILTER (WHERE event = 'view') AS total_views,
    count(*) FILTER (WHERE event = 'addtocart') AS total_addtocart_events,
    count(*) FILTER (WHERE event = 'transaction') AS total_transactions,
    count(DISTINCT visitorid) AS unique_visitors,
    count(DISTINCT itemid) AS unique_items,
    (SELECT count(*) FROM added) AS unique_addtocart_visitor_item_pairs,
    (SELECT count(*) FROM abandoned) AS abandoned_visitor_item_pairs,
    (SELECT CASE WHEN count(*) = 0 THEN 0.0
       ELSE round_even((SELECT count(*) FROM abandoned) / count(*) * 100, 4) END FROM added)
      AS overall_cart_abandonment_rate
  FROM ev
),
top AS (
  SELECT itemid, count(*) AS abandoned_count FROM abandoned
  GROUP BY itemid ORDER BY abandoned_count DESC, itemid LIMIT 10
)"""


def _windows(width: int, base: str = EVENTS, closed_before: str | None = None) -> str:
    """Window rows as CTE ``win``. ``closed_before`` replaces the batch bounds by a stream's closing time."""
    bounds = (
        "s >= (SELECT lo FROM b) AND s + {0} <= (SELECT hi FROM b)".format(width)
        if closed_before is None
        else f"(s + {width}) * 60000 <= {closed_before}"
    )
    return f"""{base},
m AS (SELECT *, timestamp // 60000 AS minute FROM ev WHERE timestamp IS NOT NULL),
b AS (
  SELECT min(minute) AS lo,
    max(CASE WHEN timestamp % 60000 = 0 THEN minute ELSE minute + 1 END) AS hi
  FROM m
),
copied AS (
  SELECT * FROM (SELECT m.*, unnest(range(minute - {width} + 1, minute + 1)) AS s FROM m) WHERE {bounds}
),
counted AS (
  SELECT s, count(*) AS event_count,
    count(*) FILTER (WHERE event = 'addtocart') AS addtocart_count,
    count(*) FILTER (WHERE event = 'transaction') AS transaction_count
  FROM copied GROUP BY s
),
carts AS (
  SELECT s, visitorid, itemid, bool_or(event = 'transaction') AS bought
  FROM copied WHERE event IN ('addtocart', 'transaction')
  GROUP BY s, visitorid, itemid HAVING bool_or(event = 'addtocart')
),
rates AS (
  SELECT s, count(*) FILTER (WHERE NOT bought) AS n_abandoned,
    count(*) FILTER (WHERE NOT bought) / count(*) * 100 AS rate
  FROM carts GROUP BY s
),
items AS (
  SELECT s, itemid, row_number() OVER (PARTITION BY s ORDER BY count(*) DESC, itemid) AS place
  FROM carts WHERE NOT bought AND itemid IS NOT NULL GROUP BY s, itemid
),
tops AS (
  SELECT s, string_agg(CAST(itemid AS VARCHAR), ',' ORDER BY place) AS ids
  FROM items WHERE place <= 5 GROUP BY s
),
win AS (
  SELECT counted.s * 60000 AS window_start, (counted.s + {width}) * 60000 AS window_end,
    event_count, addtocart_count, transaction_count,
    coalesce(n_abandoned, 0) AS estimated_abandoned_count,
    coalesce(round_even(rate, 4), 0.0) AS estimated_abandonment_rate,
    coalesce(ids, '') AS top_5_abandoned_item_ids,
    CASE WHEN rate > 60 THEN 'HIGH_RISK' ELSE 'NORMAL' END AS alert_status
  FROM counted LEFT JOIN rates USING (s) LEFT JOIN tops USING (s)
)"""


SERVING = f"""{_windows(5, SUMMARY)},
latest AS (SELECT * FROM win ORDER BY window_end DESC LIMIT 1),
best AS (SELECT itemid FROM top ORDER BY abandoned_count DESC, itemid LIMIT 1)"""

SERVING_VIEW = f"""WITH {SERVING}
SELECT overall_cart_abandonment_rate AS historical_abandonment_rate,
  estimated_abandonment_rate AS latest_speed_window_abandonment_rate,
  alert_status AS latest_alert_status,
  total_addtocart_events AS total_historical_addtocart_events,
  total_transactions AS total_historical_transactions,
  (SELECT itemid FROM best) AS top_historical_abandoned_item,
  split_part(top_5_abandoned_item_ids, ',', 1) AS recent_top_abandoned_item
FROM summary LEFT JOIN latest ON true"""

# Records of the encoded envelopes: errors, sign-ups and three of every 50 events are sent in a form that cannot be
# decoded. One envelope, with the number -1, is empty.
DECODED = f"""{EVENTS},
reasons AS (
  SELECT *, CASE WHEN event_id % 50 = 7 THEN 'bad base64' WHEN event_id % 50 = 17 THEN 'bad utf-8'
    WHEN event_id % 50 = 27 THEN 'no data' WHEN event = 'error' THEN 'bad json'
    WHEN event = 'signup' THEN 'not an object' END AS failure_reason
  FROM ev
),
decoded AS (
  SELECT event_id // 100 AS envelope_id, failure_reason,
    CASE WHEN failure_reason IS NULL THEN timestamp END AS timestamp,
    CASE WHEN failure_reason IS NULL THEN visitorid END AS visitorid,
    CASE WHEN failure_reason IS NULL THEN event END AS event,
    CASE WHEN failure_reason IS NULL THEN itemid END AS itemid,
    CASE WHEN failure_reason IS NULL THEN transactionid END AS transactionid
  FROM reasons
  UNION ALL SELECT -1, NULL, NULL, NULL, NULL, NULL, NULL
)"""


def _estimate(source: str, by: str, failed: str, there: str = "true") -> str:
    return f"""SELECT {by}, processed_record_count, failed_record_count,
  printf('{{"view":%d,"addtocart":%d,"transaction":%d}}', views, adds, buys) AS event_counts,
  adds AS addtocart_count, buys AS transaction_count,
  greatest(adds - buys, 0) AS estimated_abandoned_count,
  CASE WHEN adds = 0 THEN 0.0 ELSE round_even(greatest(adds - buys, 0) / adds * 100, 2) END
    AS estimated_abandonment_rate,
  CASE WHEN adds > 0 AND greatest(adds - buys, 0) / adds * 100 > 60 THEN 'HIGH_RISK' ELSE 'NORMAL' END
    AS alert_status
FROM (
  SELECT {by}, count(*) FILTER (WHERE NOT ({failed}) AND {there}) AS processed_record_count,
    count(*) FILTER (WHERE {failed}) AS failed_record_count,
    count(*) FILTER (WHERE event = 'view') AS views,
    count(*) FILTER (WHERE event = 'addtocart') AS adds,
    count(*) FILTER (WHERE event = 'transaction') AS buys
  FROM {source} GROUP BY {by}
)"""


EVENT_COLUMNS = "timestamp, visitorid, event, itemid, transactionid"
ALL_EVENTS = f"WITH {EVENTS} SELECT {EVENT_COLUMNS} FROM ev"
BY_COLUMNS = "ORDER BY timestamp NULLS LAST, visitorid NULLS LAST, event NULLS LAST, itemid NULLS LAST, " \
    "transactionid NULLS LAST"

ORACLE_SQL: dict[str, str] = {
    "canonical_events": ALL_EVENTS,
    "read_events": ALL_EVENTS,
    "value_events": ALL_EVENTS,
    "archive_stream": f"""WITH {EVENTS} SELECT {EVENT_COLUMNS},
  strftime(make_timestamp(timestamp * 1000), '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS ingestion_time FROM ev""",
    "event_type_counts": f"WITH {EVENTS} SELECT event, count(*) AS event_count FROM ev GROUP BY event",
    "null_profile": f"WITH {EVENTS} "
    + " UNION ALL ".join(
        f"SELECT '{name}' AS column_name, count(*) - count({name}) AS null_count FROM ev"
        for name in EVENT_COLUMNS.split(", ")
    ),
    "first_events": f"{ALL_EVENTS} {BY_COLUMNS} LIMIT 1000",
    "sample_rows": f"{ALL_EVENTS} {BY_COLUMNS} LIMIT 5",
    "pair_state": f"WITH {PAIRS} SELECT * FROM pairs",
    "add_pairs": f"WITH {PAIRS} SELECT * FROM added",
    "abandoned_pairs": f"WITH {PAIRS} SELECT * FROM abandoned",
    "history_rollup": f"""WITH {EVENTS},
keyed AS (
  SELECT *, timestamp // 3600000 * 3600000 AS hour,
    CASE WHEN event IN ('addtocart', 'transaction') THEN visitorid END AS cart_visitorid,
    CASE WHEN event IN ('addtocart', 'transaction') THEN itemid END AS cart_itemid
  FROM ev
)
SELECT hour, visitorid, itemid, cart_visitorid, cart_itemid,
  CASE WHEN grouping(hour) = 0 THEN 'hour' WHEN grouping(visitorid) = 0 THEN 'visitor'
    WHEN grouping(itemid) = 0 THEN 'item' ELSE 'pair' END AS level,
  count(*) AS event_count,
  count(*) FILTER (WHERE event = 'view') AS view_count,
  count(*) FILTER (WHERE event = 'addtocart') AS addtocart_count,
  count(*) FILTER (WHERE event = 'transaction') AS transaction_count,
  min(timestamp) FILTER (WHERE event = 'addtocart') AS first_add_timestamp,
  max(timestamp) FILTER (WHERE event = 'addtocart') AS last_add_timestamp,
  max(timestamp) FILTER (WHERE event = 'transaction') AS last_transaction_timestamp
FROM keyed
GROUP BY GROUPING SETS ((hour), (visitorid), (itemid), (cart_visitorid, cart_itemid))""",
    "batch_summary": f"WITH {SUMMARY} SELECT * FROM summary",
    "top_abandoned_products": f"WITH {SUMMARY} SELECT * FROM top",
    "hourly_event_trend": f"""WITH {EVENTS}
SELECT timestamp // 3600000 * 3600000 AS hour,
  count(*) FILTER (WHERE event = 'view') AS view_count,
  count(*) FILTER (WHERE event = 'addtocart') AS addtocart_count,
  count(*) FILTER (WHERE event = 'transaction') AS transaction_count,
  count(*) FILTER (WHERE event IN ('view', 'addtocart', 'transaction')) AS total_event_count
FROM ev GROUP BY 1""",
    "hourly_abandonment_trend": f"""WITH {PAIRS}
SELECT first_add_timestamp // 3600000 * 3600000 AS hour, count(*) AS addtocart_pair_count,
  count(abandoned.visitorid) AS abandoned_pair_count,
  count(abandoned.visitorid) / count(*) * 100 AS abandonment_rate
FROM added LEFT JOIN (SELECT visitorid, itemid FROM abandoned) AS abandoned USING (visitorid, itemid)
GROUP BY 1""",
    "sliding_windows_5m": f"WITH {_windows(5)} SELECT * FROM win",
    "sliding_windows_60m": f"WITH {_windows(60)} SELECT * FROM win",
    "recent_windows": f"WITH {_windows(5)} SELECT * FROM win ORDER BY window_end DESC LIMIT 10",
    "latest_window": f"WITH {_windows(5)} SELECT * FROM win ORDER BY window_end DESC LIMIT 1",
    "serving_view": SERVING_VIEW,
    "serving_report": SERVING_VIEW,
    "alert_summary": f"""WITH {SERVING}
SELECT window_end AS generated_from_window_end, alert_status,
  printf('Historical abandonment was %.2f%%. The latest %s to %s window was %.2f%% (%s). '
      || 'Top historical abandoned item: %s; recent top abandoned item: %s.',
    round_even(overall_cart_abandonment_rate, 2),
    strftime(make_timestamp(window_start * 1000), '%Y-%m-%d %H:%M:%S'),
    strftime(make_timestamp(window_end * 1000), '%Y-%m-%d %H:%M:%S'),
    round_even(estimated_abandonment_rate, 2), alert_status,
    (SELECT CAST(itemid AS VARCHAR) FROM best),
    CASE WHEN top_5_abandoned_item_ids = '' THEN 'not available'
      ELSE split_part(top_5_abandoned_item_ids, ',', 1) END) AS report_summary
FROM summary, latest""",
    "keyed_envelope": f"""WITH {EVENTS}
SELECT CAST(visitorid AS VARCHAR) AS key,
  '{{"timestamp":' || timestamp || ',"visitorid":' || visitorid || ',"event":"' || event || '","itemid":'
    || itemid || ',"transactionid":' || coalesce(CAST(transactionid AS VARCHAR), 'null')
    || ',"ingestion_time":"' || strftime(make_timestamp(timestamp * 1000), '%Y-%m-%dT%H:%M:%S.%f')
    || '+00:00"}}' AS value
FROM ev""",
    "decode_envelope": f"WITH {DECODED} SELECT * FROM decoded",
    "micro_batch_estimate": f"WITH {DECODED} "
    + _estimate("decoded", "envelope_id", "failure_reason IS NOT NULL", "envelope_id >= 0"),
    "stream_sliding_windows": "WITH "
    + _windows(5, closed_before="(SELECT max(timestamp) FROM ev) - 600000")
    + " SELECT * FROM win",
    "stream_sliding_windows_60m": "WITH "
    + _windows(60, closed_before="(SELECT max(timestamp) FROM ev) - 600000")
    + " SELECT * FROM win",
    "stream_batch_estimates": f"WITH {EVENTS}, batch AS (SELECT 0::BIGINT AS batch_id, event FROM ev) "
    + _estimate("batch", "batch_id", "false"),
    "ratio_to_baseline": f"""WITH {EVENTS},
hourly AS (
  SELECT itemid, timestamp // 3600000 * 3600000 AS hour, count(*) AS event_count FROM ev GROUP BY 1, 2
)
SELECT itemid, hour, event_count,
  event_count / first_value(event_count) OVER (PARTITION BY itemid ORDER BY hour) AS ratio
FROM hourly""",
}

# The same results by other ways: an archive that grows in steps, and one that is limited or divided by date.
ORACLE_SQL |= {
    "incremental_history": ORACLE_SQL["history_rollup"],
    "incremental_summary": ORACLE_SQL["batch_summary"],
    "limited_archive": ALL_EVENTS,
    "archive_by_date": f"""WITH {EVENTS} SELECT timestamp, visitorid, event, itemid, transactionid FROM ev
WHERE timestamp // 86400000 BETWEEN epoch_ms(TIMESTAMP '2024-01-08') // 86400000 AND epoch_ms(TIMESTAMP '2024-01-14') // 86400000""",
    "approximate_uniques": f"""WITH {EVENTS}
SELECT strftime(make_timestamp(timestamp * 1000), '%Y-%m-%d') AS day, count(*) AS event_count,
  count(DISTINCT visitorid) AS unique_visitors, count(DISTINCT itemid) AS unique_items,
  true AS unique_visitors_within_3_percent, true AS unique_items_within_3_percent
FROM ev WHERE timestamp IS NOT NULL GROUP BY 1""",
}

ORACLE_SQL |= {"profile_event_types": ORACLE_SQL["event_type_counts"], "profile_nulls": ORACLE_SQL["null_profile"]}
KEYED = ORACLE_SQL["keyed_envelope"]
FAULTS = f"""{EVENTS},
faulty AS (
  SELECT *, CASE event_id % 40 WHEN 3 THEN 'itemid is no whole number' WHEN 7 THEN 'missing cells'
    WHEN 9 THEN 'surplus cells' WHEN 11 THEN 'timestamp is no whole number' END AS fault
  FROM ev
)"""
ORACLE_SQL |= {
    "publish_stream": f"SELECT key, value FROM ({KEYED}) WHERE octet_length(encode(value)) <= 149",
    "delivery_tally": f"""SELECT CAST(0 AS BIGINT) AS batch_id, count(*) FILTER (WHERE octet_length(encode(value)) <= 149) AS sent,
  count(*) FILTER (WHERE octet_length(encode(value)) <= 149 AND key IS NULL) AS unkeyed,
  count(*) FILTER (WHERE octet_length(encode(value)) > 149) AS failed FROM ({KEYED})""",
    "fault_counts": f"""WITH {FAULTS}
SELECT fault, count(*) AS row_count FROM faulty WHERE fault IS NOT NULL GROUP BY fault
UNION ALL SELECT NULL, count(*) FROM faulty""",
    "scanned_rows": f"WITH {FAULTS} SELECT event, CAST(visitorid AS VARCHAR) AS visitorid, fault AS faults FROM faulty WHERE fault IS NOT NULL",
}

# A late row is a minute and cart pair, or a minute for all other events.
ORACLE_SQL["stream_late_rows"] = f"""WITH {EVENTS},
bounds AS (SELECT min(timestamp) AS first, max(timestamp) AS last FROM ev),
late AS (
  SELECT DISTINCT timestamp // 60000 AS minute, event IN ('addtocart', 'transaction') AS in_cart,
    CASE WHEN event IN ('addtocart', 'transaction') THEN visitorid END AS v,
    CASE WHEN event IN ('addtocart', 'transaction') THEN itemid END AS i
  FROM ev, bounds WHERE event_id % 10 = 0 AND timestamp < first + (last - first) // 4
)
SELECT CAST(count(*) AS BIGINT) AS late_rows FROM late"""

"""Sliding windows over a stream.

The state is one row per open pane (as long as the slide) and pair that was added or bought in it, plus one row per open
pane for all other events, whatever the width of the windows. When the watermark passes the end of a pane, its rows
leave the state and are stored. The windows that have closed since the last micro-batch are then made from stored panes
with the batch operators.

Each micro-batch runs its stateful plan once. A pointer names the micro-batches whose panes may still be needed and the
last closing times; it does not grow with the age of the stream, and older panes are removed.
"""

from __future__ import annotations

import json
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from cartspark.functions import event_time
from cartspark.functions.expressions import ALERT_THRESHOLD, MINUTE_MS
from cartspark.operators.windows import EVENT_COUNTS, cart_groups, windows_from_panes
from cartspark.session import use_disk_state
from cartspark.sources.versions import names_in, read_pointer, remove_table, write_pointer, write_text
from cartspark.streaming.archive import BATCH

# Parts of the output folder.
PANES, WINDOWS, LATE = "panes", "windows", "late"
KEPT_CLOSINGS = 4
PANE_SCHEMA = "pane bigint, visitorid bigint, itemid bigint, " + ", ".join(f"{name} bigint" for name in EVENT_COUNTS)


def stream_sliding_windows(
    events: DataFrame,
    path: str,
    checkpoint: str,
    width_minutes: int = 5,
    slide_minutes: int = 1,
    watermark: str = "10 minutes",
    threshold: float = ALERT_THRESHOLD,
    *,
    drain: bool = True,
) -> StreamingQuery:
    """Write the rows of every closed window below ``path`` and return the query.

    A window is closed once an event at least ``watermark`` later than its end was seen; events that come
    later than that are in no window and are counted, see ``read_late_rows``. A stream has no first or last event,
    so windows that began before the first event are included. With ``drain`` the input is used up, and all windows
    that it closes are written, when the function returns; a running query writes a window one micro-batch after the
    one that closed it.
    """
    spark, pane_ms, path = events.sparkSession, slide_minutes * MINUTE_MS, path.rstrip("/")
    timed = (
        events.withColumn("event_time", event_time(F.col("timestamp")))
        .filter(F.col("event_time").isNotNull())
        .withWatermark("event_time", watermark)
    )
    groups = cart_groups(timed, slide_minutes, slide_minutes).select(
        F.floor(F.unix_millis("window.start") / pane_ms).alias("pane"), "visitorid", "itemid", *EVENT_COUNTS
    )
    running: list[StreamingQuery] = []
    noted: set[int] = set()

    def write_closed(closed: DataFrame, batch_id: int) -> None:
        _write_panes(closed, path, batch_id)
        if running:
            _write_late(spark, running[0], path, noted)
            _write_windows(closed.sparkSession, path, batch_id, "batch", _watermark(running[0]), width_minutes, pane_ms, threshold)

    use_disk_state(spark)
    writer = groups.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    if not drain:
        query = writer.foreachBatch(write_closed).start()
        running.append(query)
        return query
    query = writer.trigger(availableNow=True).foreachBatch(write_closed).start()
    query.awaitTermination()
    _write_late(spark, query, path, noted)
    last = query.lastProgress
    if last is not None:
        _write_windows(spark, path, last["batchId"], "end", _watermark(query), width_minutes, pane_ms, threshold)
    return query


def _watermark(query: StreamingQuery) -> int | None:
    """Epoch milliseconds up to which the query has closed its panes."""
    last = query.lastProgress
    text = (last["eventTime"] or {}).get("watermark") if last is not None else None
    if text is None:
        return None
    moment = datetime.fromisoformat(text.replace("Z", "+00:00")).astimezone(timezone.utc)
    return int(moment.timestamp() * 1000)


def _state(spark: SparkSession, path: str) -> tuple[int, dict]:
    """Which micro-batches stored panes that windows may still need, and the last few closing times."""
    return read_pointer(spark, path) or (0, {"panes": [], "closed": []})


def _write_panes(closed: DataFrame, path: str, batch_id: int) -> None:
    """Store what left the state, in one run of the micro-batch's plan; a rerun replaces it."""
    spark, folder, tally = closed.sparkSession, f"{path}/{PANES}/{BATCH}={batch_id}", Observation()
    seen = closed.observe(tally, F.min("pane").alias("low"), F.max("pane").alias("high"))
    seen.write.mode("overwrite").parquet(folder)
    found = tally.get
    if found["low"] is None:
        remove_table(spark, folder)
        return
    number, state = _state(spark, path)
    panes = [p for p in state["panes"] if p["batch"] != batch_id]
    panes.append({"batch": batch_id, "low": found["low"], "high": found["high"]})
    write_pointer(spark, path, number + 1, {**state, "panes": panes})


def _write_windows(
    spark: SparkSession, path: str, batch_id: int, step: str, watermark: int | None, width_minutes: int, pane_ms: int, threshold: float
) -> None:
    """Write the windows that ended after the last closing time and by this one, and drop panes that no window needs.

    The last closing times are kept: a rerun of a micro-batch goes by those of earlier ones.
    """
    number, state = _state(spark, path)
    if watermark is None or not state["panes"]:
        return
    earlier = [c for c in state["closed"] if (c["batch"], c["step"]) < (batch_id, step)]
    before, now = max((c["pane"] for c in earlier), default=None), watermark // pane_ms
    if before is not None and now <= before:
        return
    span = width_minutes * MINUTE_MS // pane_ms
    first = (min(p["low"] for p in state["panes"]) if before is None else before) - span + 1
    needed = [p for p in state["panes"] if p["high"] >= first]
    folders = [f"{path}/{PANES}/{BATCH}={p['batch']}" for p in needed]
    stored = spark.read.schema(PANE_SCHEMA).parquet(*folders) if folders else spark.createDataFrame([], PANE_SCHEMA)
    part = stored.filter((F.col("pane") >= first) & (F.col("pane") < now))
    rows = windows_from_panes(part, (first, now), width_minutes, pane_ms // MINUTE_MS, threshold)
    rows.write.mode("overwrite").parquet(f"{path}/{WINDOWS}/{BATCH}={batch_id}/step={step}")
    closed = [*earlier, {"batch": batch_id, "step": step, "pane": now}][-KEPT_CLOSINGS:]
    write_pointer(spark, path, number + 1, {"panes": needed, "closed": closed})
    for old in state["panes"]:
        if old not in needed:
            remove_table(spark, f"{path}/{PANES}/{BATCH}={old['batch']}")


def _write_late(spark: SparkSession, query: StreamingQuery, path: str, noted: set[int]) -> None:
    """Note the micro-batches that met rows behind the watermark; each note is one small file, written once."""
    for progress in query.recentProgress:
        late = sum(operator["numRowsDroppedByWatermark"] for operator in progress["stateOperators"])
        if late and progress["batchId"] not in noted:
            text = json.dumps({"watermark": (progress["eventTime"] or {}).get("watermark"), "late_rows": late})
            write_text(spark, f"{path}/{LATE}/{BATCH}={progress['batchId']}/late.json", text)
            noted.add(progress["batchId"])


def read_late_rows(spark: SparkSession, path: str) -> DataFrame:
    """batch_id, watermark and late_rows of every micro-batch that dropped something.

    A row is a pane and cart pair (or a pane, for other events) of which late events came in that micro-batch: late
    events are counted as the state would have held them. Counts follow from the progress of the running query, so those
    of a micro-batch right before a crash can be missing.
    """
    fields = "watermark timestamp, late_rows bigint, batch_id bigint"
    if not names_in(spark, f"{path.rstrip('/')}/{LATE}"):
        return spark.createDataFrame([], fields).select(BATCH, "watermark", "late_rows")
    return spark.read.schema(fields).json(f"{path.rstrip('/')}/{LATE}").select(BATCH, "watermark", "late_rows")


def read_stream_windows(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/{WINDOWS}").drop(BATCH, "step")

"""The jobs a user runs: profile, batch, speed, serving, publish and archive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartspark import operators as ops
from cartspark.functions.expressions import ALERT_THRESHOLD
from cartspark.plans.history import read_history
from cartspark.session import scratch_path
from cartspark.sources import (
    EVENT_SCHEMA,
    fault_counts,
    first_events,
    read_result,
    rejected_rows,
    remove_table,
    require_columns,
    sample_rows,
    scan_rows,
    write_result,
    write_table,
)
from cartspark.streaming import (
    archive_first_records,
    archive_records,
    decode_values,
    keyed_envelope,
    publish_stream,
    read_estimates,
    read_stream_windows,
    read_tally,
    record_values,
    stamp_ingestion,
    stream_batch_estimates,
    stream_events,
    stream_sliding_windows,
)

# Result tables.
SUMMARY = "batch_summary"
TOP_PRODUCTS = "top_abandoned_products"
HOURLY_EVENTS = "hourly_event_trend"
HOURLY_ABANDONMENT = "hourly_abandonment_trend"
WINDOWS = "speed_window_results"
SERVING = "serving_view"
ALERT = "final_alert_summary"

SUMMARY_SCHEMA = (
    "total_rows BIGINT, total_views BIGINT, total_addtocart_events BIGINT, total_transactions BIGINT, "
    "unique_visitors BIGINT, unique_items BIGINT, unique_addtocart_visitor_item_pairs BIGINT, "
    "abandoned_visitor_item_pairs BIGINT, overall_cart_abandonment_rate DOUBLE"
)
TOP_SCHEMA = "itemid BIGINT, abandoned_count BIGINT"
HOURLY_EVENTS_SCHEMA = (
    "hour TIMESTAMP, view_count BIGINT, addtocart_count BIGINT, transaction_count BIGINT, "
    "total_event_count BIGINT"
)
HOURLY_ABANDONMENT_SCHEMA = (
    "hour TIMESTAMP, addtocart_pair_count BIGINT, abandoned_pair_count BIGINT, abandonment_rate DOUBLE"
)
WINDOW_SCHEMA = (
    "window_start TIMESTAMP, window_end TIMESTAMP, event_count BIGINT, addtocart_count BIGINT, "
    "transaction_count BIGINT, estimated_abandoned_count BIGINT, estimated_abandonment_rate DOUBLE, "
    "top_5_abandoned_item_ids {items}, alert_status STRING"
)


def scan_report(spark: SparkSession, path: str, fmt: str) -> dict[str, DataFrame]:
    """What a scan of text files can not read: rows per fault and all rows, and some of the rows. Nothing runs yet."""
    rows = scan_rows(spark, path, fmt)
    return {"fault_counts": fault_counts(rows), "rejected_rows": sample_rows(rejected_rows(spark, path, fmt))}


def profile_report(events: DataFrame) -> dict[str, DataFrame]:
    """Data check: sample, event counts, missing values, summary and top products.

    All but the sample come from one scan and one shuffle of the events, into a rollup in the shared folder; the sample
    is a scan of its own, which keeps five rows a task.
    """
    require_columns(events, EVENT_SCHEMA.names)
    spark = events.sparkSession
    rolled = ops.history_rollup(events, ("visitor", "item", "pair"), profile=True)
    stored = write_table(rolled, scratch_path(spark, "profile"), partition_by=("level",))
    rollup = spark.read.schema(rolled.schema).parquet(stored)
    return {
        "sample_rows": sample_rows(events),
        "event_type_counts": ops.rollup_event_types(rollup),
        "null_profile": ops.rollup_nulls(rollup),
        SUMMARY: ops.rollup_summary(rollup),
        TOP_PRODUCTS: ops.top_abandoned_products(ops.rollup_pairs(rollup)),
    }


def batch_report(
    spark: SparkSession,
    events: DataFrame,
    output: str,
    fmt: str = "parquet",
    scale: int | None = 4,
) -> dict[str, DataFrame]:
    """Write the summary, top products and both hourly trends; return the tables as written.

    The history is scanned and shuffled once, into a rollup below the output that is removed when the job is done, and
    the four results are read off it. An executor lost later costs a part of the rollup's readers, not the scan.
    """
    return rollup_report(spark, ops.history_rollup(events), output, fmt, scale)


def history_report(
    spark: SparkSession, history: str, output: str, fmt: str = "parquet", scale: int | None = 4
) -> dict[str, DataFrame]:
    """The tables of ``batch_report``, from the stored history of an archive; no event is read."""
    return rollup_report(spark, read_history(spark, history), output, fmt, scale)


def rollup_report(
    spark: SparkSession, rollup: DataFrame, output: str, fmt: str, scale: int | None
) -> dict[str, DataFrame]:
    stored = write_table(rollup, f"{output.rstrip('/')}/_rollup", partition_by=("level",))
    rollup = spark.read.schema(rollup.schema).parquet(stored)
    pairs = ops.rollup_pairs(rollup)
    write_result(ops.rollup_summary(rollup, scale), output, SUMMARY, fmt, tiny=True)
    write_result(ops.top_abandoned_products(pairs), output, TOP_PRODUCTS, fmt, tiny=True)
    write_result(ops.rollup_hours(rollup).orderBy("hour"), output, HOURLY_EVENTS, fmt)
    write_result(
        ops.hourly_abandonment_trend(pairs).orderBy("hour"), output, HOURLY_ABANDONMENT, fmt
    )
    remove_table(spark, stored)
    schemas = {
        SUMMARY: SUMMARY_SCHEMA,
        TOP_PRODUCTS: TOP_SCHEMA,
        HOURLY_EVENTS: HOURLY_EVENTS_SCHEMA,
        HOURLY_ABANDONMENT: HOURLY_ABANDONMENT_SCHEMA,
    }
    return {name: read_result(spark, output, name, fmt, schema) for name, schema in schemas.items()}


def speed_report(
    spark: SparkSession,
    events: DataFrame,
    output: str,
    fmt: str = "parquet",
    width_minutes: int = 5,
    limit: int | None = None,
    threshold: float = ALERT_THRESHOLD,
) -> DataFrame:
    """Write the sliding windows over the events, or over the first ``limit`` of them."""
    stored = None
    if limit is not None:
        # Used three times below, found once.
        stored = write_table(first_events(events, limit), f"{output.rstrip('/')}/_events")
        events = spark.read.schema(EVENT_SCHEMA).parquet(stored)
    windows = ops.sliding_windows(events, width_minutes, threshold=threshold)
    write_result(windows.orderBy("window_end"), output, WINDOWS, fmt)
    if stored is not None:
        remove_table(spark, stored)
    return read_windows(spark, output, fmt)


def read_windows(spark: SparkSession, output: str, fmt: str = "parquet") -> DataFrame:
    items = "STRING" if fmt == "csv" else "ARRAY<STRING>"
    return read_result(spark, output, WINDOWS, fmt, WINDOW_SCHEMA.format(items=items))


def serving_report(
    spark: SparkSession, results: str, fmt: str = "parquet"
) -> tuple[DataFrame, DataFrame]:
    """Merge the batch and speed results in ``results`` into the serving view and the alert summary."""
    summary = read_result(spark, results, SUMMARY, fmt, SUMMARY_SCHEMA)
    top = read_result(spark, results, TOP_PRODUCTS, fmt, TOP_SCHEMA)
    windows = read_windows(spark, results, fmt)
    view = ops.serving_view(summary, top, windows)
    alert = ops.alert_summary(summary, top, windows)
    write_result(view, results, SERVING, fmt, tiny=True)
    write_result(alert, results, ALERT, fmt, tiny=True)
    return (
        read_result(spark, results, SERVING, fmt, view.schema),
        read_result(spark, results, ALERT, fmt, alert.schema),
    )


def publish(events: DataFrame, limit: int | None = None) -> DataFrame:
    """The events as stamped, keyed JSON records, for any batch or streaming sink that takes key and value."""
    if limit is not None:
        events = first_events(events, limit)
    return keyed_envelope(stamp_ingestion(events))


def stream_publish(
    spark: SparkSession,
    source: str,
    output: str,
    checkpoint: str,
    fmt: str = "json",
    largest: int | None = None,
    max_files: int | None = None,
) -> DataFrame:
    """Drain a folder of event files into keyed JSON; returns the tally of all micro-batches so far."""
    events = stream_events(spark, source, fmt, max_files)
    publish_stream(events, output, checkpoint, largest=largest).awaitTermination()
    return read_tally(spark, output)


def archive(
    spark: SparkSession,
    source: str,
    output: str,
    checkpoint: str | None = None,
    fmt: str = "json",
    limit: int | None = None,
    max_files: int | None = None,
    *,
    by_date: bool = False,
) -> tuple[int, int]:
    """Drain a folder of record files into an archive; returns how many records were archived and rejected.

    With a checkpoint a run adds what is new since the last one, or at most ``limit`` records of it; what it read beyond
    the limit waits for the next run. Without one the archive is replaced by the first ``limit`` records.
    """
    if limit is not None and max_files is None:
        # Small micro-batches, so that a small limit reads little.
        max_files = 1
    values = record_values(spark, source, fmt, max_files)
    if checkpoint is not None:
        return archive_records(values, output, checkpoint, limit, by_date=by_date)
    if limit is None:
        raise ValueError("name a checkpoint, so that a later run goes on where this one ends")
    if by_date:
        raise ValueError("an archive by date needs a checkpoint")
    return archive_first_records(spark, values, output, limit)


def stream_windows(
    spark: SparkSession,
    source: str,
    output: str,
    checkpoint: str,
    fmt: str = "json",
    width_minutes: int = 5,
    max_files: int | None = None,
) -> DataFrame:
    """Drain a folder of event files into the windows that are closed; returns all windows so far."""
    events = stream_events(spark, source, fmt, max_files)
    stream_sliding_windows(events, output, checkpoint, width_minutes).awaitTermination()
    return read_stream_windows(spark, output)


def stream_estimates(
    spark: SparkSession,
    source: str,
    output: str,
    checkpoint: str,
    fmt: str = "json",
    dead_letters: str | None = None,
    max_files: int | None = None,
) -> DataFrame:
    """Drain a folder of record files into one estimate per micro-batch; returns all estimates so far."""
    records = decode_values(record_values(spark, source, fmt, max_files))
    stream_batch_estimates(records, output, checkpoint, dead_letters=dead_letters).awaitTermination()
    return read_estimates(spark, output)


def epoch_columns(df: DataFrame) -> DataFrame:
    """Timestamps as epoch milliseconds, for comparing results across engines and time zones."""
    return df.select(
        *(
            F.unix_millis(name).alias(name) if kind == "timestamp" else F.col(name)
            for name, kind in df.dtypes
        )
    )

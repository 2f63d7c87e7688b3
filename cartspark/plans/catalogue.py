"""Every query of the engine over the event log of a data folder. Times come out as epoch milliseconds."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartspark import operators as ops
from cartspark import plans
from cartspark import streaming as st
from cartspark.functions import event_time, hour_of
from cartspark.plans.jobs import epoch_columns
from cartspark.session import scratch_path
from cartspark.sources import (
    CART_EVENTS,
    EVENT_SCHEMA,
    LOG_SCHEMA,
    canonical_events,
    first_events,
    read_events,
    sample_rows,
    scan_rows,
    write_table,
)
from cartspark.sources import fault_counts as fault_tally

ENVELOPE_RECORDS = 100
LARGEST = 149
LINE_FILES = 8
WEEK = ("2024-01-08", "2024-01-14")


def event_log(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(LOG_SCHEMA).parquet(f"{folder}/events.parquet")


def events(spark: SparkSession, folder: str) -> DataFrame:
    return canonical_events(event_log(spark, folder))


def cart_events(
    spark: SparkSession, folder: str, between: tuple[int, int] | None = None
) -> DataFrame:
    return canonical_events(event_log(spark, folder), only=CART_EVENTS, between=between)


def event_stream(spark: SparkSession, folder: str) -> DataFrame:
    # Written as a pattern, because a stream takes a folder or a pattern but not the name of a single file.
    path = f"{folder}/{{events.parquet}}"
    return canonical_events(st.stream_events(spark, path, "parquet", schema=LOG_SCHEMA))


def pairs(spark: SparkSession, folder: str) -> DataFrame:
    return ops.pair_state(cart_events(spark, folder))


def windows(spark: SparkSession, folder: str, width_minutes: int = 5) -> DataFrame:
    return ops.sliding_windows(
        events(spark, folder), width_minutes, cart_events=cart_events(spark, folder)
    )


def last_windows(spark: SparkSession, folder: str, n: int) -> DataFrame:
    def between(low: int, high: int) -> tuple[DataFrame, DataFrame]:
        log = event_log(spark, folder)
        return canonical_events(log, between=(low, high)), cart_events(spark, folder, (low, high))

    return ops.last_windows(events(spark, folder), n, between=between)


def flat(df: DataFrame) -> DataFrame:
    """Epoch milliseconds for timestamps, joined text for the item list and JSON text for the counts."""
    out = epoch_columns(df)
    if "top_5_abandoned_item_ids" in out.columns:
        out = out.withColumn(
            "top_5_abandoned_item_ids", F.concat_ws(",", "top_5_abandoned_item_ids")
        )
    if "event_counts" in out.columns:
        out = out.withColumn("event_counts", F.to_json("event_counts"))
    return out


def envelopes(spark: SparkSession, folder: str) -> DataFrame:
    """The events as encoded envelopes of 100 records, and one without any.

    Errors arrive as plain text and sign-ups as a JSON list; of every 50 events one is cut off, one is no UTF-8 and one
    has no data.
    """
    rows = canonical_events(event_log(spark, folder), keep=("event_id",))
    record = F.to_json(F.struct(*EVENT_SCHEMA.names), {"ignoreNullFields": "false"})
    sent = (
        F.when(F.col("event") == "error", F.lit("error"))
        .when(F.col("event") == "signup", F.lit("[1]"))
        .otherwise(record)
    )
    nth = F.col("event_id") % 50
    data = (
        F.when(nth == 7, F.lit("A"))
        .when(nth == 17, F.base64(F.unhex(F.lit("FFFE"))))
        .when(nth != 27, F.base64(F.encode(sent, "utf-8")))
    )
    filled = rows.groupBy(F.floor(F.col("event_id") / ENVELOPE_RECORDS).alias("envelope_id")).agg(
        F.collect_list(F.struct(F.struct(data.alias("data")).alias("kinesis"))).alias("Records")
    )
    return filled.unionByName(spark.createDataFrame([(-1, [])], filled.schema))


def serving_inputs(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Summary and top products from one stored rollup, and the latest window alone."""
    path = write_table(ops.history_rollup(events(spark, folder)), scratch_path(spark, "rollup"), partition_by=("level",))
    rollup = spark.read.parquet(path)
    return (
        ops.rollup_summary(rollup),
        ops.top_abandoned_products(ops.rollup_pairs(rollup)),
        last_windows(spark, folder, 1),
    )


def serving_view(spark: SparkSession, folder: str) -> DataFrame:
    return ops.serving_view(*serving_inputs(spark, folder))


def alert_summary(spark: SparkSession, folder: str) -> DataFrame:
    return flat(ops.alert_summary(*serving_inputs(spark, folder)))


def serving_report(spark: SparkSession, folder: str) -> DataFrame:
    """Batch job, speed job and serving job one after the other, through their stored results."""
    results = scratch_path(spark, "results")
    plans.batch_report(spark, events(spark, folder), results)
    plans.speed_report(spark, events(spark, folder), results)
    view, _ = plans.serving_report(spark, results)
    return view


def read_back_events(spark: SparkSession, folder: str) -> DataFrame:
    base = scratch_path(spark, "csv")
    return read_events(spark, write_table(events(spark, folder), f"{base}/events", "csv"), "csv")


def keyed_envelope(spark: SparkSession, folder: str) -> DataFrame:
    rows = events(spark, folder)
    return st.keyed_envelope(st.stamp_ingestion(rows, at=event_time(F.col("timestamp"))))


def value_events(spark: SparkSession, folder: str) -> DataFrame:
    """From published values back to events."""
    return st.good_events(st.decode_values(keyed_envelope(spark, folder)))


def decode_envelope(spark: SparkSession, folder: str) -> DataFrame:
    decoded = st.decode_envelope(envelopes(spark, folder), keep=("envelope_id",))
    return decoded.drop("data", "record_number")


def micro_batch_estimate(spark: SparkSession, folder: str) -> DataFrame:
    decoded = st.decode_envelope(envelopes(spark, folder), keep=("envelope_id",))
    return flat(ops.micro_batch_estimate(decoded, by=("envelope_id",)))


def archive_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The published records, archived as they came and read back with the field that the event table lacks."""
    base = scratch_path(spark, "archive")
    keyed_envelope(spark, folder).select("value").write.text(f"{base}/landing")
    plans.archive(spark, f"{base}/landing", f"{base}/archive", f"{base}/checkpoint")
    schema = T.StructType([*EVENT_SCHEMA.fields, T.StructField("ingestion_time", T.StringType())])
    return spark.read.schema(schema).json(f"{base}/archive/{st.RECORDS}").select(*schema.names)


def landed(spark: SparkSession, folder: str, base: str, steps: int) -> list[DataFrame]:
    """The published records in as many groups as there are steps; events of one cart fall into several of them."""
    rows = keyed_envelope(spark, folder).select("value")
    return [rows.filter(F.pmod(F.xxhash64("value"), F.lit(steps)) == step) for step in range(steps)]


def archived_history(spark: SparkSession, folder: str, steps: int = 3) -> str:
    """Archive the records in steps and count each into a history; the last step is counted twice, to no effect."""
    base = scratch_path(spark, "history")
    for records in landed(spark, folder, base, steps):
        records.write.mode("append").text(f"{base}/landing")
        plans.archive(spark, f"{base}/landing", f"{base}/archive", f"{base}/checkpoint")
        plans.update_history(spark, f"{base}/archive", f"{base}/history")
    plans.update_history(spark, f"{base}/archive", f"{base}/history")
    return f"{base}/history"


def incremental_history(spark: SparkSession, folder: str) -> DataFrame:
    return flat(plans.read_history(spark, archived_history(spark, folder)))


def incremental_summary(spark: SparkSession, folder: str) -> DataFrame:
    """More steps than the history keeps parts, so that parts are merged, and the report from what is stored."""
    history = archived_history(spark, folder, 5)
    return plans.history_report(spark, history, scratch_path(spark, "results"))["batch_summary"]


def limited_archive(spark: SparkSession, folder: str) -> DataFrame:
    """Archive 100 records, then 3, then all that is left; read back as events."""
    base = scratch_path(spark, "limited")
    keyed_envelope(spark, folder).select("value").repartition(4).write.text(f"{base}/landing")
    for limit in (100, 3, None):
        plans.archive(spark, f"{base}/landing", f"{base}/archive", f"{base}/checkpoint", limit=limit)
    return st.read_archive(spark, f"{base}/archive")


def archive_by_date(spark: SparkSession, folder: str) -> DataFrame:
    """The events of a week, from an archive in which every date has its folder."""
    base = scratch_path(spark, "dated")
    keyed_envelope(spark, folder).select("value").write.text(f"{base}/landing")
    plans.archive(spark, f"{base}/landing", f"{base}/archive", f"{base}/checkpoint", by_date=True)
    return st.read_archive(spark, f"{base}/archive", dates=WEEK)


def publish_stream(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """The events sent as a stream, each stamped with its own time, and the tally; the longest records are refused."""
    base = scratch_path(spark, "published")
    st.publish_stream(
        event_stream(spark, folder), base, f"{base}/checkpoint", largest=LARGEST, at=event_time(F.col("timestamp"))
    ).awaitTermination()
    return st.read_sent(spark, base), st.read_tally(spark, base)


def faulty_lines(spark: SparkSession, folder: str) -> str:
    """The events as lines of CSV, some with a cell too few or too many, or with text where a number belongs."""
    rows = canonical_events(event_log(spark, folder), keep=("event_id",))
    nth = F.col("event_id") % 40
    cells = [F.coalesce(F.col(name).cast("string"), F.lit("")) for name in EVENT_SCHEMA.names]
    item = F.when(nth == 3, F.lit("new")).when(nth == 5, F.concat(F.lit('"'), cells[3], F.lit('.0"'))).otherwise(cells[3])
    line = F.concat_ws(",", *cells[:3], item)
    line = F.when(nth == 7, line).when(nth == 9, F.concat(line, F.lit(",,,"))).otherwise(F.concat(line, F.lit(","), cells[4]))
    line = F.when(nth == 11, F.regexp_replace(line, "^[0-9]*", "soon")).otherwise(line)
    # Every file of a CSV folder begins with the header.
    lines = rows.select((F.col("event_id") % LINE_FILES).alias("file"), F.lit(False).alias("head"), line.alias("value"))
    heads = spark.range(LINE_FILES).select(
        F.col("id").alias("file"), F.lit(True).alias("head"), F.lit(",".join(EVENT_SCHEMA.names)).alias("value")
    )
    path = scratch_path(spark, "lines")
    placed = lines.unionByName(heads).repartition("file").sortWithinPartitions("file", F.desc("head"))
    placed.select("file", "value").write.partitionBy("file").text(path)
    return f"{path}/file=*"


def profile_table(name: str) -> Callable[[SparkSession, str], DataFrame]:
    """A table of the data check, as its job makes it."""
    return lambda spark, folder: plans.profile_report(events(spark, folder))[name]


def fault_counts(spark: SparkSession, folder: str) -> DataFrame:
    return fault_tally(scan_rows(spark, faulty_lines(spark, folder)))


def scanned_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The rows of the faulty lines as events, next to the list of their faults."""
    rows = scan_rows(spark, faulty_lines(spark, folder))
    return rows.filter(F.size("faults") > 0).select("event", "visitorid", F.concat_ws("; ", "faults").alias("faults"))


def approximate_uniques(spark: SparkSession, folder: str) -> DataFrame:
    """For each day: events and items and visitors, exactly and whether the stored sketches are within 3 % of that."""
    table = events(spark, folder).filter(event_time(F.col("timestamp")).isNotNull())
    path = write_table(ops.hourly_sketches(table), scratch_path(spark, "sketches"))
    near = ops.approximate_uniques(spark.read.parquet(path), {"day": F.to_date("hour")})
    exact = table.groupBy(F.to_date(event_time(F.col("timestamp"))).alias("day")).agg(
        F.count_distinct("visitorid").alias("unique_visitors"), F.count_distinct("itemid").alias("unique_items")
    )

    def within(name: str) -> Column:
        return (F.abs(F.col(f"approx_{name}") - F.col(name)) <= F.col(name) * 0.03).alias(f"{name}_within_3_percent")

    return exact.join(near, "day").select(
        F.date_format("day", "yyyy-MM-dd").alias("day"), "event_count", "unique_visitors", "unique_items",
        within("unique_visitors"), within("unique_items"),
    )


def stream_sliding_windows(spark: SparkSession, folder: str, width_minutes: int = 5) -> DataFrame:
    base = scratch_path(spark, "windows")
    stream = event_stream(spark, folder)
    st.stream_sliding_windows(
        stream, f"{base}/data", f"{base}/checkpoint", width_minutes
    ).awaitTermination()
    return flat(st.read_stream_windows(spark, f"{base}/data"))


def stream_late_rows(spark: SparkSession, folder: str) -> DataFrame:
    """All events in two runs of a stream, then a tenth of the first quarter once more, behind the watermark."""
    base, rows = scratch_path(spark, "late"), canonical_events(event_log(spark, folder), keep=("event_id",))
    first, last = rows.agg(F.min("timestamp"), F.max("timestamp")).first()
    early = F.col("timestamp") < first + (last - first) // 2
    again = (F.col("timestamp") < first + (last - first) // 4) & (F.col("event_id") % 10 == 0)
    for part in (rows.filter(early), rows.filter(~early), rows.filter(again)):
        part.select(*EVENT_SCHEMA.names).write.mode("append").parquet(f"{base}/landing")
        stream = st.stream_events(spark, f"{base}/landing", "parquet")
        st.stream_sliding_windows(stream, f"{base}/data", f"{base}/checkpoint").awaitTermination()
    return st.read_late_rows(spark, f"{base}/data").agg(F.sum("late_rows").alias("late_rows"))


def stream_batch_estimates(spark: SparkSession, folder: str) -> DataFrame:
    base = scratch_path(spark, "estimates")
    stream = event_stream(spark, folder)
    st.stream_batch_estimates(stream, f"{base}/data", f"{base}/checkpoint").awaitTermination()
    return flat(st.read_estimates(spark, f"{base}/data"))


def ratio_to_baseline(spark: SparkSession, folder: str) -> DataFrame:
    """Hourly events of each item, relative to its first hour."""
    hourly = (
        events(spark, folder)
        .groupBy("itemid", hour_of(F.col("timestamp")).alias("hour"))
        .agg(F.count(F.lit(1)).alias("event_count"))
    )
    return flat(ops.ratio_to_baseline(hourly, "event_count", "hour", by=("itemid",)))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "canonical_events": events,
    "read_events": read_back_events,
    "event_type_counts": lambda s, d: ops.event_type_counts(events(s, d)),
    "null_profile": lambda s, d: ops.null_profile(events(s, d)),
    "first_events": lambda s, d: first_events(events(s, d), 1000),
    "sample_rows": lambda s, d: sample_rows(events(s, d)),
    "pair_state": pairs,
    "add_pairs": lambda s, d: ops.add_pairs(pairs(s, d)),
    "abandoned_pairs": lambda s, d: ops.abandoned_pairs(pairs(s, d)),
    "history_rollup": lambda s, d: flat(ops.history_rollup(events(s, d))),
    "batch_summary": lambda s, d: ops.batch_summary(events(s, d)),
    "top_abandoned_products": lambda s, d: ops.top_abandoned_products(pairs(s, d)),
    "hourly_event_trend": lambda s, d: flat(ops.hourly_event_trend(events(s, d))),
    "hourly_abandonment_trend": lambda s, d: flat(ops.hourly_abandonment_trend(pairs(s, d))),
    "sliding_windows_5m": lambda s, d: flat(windows(s, d, 5)),
    "sliding_windows_60m": lambda s, d: flat(windows(s, d, 60)),
    "recent_windows": lambda s, d: flat(last_windows(s, d, 10)),
    "latest_window": lambda s, d: flat(last_windows(s, d, 1)),
    "serving_view": serving_view,
    "alert_summary": alert_summary,
    "serving_report": serving_report,
    "keyed_envelope": keyed_envelope,
    "value_events": value_events,
    "decode_envelope": decode_envelope,
    "micro_batch_estimate": micro_batch_estimate,
    "archive_stream": archive_stream,
    "limited_archive": limited_archive,
    "archive_by_date": archive_by_date,
    "incremental_history": incremental_history,
    "incremental_summary": incremental_summary,
    "approximate_uniques": approximate_uniques,
    "publish_stream": lambda s, d: publish_stream(s, d)[0],
    "delivery_tally": lambda s, d: publish_stream(s, d)[1],
    "fault_counts": fault_counts,
    "profile_event_types": profile_table("event_type_counts"),
    "profile_nulls": profile_table("null_profile"),
    "scanned_rows": scanned_rows,
    "stream_sliding_windows": stream_sliding_windows,
    "stream_sliding_windows_60m": lambda s, d: stream_sliding_windows(s, d, 60),
    "stream_late_rows": stream_late_rows,
    "stream_batch_estimates": stream_batch_estimates,
    "ratio_to_baseline": ratio_to_baseline,
}

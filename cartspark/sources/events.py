"""The event table: its schema, its readers, and ordered prefixes of it."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartspark.functions import pane_floor, to_long
from cartspark.functions.expressions import MINUTE_MS

# Fixed values.
VIEW = "view"
ADD_TO_CART = "addtocart"
PURCHASE = "transaction"
EVENT_TYPES = (VIEW, ADD_TO_CART, PURCHASE)
CART_EVENTS = (ADD_TO_CART, PURCHASE)
REQUIRED_COLUMNS = ("timestamp", "visitorid", "event", "itemid")

EVENT_SCHEMA = T.StructType(
    [
        T.StructField("timestamp", T.LongType()),
        T.StructField("visitorid", T.LongType()),
        T.StructField("event", T.StringType()),
        T.StructField("itemid", T.LongType()),
        T.StructField("transactionid", T.LongType()),
    ]
)
# Text files are read as strings by name and cast afterwards: a bad number then costs one cell, not its row.
TEXT_SCHEMA = T.StructType([T.StructField(f.name, T.StringType()) for f in EVENT_SCHEMA])

# The event log, a table of user actions of many kinds that carts can be read from.
LOG_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)
# Event names of the event log and what they mean for a cart; names not listed stay as they are.
EVENT_LOG_NAMES = {"click": ADD_TO_CART, "purchase": PURCHASE}


def require_columns(df: DataFrame, names: Iterable[str] = REQUIRED_COLUMNS) -> DataFrame:
    missing = sorted(set(names).difference(df.columns))
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df


def conform_events(df: DataFrame) -> DataFrame:
    """Cast a frame with the event columns to the declared types; ``transactionid`` may be absent."""
    require_columns(df)
    types = {field.name: field.dataType for field in df.schema}

    def cell(name: str) -> Column:
        if name not in types:
            return F.lit(None).cast("bigint")
        if name == "event":
            return F.col(name).cast("string")
        if isinstance(types[name], T.TimestampType | T.TimestampNTZType):
            return _utc_millis(df, name)
        return to_long(F.col(name), types[name])

    return df.select(*(cell(name).alias(name) for name in EVENT_SCHEMA.names))


def read_events(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """Events from csv (with header), json lines, parquet or orc. No pass over the data to infer types."""
    if fmt == "csv":
        # The columns of the first file's header, in whatever order. A folder whose files have other headers is an
        # error when it is read: by position their columns would be mixed up.
        header = spark.read.option("header", True).csv(path).schema
        raw = spark.read.option("header", True).option("enforceSchema", False).schema(header).csv(path)
    elif fmt == "json":
        raw = spark.read.schema(TEXT_SCHEMA).json(path)
    else:
        raw = spark.read.format(fmt).load(path)
    return conform_events(raw)


def canonical_events(
    log: DataFrame,
    only: Iterable[str] | None = None,
    names: Mapping[str, str] = EVENT_LOG_NAMES,
    keep: tuple[str, ...] = (),
    between: tuple[int, int] | None = None,
) -> DataFrame:
    """The event table from an event log (event_id, ts, user_id, event_type, props).

    ``only`` keeps the given events. It filters the log's own names, so that the filter reaches the file scan,
    which a filter on the renamed column would not. ``keep`` names columns of the log to carry along. ``between``
    gives the first and last epoch millisecond, and filters the log's own time column for the same reason.
    """
    if between is not None:
        log = log.filter(_moment(log, "ts", between[0]) <= F.col("ts"))
        log = log.filter(F.col("ts") < _moment(log, "ts", between[1] + 1))
    if only is not None:
        wanted = set(only)
        sources = [raw for raw, name in names.items() if name in wanted]
        sources += [name for name in wanted if name not in names]
        log = log.filter(F.col("event_type").isin(*sorted(sources)))
    event = F.col("event_type")
    for raw, name in names.items():
        event = F.when(F.col("event_type") == raw, F.lit(name)).otherwise(event)
    return log.select(
        *keep,
        _utc_millis(log, "ts").alias("timestamp"),
        F.col("user_id").cast("bigint").alias("visitorid"),
        event.alias("event"),
        F.get_json_object("props", "$.k").try_cast("bigint").alias("itemid"),
        F.when(event == PURCHASE, F.col("event_id")).alias("transactionid"),
    )


def _utc_millis(df: DataFrame, name: str) -> Column:
    """Epoch milliseconds; a timestamp without a zone is taken as UTC."""
    moment = F.col(name).cast("timestamp")
    zone = df.sparkSession.conf.get("spark.sql.session.timeZone")
    if isinstance(df.schema[name].dataType, T.TimestampNTZType) and zone != "UTC":
        moment = F.from_utc_timestamp(moment, zone)
    return F.unix_millis(moment)


def _moment(df: DataFrame, name: str, millis: int) -> Column:
    """A constant of the column's own type, so that a comparison with it reaches the scan."""
    kind = df.schema[name].dataType.simpleString()
    at = (datetime(1970, 1, 1) + timedelta(milliseconds=millis)).isoformat(sep=" ")
    return F.lit(f"{at}Z" if kind == "timestamp" else at).cast(kind)


def _event_order() -> list:
    return [F.col(name).asc_nulls_last() for name in EVENT_SCHEMA.names]


def first_events(events: DataFrame, n: int) -> DataFrame:
    """The first ``n`` events in time, in no particular order; events without a time come last.

    Counts per minute tell in which minute the n-th event falls. All events before that minute belong to the
    result as they are; only those of that one minute (or those without a time) are ordered.
    """
    if n < 0:
        raise ValueError("n must not be negative")
    events = events.select(*EVENT_SCHEMA.names)
    minute = pane_floor(F.col("timestamp"), MINUTE_MS)
    per_minute = events.groupBy(minute.alias("minute")).agg(F.count(F.lit(1)).alias("n"))
    # One row per minute of history: small enough for the single task that a running total needs.
    running = per_minute.filter("minute IS NOT NULL").select(
        "minute", "n", F.sum("n").over(Window.orderBy("minute")).alias("seen")
    )
    found = running.agg(
        F.min(F.when(F.col("seen") >= n, F.struct("minute", (F.col("seen") - F.col("n")).alias("before")))).alias("at"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("dated"),
    ).first()
    if found["at"] is None:
        head, tail, left = events.filter(minute.isNotNull()), events.filter(minute.isNull()), n - found["dated"]
    else:
        cutoff = F.lit(found["at"]["minute"])
        head, tail, left = events.filter(minute < cutoff), events.filter(minute == cutoff), n - found["at"]["before"]
    return head.unionByName(tail.orderBy(*_event_order()).limit(left))


def sample_rows(df: DataFrame, n: int = 5) -> DataFrame:
    """A small, repeatable sample: the first rows in the order of all columns."""
    return df.orderBy(*(F.col(name).asc_nulls_last() for name in df.columns)).limit(n)

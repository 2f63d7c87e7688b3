"""Publishing events as keyed JSON, and archiving a stream of them as files."""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from cartspark.functions import clean_nan, date_of, is_one_object, to_long, utc_text
from cartspark.sources.events import TEXT_SCHEMA, conform_events
from cartspark.sources.versions import (
    move,
    names_in,
    paths_like,
    read_pointer,
    read_text,
    remove_table,
    write_pointer,
    write_text,
)

BATCH = "batch_id"


def stamp_ingestion(events: DataFrame, at: Column | None = None) -> DataFrame:
    """Adds ``ingestion_time``, ISO-8601 in UTC. Records of one batch share the time the batch was started."""
    at = F.current_timestamp() if at is None else at
    return events.withColumn(
        "ingestion_time", utc_text(at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")
    )


def keyed_envelope(records: DataFrame, key: str = "visitorid") -> DataFrame:
    """``key`` and ``value`` of each record, ready for any sink that takes the two; nulls stay in the JSON."""
    fields = [clean_nan(F.col(f.name), f.dataType).alias(f.name) for f in records.schema]
    return records.select(
        F.col(key).cast("string").alias("key"),
        F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("value"),
    )


def archive_stream(
    records: DataFrame, path: str, checkpoint: str, fmt: str = "json", *, by_date: bool = False
) -> StreamingQuery:
    """Write the events that the stream holds to files and stop. A later run with the same checkpoint adds what is new.

    ``by_date`` partitions the archive by event date, so that batch jobs can skip days. Only the event columns are kept;
    ``archive_records`` keeps the records as they came.
    """
    writer = records.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if by_date:
        dated = records.withColumn("event_date", date_of(F.col("timestamp")))
        writer = (
            dated.writeStream.option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .partitionBy("event_date")
        )
    return writer.format(fmt).option("path", path).outputMode("append").start()


# Folders of an archive of records.
RECORDS, REJECTED, COUNTS, PENDING = "records", "rejected", "counts", "pending"
DATE = "event_date"


class _LimitReached(Exception):
    """Ends a limited run before it takes a micro-batch; the checkpoint offers that one again."""


@dataclass
class _Archive:
    """An archive of records and what its pointer says: parts so far, streams that fed it, and records set aside.

    Every write is a part of its own, numbered without gaps. The pointer is replaced after each part, and names the
    last micro-batch of each stream (by the id in its checkpoint), so a micro-batch that runs again is not taken twice.
    """

    spark: SparkSession
    path: str
    by_date: bool = False

    def state(self) -> dict:
        found = read_pointer(self.spark, self.path)
        if found is not None:
            return found[1]
        # Parts of an archive without a pointer stay.
        parts = [int(name.partition("=")[2]) for name in names_in(self.spark, f"{self.path}/{COUNTS}")]
        return {"id": uuid.uuid4().hex, "parts": max(parts, default=-1) + 1, "streams": {}, "pending": []}

    def publish(self, state: dict) -> None:
        found = read_pointer(self.spark, self.path)
        write_pointer(self.spark, self.path, found[0] + 1 if found else 1, state)

    def write(self, values: DataFrame, part: int) -> tuple[int, int]:
        """Write one part in one pass; what is no record is written by a second pass, if there is any."""
        folder, name = f"{self.path}/{RECORDS}", f"{BATCH}={part}"
        tally = Observation()
        judged = values.select("value", F.coalesce(is_one_object(F.col("value")), F.lit(False)).alias("good")).observe(
            tally, F.count_if("good").alias("archived"), F.count_if(~F.col("good")).alias("rejected")
        )
        # A line end inside a record is white space between its parts, or it would be no JSON.
        lines = judged.filter("good").select(F.regexp_replace("value", r"[\r\n]+", " ").alias("value"))
        if self.by_date:
            for left in paths_like(self.spark, f"{folder}/{DATE}=*/{name}"):
                remove_table(self.spark, left)
            time = to_long(F.get_json_object("value", "$.timestamp"), T.StringType())
            # A day's records lie in few files, and adaptive execution may split a day that holds most of them.
            dated = lines.withColumn(DATE, date_of(time)).withColumn(BATCH, F.lit(part)).hint("rebalance", DATE)
            writer = dated.write.partitionBy(DATE, BATCH).option("partitionOverwriteMode", "dynamic")
            writer.mode("overwrite").text(folder)
        else:
            lines.write.mode("overwrite").text(f"{folder}/{name}")
        counts = tally.get
        if counts["rejected"]:
            bad = values.filter(~F.coalesce(is_one_object(F.col("value")), F.lit(False)))
            bad.write.mode("overwrite").option("ignoreNullFields", False).json(f"{self.path}/{REJECTED}/{name}")
        else:
            remove_table(self.spark, f"{self.path}/{REJECTED}/{name}")
        write_text(self.spark, f"{self.path}/{COUNTS}/{name}/counts.json", json.dumps(counts))
        return counts["archived"], counts["rejected"]

    def write_first(self, values: DataFrame, part: int, n: int) -> tuple[tuple[int, int], str | None]:
        """Write the first ``n`` records as a part, and set the others aside; the second result is their folder."""
        # Numbered within each part of the input, so that no task takes all n rows. Holds this micro-batch alone.
        staged = f"{self.path}/{PENDING}/_staged"
        numbered = values.select("value", F.monotonically_increasing_id().alias("id"))
        numbered.write.mode("overwrite").parquet(staged)
        rows = self.spark.read.schema("value string, id bigint").parquet(staged)
        within, place = F.shiftrightunsigned("id", 33), F.col("id").bitwiseAND(F.lit((1 << 33) - 1))
        before = Window.orderBy("within").rowsBetween(Window.unboundedPreceding, -1)
        sizes = rows.groupBy(within.alias("within")).agg(F.count(F.lit(1)).alias("n")).withColumn(
            "seen", F.coalesce(F.sum("n").over(before), F.lit(0))
        )
        # The part of the input in which the limit falls, if one does.
        cut = sizes.filter(F.col("seen") + F.col("n") > n).orderBy("within").first()
        if cut is None:
            counts, rest = self.write(rows.select("value"), part), None
        else:
            first = (within < cut["within"]) | ((within == cut["within"]) & (place < n - cut["seen"]))
            counts, rest = self.write(rows.filter(first).select("value"), part), f"{PENDING}/part-{part}"
            rows.filter(~first).select("value").write.mode("overwrite").parquet(f"{self.path}/{rest}")
        remove_table(self.spark, staged)
        return counts, rest


def archive_records(
    values: DataFrame, path: str, checkpoint: str, limit: int | None = None, *, by_date: bool = False
) -> tuple[int, int]:
    """Add the text column ``value`` of all records that the stream holds, as it came, and return what was added:
    records, and texts that are none.

    ``path/records`` gets the JSON objects, one to a line, and ``path/rejected`` everything else as JSON text; ``by_date``
    puts the records of each date of ``timestamp`` into a folder of their own, so that readers can skip days. Every
    micro-batch is a part with its own folders, which a rerun replaces, and a file in ``path/counts``.

    With ``limit`` a run ends after so many texts, and reads no more of the stream than the micro-batches that hold them.
    What it read and did not take is set aside in ``path/pending`` and goes first in the next run, with or without a
    limit; the checkpoint goes on behind it. Runs may be cut off anywhere: each text is archived once.
    """
    if limit is not None and limit < 0:
        raise ValueError("limit must not be negative")
    archive = _Archive(values.sparkSession, path.rstrip("/"), by_date)
    if (known := archive.state()).get("first") is not None:
        raise ValueError(f"{path} holds the first records of a source only; archive into another folder")
    if known["parts"] and known.get("by_date", by_date) != by_date:
        raise ValueError(f"{path} is {'' if known['by_date'] else 'not '}divided by date")
    added, left, stopped = [], limit, False

    def take(batch: DataFrame, state: dict) -> str | None:
        nonlocal left
        if left is None:
            counts, rest = archive.write(batch, state["parts"]), None
        else:
            counts, rest = archive.write_first(batch, state["parts"], left)
            left -= sum(counts)
        added.append(counts)
        return rest

    while (pending := (state := archive.state())["pending"]) and left != 0:
        rest = take(archive.spark.read.schema("value string").parquet(f"{archive.path}/{pending[0]}"), state)
        archive.publish({**state, "parts": state["parts"] + 1, "by_date": by_date, "pending": [rest] * bool(rest) + pending[1:]})
        remove_table(archive.spark, f"{archive.path}/{pending[0]}")

    def write(batch: DataFrame, batch_id: int) -> None:
        nonlocal stopped
        state, stream = archive.state(), json.loads(read_text(archive.spark, f"{checkpoint}/metadata"))["id"]
        if batch_id <= state["streams"].get(stream, -1):
            return
        if left == 0:
            stopped = True
            raise _LimitReached
        rest = take(batch, state)
        streams = {**state["streams"], stream: batch_id}
        pending = state["pending"] + [rest] * bool(rest)
        archive.publish({**state, "parts": state["parts"] + 1, "by_date": by_date, "streams": streams, "pending": pending})

    if left != 0:
        query = (
            values.select("value").writeStream.option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).foreachBatch(write).start()
        )
        try:
            query.awaitTermination()
        except StreamingQueryException:
            if not stopped:
                raise
    return sum(n for n, _ in added), sum(n for _, n in added)


def archived_counts(spark: SparkSession, path: str) -> dict[int, tuple[int, int]]:
    """Archived and rejected records of every part so far."""
    if not names_in(spark, f"{path}/{COUNTS}"):
        return {}
    counts = spark.read.schema(f"archived bigint, rejected bigint, {BATCH} bigint").json(f"{path}/{COUNTS}").collect()
    return {row[BATCH]: (row["archived"], row["rejected"]) for row in counts}


def archived_parts(spark: SparkSession, path: str) -> int:
    """How many parts an archive has; they are numbered from 0."""
    return _Archive(spark, path.rstrip("/")).state()["parts"]


def archive_identity(spark: SparkSession, path: str) -> str:
    """A name that an archive keeps while it grows, and loses when it is replaced."""
    found = read_pointer(spark, path.rstrip("/"))
    if found is None:
        raise FileNotFoundError(f"{path} is no archive yet")
    return found[1]["id"]


def read_archive(
    spark: SparkSession, path: str, parts: range | None = None, dates: tuple[str, str] | None = None
) -> DataFrame:
    """Events of an archive: of all parts or of some, of all dates or (where it is divided by date) of some.

    Only folders of those parts are listed, and only those of the dates are read.
    """
    folder = f"{path.rstrip('/')}/{RECORDS}"
    by_date = bool(_Archive(spark, path.rstrip("/")).state().get("by_date"))
    if dates is not None and not by_date:
        raise ValueError(f"{path} is not divided by date")
    fields = [*TEXT_SCHEMA.fields, *([T.StructField(DATE, T.DateType())] if by_date else []), T.StructField(BATCH, T.LongType())]
    reader = spark.read.schema(T.StructType(fields)).option("basePath", folder)
    if parts is None:
        places = [folder] if names_in(spark, folder) else []
    elif by_date:
        places = [p for n in parts for p in paths_like(spark, f"{folder}/{DATE}=*/{BATCH}={n}")]
    else:
        places = [p for n in parts for p in paths_like(spark, f"{folder}/{BATCH}={n}")]
    rows = reader.json(places) if places else spark.createDataFrame([], T.StructType(fields))
    if dates is not None:
        first, last = (F.lit(day).cast("date") for day in dates)
        rows = rows.filter(F.col(DATE).between(first, last))
    return conform_events(rows)


def archive_first_records(spark: SparkSession, values: DataFrame, path: str, n: int) -> tuple[int, int]:
    """Replace the archive at ``path`` by the first ``n`` records of a stream, from its beginning.

    Nothing is remembered: the next run starts from the first record again. The old archive stays until the new one is
    complete. A folder that a checkpoint feeds is refused, since its records would not come back.
    """
    path = path.rstrip("/")
    state = _Archive(spark, path).state()
    if state["streams"] or state["pending"]:
        raise ValueError(f"{path} is fed by a checkpoint; name it, or another folder")
    new = f"{path}/_new-{uuid.uuid4().hex}"
    try:
        counts = archive_records(values, f"{new}/archive", f"{new}/checkpoint", n)
        parts = archived_parts(spark, f"{new}/archive")
        for name in (RECORDS, REJECTED, COUNTS):
            remove_table(spark, f"{path}/{name}")
            if names_in(spark, f"{new}/archive/{name}"):
                move(spark, f"{new}/archive/{name}", f"{path}/{name}")
        _Archive(spark, path).publish({**state, "id": uuid.uuid4().hex, "parts": parts, "first": n})
    finally:
        remove_table(spark, new)
    return counts

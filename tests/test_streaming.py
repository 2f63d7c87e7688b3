import base64
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartspark import operators as ops
from cartspark import plans
from cartspark import streaming as st
from cartspark.sources import EVENT_SCHEMA, canonical_events, read_events
from tests.conftest import MINUTE
from tests.test_windows import brute_force, collected, random_events

LOG = "/root/testdata/sf0.001/events.parquet"
ADD, BUY = "addtocart", "transaction"
ENVELOPE = T.StructType().add(
    "Records",
    T.ArrayType(T.StructType().add("kinesis", T.StructType().add("data", T.StringType()))),
)


def encode(value):
    text = value if isinstance(value, bytes) else json.dumps(value).encode()
    return base64.b64encode(text).decode()


def envelope(spark, *data):
    records = [{"kinesis": None if item is KeyError else {"data": item}} for item in data]
    return spark.createDataFrame([(records,)], ENVELOPE)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# Its encoded form ends in padding.
GOOD = {"timestamp": 11, "visitorid": 2, "event": ADD, "itemid": 3, "transactionid": None}


def test_decoding(spark):
    cases = {
        encode(GOOD): None,
        encode({**GOOD, "transactionid": 117.0, "ingestion_time": "x"}): None,
        encode({"event": ["odd"]}): None,
        # Line breaks inside base64 are skipped.
        encode({**GOOD, "itemid": 4})[:20] + "\n" + encode({**GOOD, "itemid": 4})[20:]: None,
        encode(b"plain text"): "bad json",
        encode(b""): "bad json",
        encode([1]): "not an object",
        encode(None): "not an object",
        encode(5): "not an object",
        encode(b"\xff\xfe"): "bad utf-8",
        "abc": "bad base64",
        encode(GOOD).rstrip("="): "bad base64",
        encode(b'{"event":"view"} xyz'): "bad json",
        encode(b'{"event":"view"}{"event":"view"}'): "bad json",
        encode(b'{"event":"view"},{"event":"view"}'): "bad json",
        encode(b'{"event":"view","event":"addtocart"}'): None,
        encode(b'{"event":"view","itemid":NaN}'): None,
        encode(GOOD)[:8] + "\u00e9" + encode(GOOD)[8:]: "bad base64",
        encode(GOOD) + "==": None,
        encode(GOOD) + "later": None,
        "=" + encode(GOOD): None,
        "=" + encode({"a": 1}).rstrip("="): "bad base64" if encode({"a": 1}).endswith("=") else None,
        "ab=c=": "bad utf-8",
        None: "no data",
        KeyError: "no data",
    }
    decoded = st.decode_envelope(envelope(spark, *cases)).collect()
    assert [row["failure_reason"] for row in decoded] == list(cases.values())
    assert tuple(decoded[0])[2:-1] == (11, 2, ADD, 3, None)
    assert decoded[1]["transactionid"] == 117
    assert decoded[3]["itemid"] == 4


def reference_base64(text):
    """What a lenient reader makes of a text."""
    try:
        return base64.b64decode(text)
    except ValueError:
        return None


def test_base64_is_read_as_a_lenient_reader_does(spark):
    import itertools

    texts = ["".join(t) for n in range(7) for t in itertools.product("Q=", repeat=n)] + ["Q Q\n=%=", "QQ\u00e9=="]
    frame = spark.createDataFrame([(t,) for t in texts], "data string")
    got = {r["data"]: r["failure_reason"] == "bad base64" for r in st.decode_records(frame).collect()}
    assert got == {t: reference_base64(t) is None for t in texts}


def test_empty_envelopes_have_an_estimate(spark):
    frame = spark.createDataFrame([(1, []), (2, None), (3, [{"kinesis": {"data": encode(GOOD)}}])], T.StructType().add("id", T.LongType()).add(ENVELOPE.fields[0]))
    decoded = st.decode_envelope(frame, keep=("id",))
    got = ops.micro_batch_estimate(decoded, by=("id",)).orderBy("id").collect()
    assert [(r["id"], r["processed_record_count"], r["failed_record_count"]) for r in got] == [(1, 0, 0), (2, 0, 0), (3, 1, 0)]
    assert st.good_events(decoded).count() == 1 and st.failed_records(decoded).count() == 0


def test_dead_letters_of_plain_events(spark, events, folder):
    events((1, 2, ADD, 3)).write.json(f"{folder}/in")
    stream = st.stream_events(spark, f"{folder}/in")
    st.stream_batch_estimates(
        stream, f"{folder}/out", f"{folder}/checkpoint", dead_letters=f"{folder}/dead"
    ).awaitTermination()
    assert st.read_estimates(spark, f"{folder}/out").first()["processed_record_count"] == 1


def test_good_records_and_dead_letters(spark):
    decoded = st.decode_envelope(envelope(spark, encode(GOOD), "abc"))
    assert rows(st.good_events(decoded)) == [(11, 2, ADD, 3, None)]
    assert rows(st.failed_records(decoded)) == [("abc", "bad base64")]


@pytest.mark.parametrize(
    ("adds", "buys", "left", "rate", "status"),
    [(2, 3, 0, 0.0, "NORMAL"), (0, 0, 0, 0.0, "NORMAL"), (5, 2, 3, 60.0, "NORMAL"), (3, 1, 2, 66.67, "HIGH_RISK")],
)
def test_micro_batch_estimate(spark, adds, buys, left, rate, status):
    data = [encode({"event": ADD})] * adds + [encode({"event": BUY})] * buys
    data += [encode({"event": "view"}), encode({"event": "other"}), "abc"]
    row = ops.micro_batch_estimate(st.decode_envelope(envelope(spark, *data))).collect()
    assert [tuple(r) for r in row] == [
        (
            adds + buys + 2,
            1,
            {"view": 1, ADD: adds, BUY: buys},
            adds,
            buys,
            left,
            rate,
            status,
        )
    ]


def test_estimate_of_an_empty_batch(spark):
    row = ops.micro_batch_estimate(st.decode_envelope(envelope(spark))).collect()[0]
    assert (row["processed_record_count"], row["estimated_abandonment_rate"]) == (0, 0.0)


def test_keyed_envelope_keeps_nulls_and_cleans_nan(spark):
    df = spark.sql("SELECT 7L AS visitorid, CAST(NULL AS bigint) AS itemid, double('NaN') AS price")
    at = F.lit("2026-01-02 03:04:05.678").cast("timestamp")
    row = st.keyed_envelope(st.stamp_ingestion(df, at)).first()
    assert row["key"] == "7"
    assert row["value"] == (
        '{"visitorid":7,"itemid":null,"price":null,"ingestion_time":"2026-01-02T03:04:05.678000+00:00"}'
    )


def test_publish(spark, events):
    table = events((2, 1, "view", 1), (1, 5, ADD, 1))
    sent = [json.loads(row["value"]) for row in plans.publish(table, limit=1).collect()]
    assert [record["visitorid"] for record in sent] == [5]
    assert sent[0]["ingestion_time"].endswith("+00:00")
    assert plans.publish(table, limit=0).isEmpty()


def test_published_records_can_be_decoded(spark, events):
    table = events((1, 2, ADD, 3), (4, 5, BUY, 6, 7), (None, None, "view", None))
    sent = plans.publish(table).select(F.base64(F.encode("value", "utf-8")).alias("data"))
    assert rows(st.good_events(st.decode_records(sent))) == rows(table)


def write_files(table, folder, parts):
    for index, (low, high) in enumerate(parts):
        table.filter(F.col("timestamp").between(low, high)).coalesce(1).write.json(
            f"{folder}/in/part={index}"
        )
    return f"{folder}/in/*"


def lines(spark, path):
    return sorted(row["value"] for row in spark.read.text(path).collect())


def test_archive_holds_every_record_once(spark, folder):
    events = canonical_events(spark.read.parquet(LOG))
    events.repartition(3).write.json(f"{folder}/in")
    source, out, checkpoint = f"{folder}/in", f"{folder}/out", f"{folder}/checkpoint"
    assert plans.archive(spark, source, out, checkpoint, max_files=1) == (1000, 0)
    assert lines(spark, f"{out}/records") == lines(spark, source)
    assert rows(read_events(spark, f"{out}/records", "json")) == rows(events)
    # A second run finds nothing new; new files are added to the archive.
    assert plans.archive(spark, source, out, checkpoint) == (0, 0)
    events.limit(10).coalesce(1).write.mode("append").json(source)
    assert plans.archive(spark, source, out, checkpoint) == (10, 0)
    assert read_events(spark, f"{out}/records", "json").count() == 1010


def test_archive_counts_every_micro_batch(spark, folder):
    import os

    os.mkdir(f"{folder}/in")
    for index in range(130):
        with open(f"{folder}/in/{index}.json", "w") as out:
            out.write('{"event":"view","itemid":%d}\n' % index)
    archived = plans.archive(spark, f"{folder}/in", f"{folder}/out", f"{folder}/checkpoint", max_files=1)
    assert archived == (130, 0)


def test_archive_keeps_records_as_they_came(spark, folder):
    import os

    os.mkdir(f"{folder}/in")
    good = ['{"event":"view","extra":[1, 2],"itemid":null}', '{ "timestamp":1.0,"timestamp":2 }', '{"a":"é"}']
    bad = ["not json", "[1]", '{"open":', "5"]
    with open(f"{folder}/in/a.json", "w") as out:
        out.write("\n".join(good + bad) + "\n")
    assert plans.archive(spark, f"{folder}/in", f"{folder}/out", f"{folder}/checkpoint") == (3, 4)
    assert lines(spark, f"{folder}/out/records") == sorted(good)
    rejected = spark.read.json(f"{folder}/out/rejected")
    assert sorted(row["value"] for row in rejected.collect()) == sorted(bad)


@pytest.mark.parametrize("limit", [0, 1, 450, 5000])
def test_limited_archive_starts_from_the_first_record(spark, folder, limit):
    events = canonical_events(spark.read.parquet(LOG))
    events.repartition(4).write.json(f"{folder}/in")
    for n in (3, limit):
        archived = plans.archive(spark, f"{folder}/in", f"{folder}/out", limit=n)
        assert archived == (min(n, 1000), 0)
    if limit:
        kept = read_events(spark, f"{folder}/out/records", "json")
        assert kept.count() == min(limit, 1000)
        assert kept.exceptAll(events).isEmpty()


def test_archive_without_limit_needs_a_checkpoint(spark, folder):
    with pytest.raises(ValueError, match="checkpoint"):
        plans.archive(spark, folder, f"{folder}/out")


def test_text_of_a_stream_becomes_events(spark, events, folder):
    table = events((1, 2, ADD, 3), (4, 5, BUY, 6, 7), (None, None, "view", None))
    plans.publish(table).select("value").write.text(f"{folder}/in")
    values = st.record_values(spark, f"{folder}/in")
    decoded = st.good_events(st.decode_values(values))
    st.archive_stream(decoded, f"{folder}/out", f"{folder}/checkpoint", "parquet").awaitTermination()
    assert rows(spark.read.parquet(f"{folder}/out")) == rows(table)


def test_archive_by_date_is_pruned(spark, folder):
    events = canonical_events(spark.read.parquet(LOG))
    events.write.json(f"{folder}/in")
    stream = st.stream_events(spark, f"{folder}/in")
    st.archive_stream(
        stream, f"{folder}/out", f"{folder}/checkpoint", "parquet", by_date=True
    ).awaitTermination()
    day = spark.read.parquet(f"{folder}/out").filter("event_date = date '2024-01-02'")
    assert "PartitionFilters: [isnotnull(event_date" in day._jdf.queryExecution().toString()
    first = 1_704_153_600_000
    assert day.count() == events.filter(F.col("timestamp").between(first, first + 86_399_999)).count()


def stream_windows(spark, events, folder, width, parts, **kwargs):
    source = write_files(events, folder, parts)
    stream = st.stream_events(spark, source, max_files=1)
    st.stream_sliding_windows(
        stream, f"{folder}/out", f"{folder}/checkpoint", width, **kwargs
    ).awaitTermination()
    return collected(st.read_stream_windows(spark, f"{folder}/out"))


def test_stream_windows_equal_brute_force(spark, events, folder):
    history = [row for row in random_events(21, 400, 60, 3, 8)]
    last = max(row[0] for row in history)
    got = stream_windows(
        spark,
        events(*history),
        folder,
        5,
        [(0, 20 * MINUTE - 1), (20 * MINUTE, 40 * MINUTE), (40 * MINUTE + 1, 60 * MINUTE)],
        watermark="10 minutes",
    )
    closed = {
        start: row
        for start, row in brute_force(history, 5, bounded=False).items()
        if row[0] <= last - 10 * MINUTE
    }
    assert got == closed


def test_wide_stream_windows_over_several_runs(spark, events, folder):
    history = random_events(22, 300, 150, 3, 8)
    for index, (low, high) in enumerate([(0, 50 * MINUTE - 1), (50 * MINUTE, 100 * MINUTE), (100 * MINUTE + 1, 150 * MINUTE)]):
        part = events(*[row for row in history if low <= row[0] <= high])
        part.coalesce(1).write.json(f"{folder}/in/part={index}")
        stream = st.stream_events(spark, f"{folder}/in/*", max_files=1)
        st.stream_sliding_windows(stream, f"{folder}/out", f"{folder}/checkpoint", 60, 5).awaitTermination()
    last = max(row[0] for row in history)
    got = collected(st.read_stream_windows(spark, f"{folder}/out"))
    expected = brute_force(history, 60, 5, bounded=False)
    assert got == {s: row for s, row in expected.items() if row[0] <= last - 10 * MINUTE}


def test_each_micro_batch_runs_its_stateful_plan_once(spark, events, folder):
    history = random_events(23, 400, 80, 3, 8)
    parts = [(i * 20 * MINUTE + (i > 0), (i + 1) * 20 * MINUTE) for i in range(4)]
    source = write_files(events(*history), folder, parts)
    stream = st.stream_events(spark, source, max_files=1)
    query = st.stream_sliding_windows(stream, f"{folder}/out", f"{folder}/checkpoint", 5, watermark="2 minutes")
    updated = [p["stateOperators"][0]["numRowsUpdated"] for p in query.recentProgress if p["numInputRows"]]
    late = [p["stateOperators"][0]["numRowsDroppedByWatermark"] for p in query.recentProgress]
    groups = []
    for low, high in parts:
        rows = [r for r in history if low <= r[0] <= high]
        carts = {(r[0] // MINUTE, r[1], r[3]) for r in rows if r[2] in (ADD, BUY)}
        groups.append(len(carts | {(r[0] // MINUTE, r[2] is None) for r in rows if r[2] not in (ADD, BUY)}))
    assert updated == groups and not any(late)


def test_bookkeeping_of_windows_does_not_grow(spark, events, folder):
    from cartspark.sources import names_in, read_pointer

    os_names = []
    for step in range(7):
        events(*((step * 30 * MINUTE + i * MINUTE, i, ADD, i) for i in range(30))).coalesce(1).write.json(f"{folder}/in/part={step}")
        stream = st.stream_events(spark, f"{folder}/in/*", max_files=1)
        st.stream_sliding_windows(stream, f"{folder}/out", f"{folder}/checkpoint", 5, watermark="1 minute").awaitTermination()
        state = read_pointer(spark, f"{folder}/out")[1]
        os_names.append((len(names_in(spark, f"{folder}/out/panes")), len(state["panes"]), len(state["closed"])))
    assert os_names[-1] == os_names[-2] and max(os_names[-1]) <= 4
    history = [(step * 30 * MINUTE + i * MINUTE, i, ADD, i) for step in range(7) for i in range(30)]
    closed = {s: r for s, r in brute_force(history, 5, bounded=False).items() if r[0] <= 209 * MINUTE - MINUTE}
    assert collected(st.read_stream_windows(spark, f"{folder}/out")) == closed


@pytest.mark.parametrize("drain", [True, False])
def test_late_rows_are_counted(spark, events, folder, drain):
    on_time = events(*((i * MINUTE, 1, ADD, 1) for i in range(0, 60, 10)))
    # Behind the watermark: two pairs in one minute, one of them twice, and two views of one minute.
    late = events(
        (MINUTE, 2, ADD, 2), (MINUTE + 1, 2, ADD, 2), (MINUTE, 3, ADD, 2), (2 * MINUTE, 4, "view", 1), (2 * MINUTE, 5, "view", 2),
        (59 * MINUTE, 9, ADD, 9),
    )
    last = events((90 * MINUTE, 3, "view", 3))
    # A micro-batch drops what was behind the watermark of the one before.
    between = events((51 * MINUTE, 1, "view", 1))
    for index, part in enumerate([on_time, between, late, last]):
        part.coalesce(1).write.json(f"{folder}/in/part={index}")
    stream = st.stream_events(spark, f"{folder}/in/*", max_files=1)
    query = st.stream_sliding_windows(
        stream, f"{folder}/out", f"{folder}/checkpoint", 5, watermark="2 minutes", drain=drain
    )
    if drain:
        query.awaitTermination()
    else:
        query.processAllAvailable()
        # One more micro-batch, so that the progress of those before is noted.
        events((200 * MINUTE, 3, "view", 3)).coalesce(1).write.json(f"{folder}/in/part=9")
        query.processAllAvailable()
        query.stop()
    found = st.read_late_rows(spark, f"{folder}/out").collect()
    assert sum(r["late_rows"] for r in found) == 3
    assert all(r["watermark"] is not None for r in found)
    assert st.read_late_rows(spark, f"{folder}/none").count() == 0


def test_a_row_later_than_the_watermark_is_in_no_window(spark, events, folder):
    on_time = [(i * MINUTE, 1, ADD, 1) for i in range(0, 60, 10)]
    spark_rows = events(*on_time)
    late = events((MINUTE, 2, ADD, 2))
    for index, part in enumerate([spark_rows, late, events((90 * MINUTE, 3, "view", 3))]):
        part.coalesce(1).write.json(f"{folder}/in/part={index}")
        stream = st.stream_events(spark, f"{folder}/in/*", max_files=1)
        st.stream_sliding_windows(
            stream, f"{folder}/out", f"{folder}/checkpoint", 5, watermark="2 minutes"
        ).awaitTermination()
    got = collected(st.read_stream_windows(spark, f"{folder}/out"))
    expected = brute_force(on_time, 5, bounded=False)
    assert got == {s: row for s, row in expected.items() if row[0] <= 88 * MINUTE}


def test_estimate_per_micro_batch_with_dead_letters(spark, folder):
    for index, data in enumerate(
        [[encode({"event": ADD}), "abc"], [encode({"event": ADD}), encode({"event": BUY})]]
    ):
        envelope(spark, *data).coalesce(1).write.json(f"{folder}/in/part={index}")
        envelopes = st.stream_events(spark, f"{folder}/in/*", schema=ENVELOPE)
        query = st.stream_batch_estimates(
            st.decode_envelope(envelopes),
            f"{folder}/out",
            f"{folder}/checkpoint",
            dead_letters=f"{folder}/dead",
        )
        query.awaitTermination()
    got = st.read_estimates(spark, f"{folder}/out").orderBy("batch_id")
    picked = got.select(
        "batch_id", "processed_record_count", "failed_record_count", "estimated_abandoned_count", "alert_status"
    )
    assert [tuple(r) for r in picked.collect()] == [(0, 1, 1, 1, "HIGH_RISK"), (1, 2, 0, 0, "NORMAL")]
    dead = spark.read.json(f"{folder}/dead").select("data", "failure_reason")
    assert rows(dead) == [("abc", "bad base64")]


def test_csv_stream_refuses_a_wrong_header(spark, folder):
    with open(f"{folder}/e.csv", "w") as out:
        out.write("visitorid,timestamp,event,itemid,transactionid\n1,2,view,3,\n")
    stream = st.stream_events(spark, folder, "csv")
    assert stream.schema == EVENT_SCHEMA
    query = st.archive_stream(stream, f"{folder}/out", f"{folder}/checkpoint")
    with pytest.raises(Exception, match="header|STREAM_FAILED"):
        query.awaitTermination()


def test_publish_works_on_a_stream(spark, folder):
    events = canonical_events(spark.read.parquet(LOG))
    events.write.json(f"{folder}/in")
    records = plans.publish(st.stream_events(spark, f"{folder}/in"))
    records.writeStream.format("parquet").option("path", f"{folder}/out").option(
        "checkpointLocation", f"{folder}/checkpoint"
    ).trigger(availableNow=True).start().awaitTermination()
    sent = spark.read.parquet(f"{folder}/out")
    fields = F.from_json("value", EVENT_SCHEMA)
    assert rows(sent.select(fields.alias("f")).select("f.*")) == rows(events)
    assert sent.filter(F.col("key") != fields["visitorid"].cast("string")).isEmpty()


def test_archive_feeds_the_batch_job(spark, folder):
    events = canonical_events(spark.read.parquet(LOG))
    events.write.parquet(f"{folder}/in")
    plans.archive(spark, f"{folder}/in", f"{folder}/out", f"{folder}/checkpoint", "parquet")
    archived = read_events(spark, f"{folder}/out/records", "json")
    tables = plans.batch_report(spark, archived, f"{folder}/results")
    assert tables["batch_summary"].first()["overall_cart_abandonment_rate"] == 93.5644

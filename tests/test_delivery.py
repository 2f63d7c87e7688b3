"""Publishing a stream, with what was sent, unkeyed and refused in each micro-batch."""

import json

import pytest

from cartspark import plans
from cartspark import streaming as st
from cartspark.sources import EVENT_SCHEMA, canonical_events, read_events

LOG = "/root/testdata/sf0.001/events.parquet"


def files(events, folder, *batches):
    for index, rows in enumerate(batches):
        events(*rows).coalesce(1).write.json(f"{folder}/in/part={index}")
    return f"{folder}/in/*"


def tallies(df):
    return sorted(tuple(row) for row in df.collect())


def test_tally_of_each_micro_batch(spark, events, folder):
    source = files(events, folder, [(1, 2, "view", 3), (2, None, "view", 3)], [(3, 4, "x" * 500, 1)], [(5, 6, "addtocart", 1)])
    tally = plans.stream_publish(spark, source, f"{folder}/out", f"{folder}/checkpoint", largest=400, max_files=1)
    assert tallies(tally) == [(0, 2, 1, 0), (1, 0, 0, 1), (2, 1, 0, 0)]
    sent = st.read_sent(spark, f"{folder}/out").collect()
    assert sorted((r["key"] or "", json.loads(r["value"])["timestamp"]) for r in sent) == [("", 2), ("2", 1), ("6", 5)]
    failed = spark.read.json(f"{folder}/out/failed").collect()
    assert [(r["key"], len(json.loads(r["value"])["event"])) for r in failed] == [("4", 500)]
    # Nothing is sent twice; new files are sent and counted by the next run.
    events((9, 9, "view", 9)).coalesce(1).write.json(f"{folder}/in/part=9")
    tally = plans.stream_publish(spark, source, f"{folder}/out", f"{folder}/checkpoint")
    assert tallies(tally)[3:] == [(3, 1, 0, 0)]


def test_equals_the_batch_job_on_the_same_rows(spark, folder):
    events = canonical_events(spark.read.parquet(LOG))
    events.write.json(f"{folder}/in")
    tally = plans.stream_publish(spark, f"{folder}/in", f"{folder}/out", f"{folder}/checkpoint")
    assert tallies(tally) == [(0, 1000, 0, 0)]
    values = st.read_sent(spark, f"{folder}/out").select("value")
    values.write.text(f"{folder}/back")
    back = read_events(spark, f"{folder}/back", "json")
    assert back.schema == EVENT_SCHEMA and back.exceptAll(events).isEmpty() and events.exceptAll(back).isEmpty()


def test_delivery_that_fails_is_made_again(spark, events, folder):
    source, calls = files(events, folder, [(1, 2, "view", 3)], [(2, 3, "view", 3)]), []
    to_files = st.file_sink(f"{folder}/out")

    def broken(records, batch_id):
        calls.append(batch_id)
        to_files(records, batch_id)
        if len(calls) == 2:
            raise OSError("broker lost")

    def run(send):
        stream = st.stream_events(spark, source, max_files=1)
        st.publish_stream(stream, f"{folder}/out", f"{folder}/checkpoint", send).awaitTermination()

    with pytest.raises(Exception, match="broker lost"):
        run(broken)
    assert tallies(st.read_tally(spark, f"{folder}/out")) == [(0, 1, 0, 0)]
    run(to_files)
    assert tallies(st.read_tally(spark, f"{folder}/out")) == [(0, 1, 0, 0), (1, 1, 0, 0)]
    assert st.read_sent(spark, f"{folder}/out").count() == 2


def test_tally_before_anything_was_sent(spark, folder):
    assert st.read_tally(spark, f"{folder}/out").collect() == []

import re

import pytest
from pyspark.sql import functions as F

from cartspark.sources import (
    CART_EVENTS,
    EVENT_SCHEMA,
    canonical_events,
    conform_events,
    first_events,
    read_events,
    read_result,
    require_columns,
    sample_rows,
    write_result,
    write_table,
)

LOG = "/root/testdata/sf0.001/events.parquet"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_csv_goes_by_header_names_and_keeps_rows_with_bad_numbers(spark, folder):
    path = f"{folder}/events.csv"
    with open(path, "w") as out:
        out.write("visitorid,timestamp,itemid,event,transactionid\n")
        out.write("1,100,7,addtocart,\n2,oops,8,view,\n3,300,9,transaction,4.0\n")
    events = read_events(spark, path)
    assert events.schema == EVENT_SCHEMA
    assert rows(events) == [
        (100, 1, "addtocart", 7, None),
        (300, 3, "transaction", 9, 4),
        (None, 2, "view", 8, None),
    ]


def test_csv_folder_with_differing_headers_is_refused(spark, folder):
    for name, header in (("a", "visitorid,itemid"), ("b", "itemid,visitorid")):
        with open(f"{folder}/{name}.csv", "w") as out:
            out.write(f"timestamp,event,{header}\n1,view,2,3\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_events(spark, folder).collect()


def test_timestamps_become_epoch_milliseconds(spark):
    zoned = "timestamp '2024-01-01 00:00:00.5Z'"
    plain = "timestamp_ntz '2024-01-01 00:00:00.5'"
    for moment in (zoned, plain):
        frame = spark.sql(f"SELECT {moment} AS timestamp, 1L AS visitorid, 'view' AS event, 2 AS itemid")
        assert conform_events(frame).first()["timestamp"] == 1704067200500


def test_first_events_orders_one_minute_only(spark):
    table = canonical_events(spark.read.parquet(LOG))
    first = first_events(table, 500)
    assert first.count() == 500
    ordered = sorted(r["timestamp"] for r in table.collect())[:500]
    assert sorted(r["timestamp"] for r in first.collect()) == ordered
    limits = re.findall(r"TakeOrderedAndProject\(limit=(\d+)", first._jdf.queryExecution().executedPlan().toString())
    assert [int(n) < 100 for n in limits] == [True]


def test_json_numbers_written_as_floats(spark, folder):
    with open(f"{folder}/e.json", "w") as out:
        out.write('{"timestamp":5,"visitorid":1,"event":"transaction","itemid":2,"transactionid":117.0}\n')
        out.write('{"timestamp":6,"visitorid":1,"event":"view","itemid":2,"transactionid":null}\n')
    assert rows(read_events(spark, folder, "json")) == [
        (5, 1, "transaction", 2, 117),
        (6, 1, "view", 2, None),
    ]


@pytest.mark.parametrize("fmt", ["csv", "json", "parquet", "orc"])
def test_events_survive_each_format(spark, events, folder, fmt):
    table = events((1, 2, "view", 3), (4, None, "addtocart", None), (6, 7, "transaction", 8, 9))
    path = write_table(table, f"{folder}/events", fmt)
    assert rows(read_events(spark, path, fmt)) == rows(table)


def test_missing_columns_are_named(spark):
    with pytest.raises(ValueError, match=r"\['event', 'timestamp'\]"):
        require_columns(spark.range(1).selectExpr("id AS visitorid", "id AS itemid"))


def test_filter_reaches_the_scan(spark):
    plan = canonical_events(spark.read.parquet(LOG), only=CART_EVENTS)._jdf.queryExecution().toString()
    assert "PushedFilters: [In(event_type, [addtocart,click,purchase,transaction])" in plan


def test_only_equals_a_filter_on_the_event(spark):
    log = spark.read.parquet(LOG)
    filtered = canonical_events(log).filter(F.col("event").isin(*CART_EVENTS))
    assert rows(canonical_events(log, only=CART_EVENTS)) == rows(filtered)


def test_columns_are_pruned(spark):
    plan = canonical_events(spark.read.parquet(LOG)).groupBy("event").count()
    assert "ReadSchema: struct<event_type:string>" in plan._jdf.queryExecution().toString()


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 5, 9])
def test_first_events_takes_undated_rows_last(events, n):
    table = events(
        (130_000, 1, "view", 1),
        (None, 2, "view", 1),
        (5, 3, "view", 1),
        (5, 2, "view", 1),
        (70_000, 1, "addtocart", 1),
    )
    order = [(5, 2), (5, 3), (70_000, 1), (130_000, 1), (None, 2)]
    taken = [(r["timestamp"], r["visitorid"]) for r in first_events(table, n).collect()]
    assert sorted(taken, key=str) == sorted(order[:n], key=str)


def test_first_events_refuses_a_negative_number(events):
    with pytest.raises(ValueError):
        first_events(events(), -1)


def test_sample_is_repeatable(spark):
    log = canonical_events(spark.read.parquet(LOG))
    assert rows(sample_rows(log)) == rows(sample_rows(log.repartition(7)))


def test_results_are_overwritten_and_nested_columns_become_json_in_csv(spark, folder):
    first = spark.sql("SELECT 1 AS a, array('x', 'y') AS b")
    write_result(first, folder, "r", "csv", tiny=True)
    write_result(first, folder, "r", "csv", tiny=True)
    assert rows(read_result(spark, folder, "r", "csv")) == [("1", '["x","y"]')]


@pytest.mark.parametrize("fmt", ["csv", "json", "parquet"])
def test_empty_texts_and_nulls_survive(spark, folder, fmt):
    frame = spark.createDataFrame([(1, ""), (2, None), (3, "x")], "a int, b string")
    write_result(frame, folder, "r", fmt)
    assert rows(read_result(spark, folder, "r", fmt, frame.schema)) == rows(frame)


def test_missing_result_is_an_error(spark, folder):
    with pytest.raises(FileNotFoundError):
        read_result(spark, folder, "absent")

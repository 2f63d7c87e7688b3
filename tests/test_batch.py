import pytest
from pyspark.sql import functions as F

from cartspark import operators as ops
from cartspark.sources import CART_EVENTS, canonical_events
from tests.conftest import HOUR

ADD, BUY = "addtocart", "transaction"


def pairs_of(df):
    return {(r["visitorid"], r["itemid"]) for r in df.collect()}


@pytest.mark.parametrize(
    ("history", "abandoned"),
    [
        ([(100, ADD)], True),
        ([(100, ADD), (200, BUY)], False),
        ([(200, ADD), (100, BUY)], True),
        ([(100, ADD), (100, BUY)], True),
        ([(100, ADD), (200, BUY), (300, ADD)], True),
        ([(100, ADD), (300, ADD), (301, BUY)], False),
    ],
)
def test_abandoned(events, history, abandoned):
    state = ops.pair_state(events(*((ts, 1, event, 7) for ts, event in history)))
    assert pairs_of(ops.add_pairs(state)) == {(1, 7)}
    assert pairs_of(ops.abandoned_pairs(state)) == ({(1, 7)} if abandoned else set())


def test_what_is_no_pair(events):
    state = ops.pair_state(
        events((1, 1, BUY, 7), (2, None, ADD, 7), (3, 2, ADD, None), (4, 3, "view", 7), (None, 4, ADD, 7))
    )
    assert pairs_of(ops.add_pairs(state)) == set()


def summary_of(df, **kwargs):
    return ops.batch_summary(df, **kwargs).collect()[0].asDict()


def test_summary(events):
    table = events(
        (1, 1, "view", 1),
        (2, 1, ADD, 1),
        (3, 1, BUY, 1),
        (4, 1, ADD, 2),
        (5, 2, ADD, 2),
        (6, 2, "signup", None),
        (None, None, ADD, 3),
        (8, 3, None, 1),
    )
    assert summary_of(table) == {
        "total_rows": 8,
        "total_views": 1,
        "total_addtocart_events": 4,
        "total_transactions": 1,
        "unique_visitors": 3,
        "unique_items": 3,
        "unique_addtocart_visitor_item_pairs": 3,
        "abandoned_visitor_item_pairs": 2,
        "overall_cart_abandonment_rate": 66.6667,
    }
    assert summary_of(table, scale=None)["overall_cart_abandonment_rate"] == 2 / 3 * 100


def test_summary_of_nothing(events):
    assert set(summary_of(events()).values()) == {0, 0.0}
    only_views = summary_of(events((1, 1, "view", 1)))
    assert only_views["total_rows"] == 1
    assert only_views["overall_cart_abandonment_rate"] == 0.0


def test_without_purchases_all_pairs_are_abandoned(events):
    assert summary_of(events((1, 1, ADD, 1), (2, 2, ADD, 1)))["overall_cart_abandonment_rate"] == 100.0


def test_top_products_break_ties_by_item(events):
    table = events(*((i, i, ADD, item) for i, item in enumerate([5, 3, 3, 9, 5, 1])))
    top = ops.top_abandoned_products(ops.pair_state(table), 3)
    assert [tuple(r) for r in top.collect()] == [(3, 2), (5, 2), (1, 1)]


def hours(df):
    return {tuple(r)[0]: tuple(r)[1:] for r in df.withColumn("hour", F.unix_millis("hour")).collect()}


def test_hourly_events(events):
    table = events(
        (10, 1, "view", 1),
        (20, 1, ADD, 1),
        (HOUR, 1, "error", 1),
        (2 * HOUR, 1, BUY, 1),
        (2 * HOUR + 1, 1, BUY, 1),
        (None, 1, "view", 1),
    )
    expected = {0: (1, 1, 0, 2), HOUR: (0, 0, 0, 0), 2 * HOUR: (0, 0, 2, 2)}
    assert hours(ops.hourly_event_trend(table)) == expected
    assert hours(ops.rollup_hours(ops.history_rollup(table))) == expected


def test_hourly_abandonment_goes_by_the_first_add(events):
    table = events(
        (11 * HOUR + 60_000, 1, ADD, 1),
        (10 * HOUR + 59 * 60_000, 1, ADD, 1),
        (10 * HOUR, 2, ADD, 1),
        (10 * HOUR + 1, 2, BUY, 1),
    )
    trend = ops.hourly_abandonment_trend(ops.pair_state(table))
    assert hours(trend) == {10 * HOUR: (2, 1, 50.0)}


def test_profile_from_one_scan_equals_its_parts(spark, events):
    from cartspark import plans

    log = canonical_events(spark.read.parquet("/root/testdata/sf0.001/events.parquet"))
    for table in (log, events((1, 1, "view", None), (None, 1, None, 2), (3, 1, None, 2)), events()):
        report = plans.profile_report(table)
        parts = {
            "event_type_counts": ops.event_type_counts(table),
            "null_profile": ops.null_profile(table),
            "batch_summary": ops.batch_summary(table),
            "top_abandoned_products": ops.top_abandoned_products(ops.pair_state(table)),
        }
        for name, part in parts.items():
            assert sorted(map(tuple, report[name].collect()), key=str) == sorted(map(tuple, part.collect()), key=str)
    plan = ops.history_rollup(log, ("visitor", "item", "pair"), profile=True)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_profile(events):
    table = events((1, 1, "view", None), (None, 1, None, 2), (3, 1, None, 2))
    counts = {tuple(r) for r in ops.event_type_counts(table).collect()}
    assert counts == {("view", 1), (None, 2)}
    nulls = {tuple(r) for r in ops.null_profile(table).collect()}
    assert nulls == {
        ("timestamp", 1),
        ("visitorid", 0),
        ("event", 2),
        ("itemid", 1),
        ("transactionid", 3),
    }


@pytest.mark.parametrize(
    ("sf", "rows", "pairs", "abandoned", "rate", "top"),
    [
        ("0.001", 1000, 202, 189, 93.5644, [(26, 5), (63, 5), (67, 5)]),
        ("0.01", 10000, 1876, 1759, 93.7633, [(96, 28), (15, 27), (9, 26)]),
    ],
)
def test_totals_agree_on_test_data(spark, sf, rows, pairs, abandoned, rate, top):
    log = spark.read.parquet(f"/root/testdata/sf{sf}/events.parquet")
    events = canonical_events(log)
    summary = summary_of(events)
    assert summary["total_rows"] == rows
    assert summary["unique_addtocart_visitor_item_pairs"] == pairs
    assert summary["abandoned_visitor_item_pairs"] == abandoned
    assert summary["overall_cart_abandonment_rate"] == rate
    state = ops.pair_state(canonical_events(log, only=CART_EVENTS))
    best = ops.top_abandoned_products(state).collect()
    assert [tuple(r) for r in best[:3]] == top
    hourly = ops.hourly_abandonment_trend(state).agg(
        F.sum("addtocart_pair_count"), F.sum("abandoned_pair_count")
    )
    assert tuple(hourly.first()) == (pairs, abandoned)
    per_item = ops.top_abandoned_products(state, 1000).agg(F.sum("abandoned_count"))
    assert per_item.first()[0] == abandoned
    rolled = ops.rollup_pairs(ops.history_rollup(events))
    assert rolled.exceptAll(state).isEmpty()
    assert state.exceptAll(rolled).isEmpty()


def test_ratio_to_baseline(spark):
    runs = spark.createDataFrame(
        [("a", 2, 50.0), ("a", 1, 100.0), ("a", 4, 20.0), ("b", 3, 0.0), (None, 1, 5.0), (None, None, 2.0)],
        "cluster string, workers int, seconds double",
    )
    rows = ops.ratio_to_baseline(
        runs, "seconds", "workers", by=("cluster",), name="speedup", inverse=True
    ).collect()
    assert {(r["cluster"], r["workers"]): r["speedup"] for r in rows} == {
        ("a", 1): 1.0,
        ("a", 2): 2.0,
        ("a", 4): 5.0,
        ("b", 3): None,
        (None, 1): 1.0,
        (None, None): 2.5,
    }
    overall = ops.ratio_to_baseline(runs.filter("cluster = 'a'"), "seconds", "workers")
    assert sorted(r["ratio"] for r in overall.collect()) == [0.2, 0.5, 1.0]


def test_abandonment_by_the_hour_equals_a_semi_join(spark):
    events = canonical_events(spark.read.parquet("/root/testdata/sf0.001/events.parquet"))
    state = ops.pair_state(events)
    first_adds = (
        events.filter(F.col("event") == ADD)
        .groupBy("visitorid", "itemid")
        .agg(F.min("timestamp").alias("first"))
    )
    left = first_adds.join(ops.abandoned_pairs(state), ["visitorid", "itemid"], "left_semi")
    hour = (F.floor(F.col("first") / HOUR) * HOUR).alias("hour")
    expected = {row["hour"]: row["count"] for row in left.groupBy(hour).count().collect()}
    got = hours(ops.hourly_abandonment_trend(state))
    assert {h: row[1] for h, row in got.items() if row[1]} == expected
    assert {h for h, row in got.items() if not row[1]}.isdisjoint(expected)


def test_pairs_survive_lost_precision_of_keys(events):
    big = 2**53
    table = events((1, big, ADD, 1), (2, big + 1, ADD, 1), (3, big, BUY, 1))
    assert pairs_of(ops.abandoned_pairs(ops.pair_state(table))) == {(big + 1, 1)}

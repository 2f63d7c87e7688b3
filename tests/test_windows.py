import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cartspark import operators as ops
from cartspark.functions import event_time
from cartspark.plans.catalogue import QUERIES
from tests.conftest import MINUTE

ADD, BUY = "addtocart", "transaction"


def brute_force(rows, width, slide=1, bounded=True):
    """Window rows straight from the definition."""
    rows = [row for row in rows if row[0] is not None]
    if not rows:
        return {}
    size, step = width * MINUTE, slide * MINUTE
    times = [row[0] for row in rows]
    first, last = min(times) // step * step, -(-max(times) // step) * step
    start, out = min(times) // step * step - size, {}
    while start <= max(times):
        inside = [row for row in rows if start <= row[0] < start + size]
        if inside and not (bounded and (start < first or start + size > last)):
            added = {(v, i) for _, v, e, i in inside if e == ADD}
            left = added - {(v, i) for _, v, e, i in inside if e == BUY}
            rate = len(left) / len(added) * 100 if added else 0.0
            items = Counter(item for _, item in left if item is not None)
            best = sorted(items, key=lambda item: (-items[item], item))[:5]
            out[start] = (
                start + size,
                len(inside),
                sum(row[2] == ADD for row in inside),
                sum(row[2] == BUY for row in inside),
                len(left),
                round(rate, 4),
                [str(item) for item in best],
                "HIGH_RISK" if rate > 60 else "NORMAL",
            )
        start += step
    return out


def collected(windows):
    rows = windows.withColumns(
        {name: F.unix_millis(name) for name in ("window_start", "window_end")}
    ).collect()
    out = {row[0]: tuple(row)[1:] for row in rows}
    assert len(out) == len(rows)
    return out


def by_copying(table, width, slide=1):
    timed = table.withColumn("event_time", event_time(F.col("timestamp")))
    timed = timed.filter(F.col("event_time").isNotNull())
    return ops.windows_from_groups(ops.cart_groups(timed, width, slide), width)


def random_events(seed, n, minutes, visitors, items):
    rng = random.Random(seed)
    return [
        (
            # A share of the events falls exactly on a minute.
            rng.randrange(minutes) * MINUTE + rng.choice([0, rng.randrange(MINUTE)]),
            rng.choice([None, *range(visitors)]),
            rng.choice([ADD, ADD, BUY, "view", "error", None]),
            rng.choice([None, *range(items)]),
        )
        for _ in range(n)
    ]


@pytest.mark.parametrize(
    ("seed", "n", "minutes", "visitors", "items", "width", "slide"),
    [
        (1, 300, 40, 3, 4, 5, 1),
        (2, 300, 200, 2, 12, 60, 1),
        (3, 200, 30, 1, 1, 7, 1),
        (4, 200, 90, 4, 9, 30, 10),
        (5, 200, 90, 2, 3, 10, 10),
        (6, 60, 2000, 2, 2, 5, 1),
        (7, 500, 20, 6, 30, 4, 1),
    ],
)
def test_windows_equal_brute_force(spark, events, seed, n, minutes, visitors, items, width, slide):
    rows = random_events(seed, n, minutes, visitors, items)
    table = events(*rows)
    assert collected(ops.sliding_windows(table, width, slide)) == brute_force(rows, width, slide)
    assert collected(by_copying(table, width, slide)) == brute_force(rows, width, slide, bounded=False)


def test_one_pair_with_most_of_the_rows(events):
    rng = random.Random(11)
    rows = random_events(8, 60, 30, 3, 4)
    rows += [(rng.randrange(30 * MINUTE), 1, rng.choice([ADD, BUY]), 2) for _ in range(400)]
    assert collected(ops.sliding_windows(events(*rows), 3)) == brute_force(rows, 3)


def test_a_purchase_before_the_add_clears_the_pair_in_its_window(events):
    rows = [(0, 9, "view", 9), (2 * MINUTE, 1, BUY, 7), (3 * MINUTE, 1, ADD, 7), (20 * MINUTE + 1, 9, "view", 9)]
    windows = collected(ops.sliding_windows(events(*rows), 5))
    assert windows[0][4] == 0
    assert windows[2 * MINUTE][4] == 0
    assert windows[3 * MINUTE][4] == 1


def test_borders(events):
    rows = [(0, 1, ADD, 1), (5 * MINUTE, 2, ADD, 2), (6 * MINUTE, 3, ADD, 3)]
    windows = collected(ops.sliding_windows(events(*rows), 5))
    # The last event lies exactly on a minute, where the last window ends, so no window holds it.
    assert sorted(windows) == [0, MINUTE]
    assert windows[0][1] == 1
    assert windows[MINUTE][1] == 1


def test_no_window_when_the_span_is_too_short(events):
    assert ops.sliding_windows(events((0, 1, ADD, 1), (MINUTE, 1, ADD, 1)), 5).isEmpty()
    assert ops.sliding_windows(events(), 5).isEmpty()
    assert ops.sliding_windows(events((None, 1, ADD, 1)), 5).isEmpty()


@pytest.mark.parametrize(("bought", "status"), [(2, "NORMAL"), (1, "HIGH_RISK")])
def test_sixty_percent_is_normal(events, bought, status):
    rows = [(1, visitor, ADD, 1) for visitor in range(5)]
    rows += [(2, visitor, BUY, 1) for visitor in range(bought)]
    rows += [(MINUTE - 1, 99, "view", 1)]
    windows = collected(ops.sliding_windows(events(*rows), 1))
    assert windows[0][-1] == status


def test_only_the_five_lowest_of_tied_items(events):
    rows = [(1, 1, ADD, item) for item in (6, 5, 4, 3, 2, 1)] + [(MINUTE - 1, 1, "view", 1)]
    assert collected(ops.sliding_windows(events(*rows), 1))[0][6] == ["1", "2", "3", "4", "5"]


@pytest.mark.parametrize(("width", "slide"), [(0, 1), (5, 0), (5, 2), (-5, 1)])
def test_bad_sizes_are_refused(events, width, slide):
    with pytest.raises(ValueError):
        ops.sliding_windows(events(), width, slide)


def test_latest_and_recent(events):
    rows = random_events(3, 100, 30, 2, 3)
    windows = ops.sliding_windows(events(*rows), 5)
    expected = brute_force(rows, 5)
    assert collected(ops.latest_window(windows)) == {max(expected): expected[max(expected)]}
    recent = ops.recent_windows(windows, 3)
    assert sorted(collected(recent)) == sorted(expected)[-3:]
    assert ops.latest_window(windows.limit(0)).isEmpty()


def test_no_join_without_a_key(events):
    plan = ops.sliding_windows(events((1, 1, ADD, 1)), 5)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize(
    ("width", "expected"),
    [(5, (4681, 4992, 1050, 1041)), (60, (31641, 59778, 12600, 10690))],
)
def test_totals_agree_on_test_data(spark, width, expected):
    from cartspark.sources import canonical_events

    table = canonical_events(spark.read.parquet("/root/testdata/sf0.001/events.parquet"))
    totals = ops.sliding_windows(table, width).agg(
        F.count("*"),
        F.sum("event_count"),
        F.sum("estimated_abandoned_count"),
        F.count_if(F.col("alert_status") == "HIGH_RISK"),
    )
    assert tuple(totals.first()) == expected


def test_abandoned_pairs_of_a_window_are_a_set_difference(events):
    rows = random_events(31, 400, 30, 5, 6)
    table = events(*rows)
    size = 30 * MINUTE
    pairs = {
        name: table.filter((F.col("event") == name) & F.col("timestamp").between(0, size - 1)).select(
            "visitorid", "itemid"
        )
        for name in (ADD, BUY)
    }
    by_set = pairs[ADD].distinct().subtract(pairs[BUY]).count()
    same = [F.col(f"a.{key}").eqNullSafe(F.col(f"b.{key}")) for key in ("visitorid", "itemid")]
    by_join = pairs[ADD].distinct().alias("a").join(pairs[BUY].alias("b"), same, "left_anti").count()
    window = collected(ops.sliding_windows(events(*rows, (0, 9, "view", 9), (size - 1, 9, "view", 9)), 30))
    assert window[0][4] == by_set == by_join > 0


@pytest.mark.parametrize("partitions", ["1", "3", "13"])
def test_the_number_of_partitions_does_not_matter(spark, events, partitions):
    rows = random_events(41, 300, 30, 4, 40)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        assert collected(ops.sliding_windows(events(*rows), 5)) == brute_force(rows, 5)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.mark.parametrize(("n", "width", "slide"), [(1, 5, 1), (4, 5, 1), (10, 60, 1), (3, 30, 10), (500, 5, 1)])
@pytest.mark.parametrize("last", [0, 1])
def test_last_windows_equal_the_end_of_all_windows(events, n, width, slide, last):
    # A gap before the end, and a last event on a minute or just behind one.
    rows = random_events(5, 200, 90, 3, 6) + [(170 * MINUTE, 1, ADD, 1), (300 * MINUTE + last, 2, ADD, 2)]
    table = events(*rows)
    all_ = collected(ops.sliding_windows(table, width, slide))
    want = {start: all_[start] for start in sorted(all_)[-n:]}
    assert collected(ops.last_windows(table, n, width, slide)) == want


def test_last_windows_without_events(events):
    assert collected(ops.last_windows(events(), 3)) == {}
    assert collected(ops.last_windows(events((None, 1, ADD, 1)), 3)) == {}


def test_last_windows_filter_the_scan(spark):
    plan = QUERIES["latest_window"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert plan.count("PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts") + plan.count(
        "IsNotNull(event_type), IsNotNull(ts)"
    ) + plan.count("GreaterThanOrEqual(ts,") >= 2

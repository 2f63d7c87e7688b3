import pytest

from cartspark import operators as ops
from cartspark import plans
from cartspark.plans.jobs import SUMMARY_SCHEMA, TOP_SCHEMA, WINDOW_SCHEMA
from cartspark.sources import canonical_events

LOG = "/root/testdata/sf0.001/events.parquet"


@pytest.fixture
def inputs(spark):
    def build(rate=71.238, top=((1041, 33), (2077, 21)), ids="[]", window=True):
        summary = spark.createDataFrame(
            [(90210, 83780, 5120, 1310, 7001, 812, 4400, 3135, rate)], SUMMARY_SCHEMA
        )
        products = spark.createDataFrame(list(top), TOP_SCHEMA)
        windows = spark.sql(
            "SELECT timestamp '2031-03-09 14:20:00' AS window_start, timestamp '2031-03-09 14:25:00' AS "
            "window_end, 5L AS event_count, 2L AS addtocart_count, 0L AS transaction_count, 0L AS "
            f"estimated_abandoned_count, 0.0D AS estimated_abandonment_rate, '{ids}' AS "
            "top_5_abandoned_item_ids, 'NORMAL' AS alert_status"
        ).to(spark.createDataFrame([], WINDOW_SCHEMA.format(items="STRING")).schema)
        return summary, products, windows if window else windows.limit(0)

    return build


def test_view_and_sentence(inputs):
    view = ops.serving_view(*inputs()).collect()
    assert [tuple(row) for row in view] == [(71.238, 0.0, "NORMAL", 5120, 1310, 1041, "")]
    alert = ops.alert_summary(*inputs()).collect()[0]
    assert str(alert["generated_from_window_end"]) == "2031-03-09 14:25:00"
    assert alert["report_summary"] == (
        "Historical abandonment was 71.24%. The latest 2031-03-09 14:20:00 to 2031-03-09 14:25:00 window was "
        "0.00% (NORMAL). Top historical abandoned item: 1041; recent top abandoned item: not available."
    )


@pytest.mark.parametrize(("ids", "item"), [('["12", "7"]', "12"), ("[]", ""), ("broken", "")])
def test_recent_item(inputs, ids, item):
    assert ops.serving_view(*inputs(ids=ids)).first()["recent_top_abandoned_item"] == item


def test_sentence_rounds_half_even(inputs):
    text = ops.alert_summary(*inputs(rate=3.125)).first()["report_summary"]
    assert text.startswith("Historical abandonment was 3.12%.")


def test_no_window_and_no_product(inputs):
    parts = inputs(top=(), window=False)
    view = ops.serving_view(*parts).collect()
    assert [tuple(row) for row in view] == [(71.238, None, None, 5120, 1310, None, "")]
    alert = ops.alert_summary(*parts).first()
    assert alert["generated_from_window_end"] is None
    assert "No recent window is available." in alert["report_summary"]
    assert alert["report_summary"].endswith("item: ; recent top abandoned item: not available.")


def test_no_cross_join(inputs):
    plan = ops.serving_view(*inputs())._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_jobs_end_to_end(spark, folder, fmt):
    events = canonical_events(spark.read.parquet(LOG))
    tables = plans.batch_report(spark, events, folder, fmt)
    assert tables["batch_summary"].first()["overall_cart_abandonment_rate"] == 93.5644
    best = [row["itemid"] for row in tables["top_abandoned_products"].collect()]
    assert best[:3] == [26, 63, 67]
    hourly = tables["hourly_event_trend"]
    assert hourly.exceptAll(ops.hourly_event_trend(events)).isEmpty()
    assert hourly.count() == 531
    trend = tables["hourly_abandonment_trend"]
    assert trend.exceptAll(ops.hourly_abandonment_trend(ops.pair_state(events))).isEmpty()
    assert trend.count() == 174
    windows = plans.speed_report(spark, events, folder, fmt)
    assert windows.count() == 4681
    view, alert = plans.serving_report(spark, folder, fmt)
    assert view.first()["top_historical_abandoned_item"] == 26
    assert view.first()["historical_abandonment_rate"] == 93.5644
    assert alert.count() == 1


def test_speed_report_on_the_first_events(spark, folder):
    events = canonical_events(spark.read.parquet(LOG))
    windows = plans.speed_report(spark, events, folder, limit=100)
    assert 0 < windows.count() < 4681


def test_serving_needs_its_inputs(spark, folder):
    with pytest.raises(FileNotFoundError):
        plans.serving_report(spark, folder)


def test_profile_report(spark):
    report = plans.profile_report(canonical_events(spark.read.parquet(LOG)))
    assert report["sample_rows"].count() == 5
    assert report["event_type_counts"].count() == 5
    assert report["null_profile"].count() == 5
    with pytest.raises(ValueError, match="transactionid"):
        plans.profile_report(canonical_events(spark.read.parquet(LOG)).drop("transactionid"))

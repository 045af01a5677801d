from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lodestrata.operators import order_status as os_, performance
from lodestrata.operators.deliveries import daily_kpis, deliveries
from lodestrata.operators.interval_join import interval_join

START = datetime(2024, 1, 1, 12, 0, 0)
ORDER = ("order_id string, order_date timestamp, restaurant_key string, driver_key string, "
         "user_key string, total_amount decimal(10,2), dt_current_timestamp timestamp")
STATUS = ("order_identifier string, status_name string, status_timestamp timestamp, "
          "dt_current_timestamp timestamp")


def order(key, amount="30.00", at=START):
    return (key, at, "r1", "d1", "u1", Decimal(amount), at)


def status(key, seconds, name="In Transit"):
    at = START + timedelta(seconds=seconds)
    return (key, name, at, at)


def joined(spark, orders, statuses, **options):
    return os_.order_status(spark.createDataFrame(orders, ORDER),
                            spark.createDataFrame(statuses, STATUS), **options)


@pytest.mark.parametrize("sliced", [True, False])
def test_interval_bounds(spark, rows, sliced):
    got = rows(joined(spark, [order("a")], [
        status("a", s) for s in (0, 7200, 7201, -1)], sliced=sliced),
        F.unix_seconds("status_event_time") - F.unix_seconds("order_event_time"))
    assert got == [(0,), (7200,)]


def test_sliced_join_equals_plain_join(spark, rows):
    left = spark.range(400).select(
        F.concat(F.lit("k"), F.col("id") % 5).alias("lk"),
        F.timestamp_seconds(F.col("id") * 173).alias("lt"), F.col("id").alias("lid"))
    right = spark.range(400).select(
        F.concat(F.lit("k"), F.col("id") % 4).alias("rk"),
        F.timestamp_seconds(F.col("id") * 211 + 60).alias("rt"), F.col("id").alias("rid"))
    both = [rows(interval_join(left, right, left_key="lk", right_key="rk", left_time="lt",
                               right_time="rt", within_seconds=900, how=how, **options))
            for how in ("left", "inner")
            for options in ({"sliced": False}, {}, {"slice_seconds": 400}, {"slice_seconds": 2000})]
    assert all(found == both[0] for found in both[:4])
    assert all(found == both[4] for found in both[4:])
    assert len(both[0]) > len(both[4])


def test_delay_flag_severity_and_missing_status(spark, rows):
    got = rows(joined(
        spark,
        [order(k) for k in ("at15", "over15", "late_done", "quick_done", "none")],
        [status("at15", 900), status("over15", 901), status("late_done", 1200, os_.DELIVERED),
         status("quick_done", 600, os_.DELIVERED)]),
        "order_id", "is_delayed", "is_delivered", "event_severity")
    assert got == [
        ("at15", False, False, "NORMAL"),
        ("late_done", True, True, "CRITICAL"),
        ("none", False, None, "NORMAL"),
        ("over15", True, False, "CRITICAL"),
        ("quick_done", False, True, "INFO"),
    ]


def test_invalid_orders_are_dropped(spark, rows):
    bad = [("x", None, "r", "d", "u", Decimal("1.00"), START),
           (None, START, "r", "d", "u", Decimal("1.00"), START), order("zero", "0.00"),
           ("null", START, "r", "d", "u", None, START)]
    assert rows(joined(spark, [order("ok"), *bad], []), "order_id") == [("ok",)]


def test_orders_without_status_count_as_on_time(spark):
    row = performance.restaurant_performance(joined(
        spark, [order("none"), order("open")], [status("open", 1800)])).first()
    assert (row.order_count, row.delayed_orders, row.completed_orders, row.pending_orders) == \
        (2, 1, 0, 1)
    assert row.on_time_rate_pct == 50.0


def test_alert_filter(spark, rows):
    orders = [order("cheap", "19.99"), order("worth", "20.00"), order("done"), order("early"),
              order("pending"), order("two_status")]
    statuses = [status("cheap", 46 * 60), status("worth", 46 * 60),
                status("done", 46 * 60, os_.DELIVERED), status("early", 45 * 60),
                status("pending", 46 * 60, "Pending"), status("two_status", 50 * 60),
                status("two_status", 60 * 60, "Preparing")]
    got = rows(os_.delayed_orders(joined(spark, orders, statuses)), "order_id", "current_status")
    assert got == [("two_status", "In Transit"), ("two_status", "Preparing"),
                   ("worth", "In Transit")]


def test_delay_buckets(spark, rows):
    seconds = [14 * 60 + 59, 15 * 60, 29 * 60 + 59, 30 * 60, 44 * 60 + 59, 45 * 60]
    got = rows(performance.delivery_time_distribution(joined(
        spark, [order("a"), order("none")], [status("a", s) for s in seconds])),
        "time_bucket", "order_count")
    assert got == [("Fast", 2), ("Normal", 2), ("Slow", 1), ("Very Fast", 1)]


def test_latest_status(spark, rows):
    got = rows(os_.latest_status(joined(
        spark, [order("a"), order("b")],
        [status("a", 60, "Preparing"), status("a", 120, "In Transit")])),
        "order_id", "current_status")
    assert got == [("a", "In Transit"), ("b", None)]


def test_status_is_flattened_to_whole_seconds(spark):
    raw = spark.createDataFrame(
        [(1, "o", ("Preparing", 1700000000987), "2023-11-14 22:13:21")],
        "status_id long, order_identifier string, "
        "status struct<status_name: string, timestamp: long>, dt_current_timestamp string")
    row = os_.flatten_status(raw).first()
    assert row.status_name == "Preparing"
    assert row.status_timestamp == datetime(2023, 11, 14, 22, 13, 20)


def test_kpis_count_status_events(spark, rows):
    orders = spark.createDataFrame([("o1", START, "r1", 10.0), ("o2", START, "r1", 20.0)],
                                   "order_id string, order_date timestamp, "
                                   "restaurant_key string, total_amount double")
    statuses = spark.createDataFrame(
        [("o1", ("New",)), ("o1", ("New",)), ("o2", ("New",))],
        "order_identifier string, status struct<status_name: string>")
    pairs = deliveries(orders, statuses)
    assert rows(daily_kpis(pairs), "status_name", "total_orders", "revenue", "avg_ticket") == \
        [("New", 3, 40.0, 40.0 / 3)]
    assert rows(daily_kpis(pairs, as_coded=True), "avg_ticket") == [(40.0,)]


def test_deliveries_within_a_bound(spark, rows):
    orders = spark.createDataFrame([order("a"), order("b")], ORDER)
    statuses = spark.createDataFrame([status("a", 60), status("a", 7300), status("b", 7200)],
                                     STATUS)
    got = rows(deliveries(orders, statuses, amount_type="decimal(12,2)", within_seconds=7200),
               "order_id", "total_amount")
    assert got == [("a", Decimal("30.00")), ("b", Decimal("30.00"))]

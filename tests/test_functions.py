"""Column expressions at NULL and boundary values."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lodestrata.functions import columns as fc, metrics
from lodestrata.operators import performance


def values(spark, expression, data, schema):
    return [row[0] for row in spark.createDataFrame(data, schema).select(expression).collect()]


def test_keys(spark):
    data = [(" ab1 ",), ("AB1",), ("",), (None,)]
    assert values(spark, fc.normalised_key(F.col("k")), data, "k string") == \
        ["AB1", "AB1", "", None]


def test_epoch_millis(spark):
    data = [(1700000000987,), (0,), (None,)]
    assert values(spark, fc.from_epoch_millis(F.col("m")), data, "m long") == [
        datetime(2023, 11, 14, 22, 13, 20), datetime(1970, 1, 1), None]


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_minutes(spark, kind):
    a, b = datetime(2024, 1, 1, 10, 0, 0, 900000), datetime(2024, 1, 1, 10, 1, 30, 100000)
    minutes = fc.minutes_between(F.col("a").cast(kind), F.col("b").cast(kind))
    data = [(a, b), (b, a), (a, None)]
    assert values(spark, minutes, data, "a timestamp, b timestamp") == [1.5, 1.5, None]


def test_buckets(spark):
    bucket = fc.bucketed(F.col("v"), (15, 30), ("low", "mid", "high"))
    data = [(14.99,), (15.0,), (29.99,), (30.0,), (None,)]
    assert values(spark, bucket, data, "v double") == ["low", "mid", "mid", "high", "high"]
    with pytest.raises(ValueError):
        fc.bucketed(F.col("v"), (15, 30), ("low", "high"))


def test_all_present(spark):
    data = [("x", 1), (None, 1), ("x", None)]
    assert values(spark, fc.all_present(F.col("a"), F.col("b")), data, "a string, b int") == \
        [1, 0, 0]


def test_two_valued_condition(spark):
    data = [(1,), (0,), (None,)]
    assert values(spark, fc.is_true(F.col("v") > 0), data, "v int") == [True, False, False]


def test_ratios(spark):
    df = spark.createDataFrame([(1, 3), (1, 0)], "part long, whole long")
    assert [r[0] for r in df.select(metrics.percent(F.col("part"), F.col("whole"))).collect()] \
        == [33.33, None]
    assert [r[0] for r in df.select(metrics.quotient(F.col("part"), F.col("whole"))).collect()] \
        == [0.33, None]


def test_average_on_a_tie_rounds_up(spark):
    df = spark.createDataFrame([(5.55,), (114.1,)], "v double")
    assert df.agg(metrics.rounded_average(F.col("v"))).first()[0] == 59.83


def test_health_of_an_empty_table(spark):
    df = spark.createDataFrame(
        [], "delivery_time_minutes double, total_amount double, is_delayed boolean, "
            "is_delivered boolean, event_severity string")
    row = performance.platform_health(df).first()
    assert row.order_status_rows == 0 and row.on_time_rate_pct is None

"""Orders joined with their status events, classified, and filtered for alerts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestrata.functions.columns import from_epoch_millis, minutes_between
from lodestrata.operators.expectations import Expectation, enforce
from lodestrata.operators.interval_join import interval_join, with_event_time
from lodestrata.operators.latest import latest_per_key

# Result-defining literals.
WATERMARK = "10 minutes"
MATCH_SECONDS = 2 * 60 * 60
DELAY_FLAG_MINUTES = 15
ALERT_DELAY_MINUTES = 45
ALERT_MAX_MINUTES = 180
ALERT_MIN_AMOUNT = 20.0
DELIVERED = "Order Delivered"
ACTIONABLE = ("Preparing", "Out for Delivery", "In Transit")

ORDER_RULES = (
    Expectation("valid_order_id", "order_id IS NOT NULL"),
    Expectation("valid_order_date", "order_date IS NOT NULL"),
    Expectation("valid_total_amount", "total_amount > 0"),
)


def flatten_status(raw: DataFrame) -> DataFrame:
    """Lift the nested status name and epoch-millisecond time to columns; other columns stay behind them."""
    own = ("status_id", "order_identifier", "status", "dt_current_timestamp")
    carried = [c for c in raw.columns if c not in own]
    return raw.select(
        "status_id",
        "order_identifier",
        "status",
        "dt_current_timestamp",
        F.col("status.status_name").alias("status_name"),
        from_epoch_millis(F.col("status.timestamp")).alias("status_timestamp"),
        *carried,
    )


def order_status(
    orders: DataFrame,
    status: DataFrame,
    *,
    watermark: str | None = None,
    within_seconds: int = MATCH_SECONDS,
    delay_minutes: float = DELAY_FLAG_MINUTES,
    delivered: str = DELIVERED,
    processed_at: Column | None = None,
    sliced: bool = True,
    slice_seconds: int | None = None,
) -> DataFrame:
    """One row per order and status within the bound; orders without one stay.

    Give ``watermark`` when both inputs are streams. The row rules only look at
    order columns, so they are applied before the join and keep its state small.
    """
    orders = with_event_time(enforce(orders, ORDER_RULES), "dt_current_timestamp", watermark)
    status = with_event_time(status, "dt_current_timestamp", watermark)
    left = orders.select(
        "order_id", "order_date", "restaurant_key", "driver_key",
        F.col("user_key").alias("customer_key"), "total_amount",
        F.col("dt_current_timestamp").alias("order_event_time"),
    )
    right = status.select(
        "order_identifier",
        F.col("status_name").alias("current_status"),
        F.col("status_timestamp").alias("status_update_time"),
        F.col("dt_current_timestamp").alias("status_event_time"),
    )
    joined = interval_join(
        left, right,
        left_key="order_id", right_key="order_identifier",
        left_time="order_event_time", right_time="status_event_time",
        within_seconds=within_seconds, sliced=sliced, slice_seconds=slice_seconds,
    ).drop("order_identifier")
    return classify(joined, delay_minutes, delivered, processed_at)


def classify(joined: DataFrame, delay_minutes: float = DELAY_FLAG_MINUTES,
             delivered: str = DELIVERED, processed_at: Column | None = None) -> DataFrame:
    """Delay, delivery and severity of joined rows.

    Without a status the delay is NULL and therefore not delayed, while
    ``is_delivered`` stays NULL. A delay outranks a delivery.
    """
    delay = minutes_between(F.col("order_event_time"), F.col("status_event_time"))
    severity = (
        F.when(F.col("is_delayed"), "CRITICAL")
        .when(F.col("is_delivered"), "INFO")
        .otherwise("NORMAL")
    )
    return (
        joined.withColumn("delivery_time_minutes", delay)
        .withColumn("is_delayed",
                    F.coalesce(F.col("delivery_time_minutes") > delay_minutes, F.lit(False)))
        .withColumn("is_delivered", F.col("current_status") == delivered)
        .withColumn("event_severity", severity)
        .withColumn("processed_timestamp",
                    F.current_timestamp() if processed_at is None else processed_at)
    )


def delayed_orders(
    statuses: DataFrame,
    *,
    delay_minutes: float = ALERT_DELAY_MINUTES,
    max_minutes: float = ALERT_MAX_MINUTES,
    min_amount: float = ALERT_MIN_AMOUNT,
    actionable: Sequence[str] = ACTIONABLE,
) -> DataFrame:
    """Rows that call for action: late, open, worth it, plausible and still movable."""
    return (
        statuses.filter(F.col("delivery_time_minutes") > delay_minutes)
        .filter(~F.col("is_delivered"))
        .filter(F.col("total_amount") >= min_amount)
        .filter(F.col("delivery_time_minutes") < max_minutes)
        .filter(F.col("current_status").isin(*actionable))
        .select(
            "order_id", "order_date", "restaurant_key", "driver_key", "customer_key",
            "current_status", "delivery_time_minutes", "total_amount", "event_severity",
            "processed_timestamp",
        )
    )


def latest_status(statuses: DataFrame, keys: Sequence[str] = ("order_id",)) -> DataFrame:
    """The newest status of each order from the joined rows."""
    return latest_per_key(statuses, keys, [
        F.col("status_event_time").desc_nulls_last(),
        F.col("order_event_time").desc(),
        F.col("current_status").asc_nulls_last(),
        F.col("total_amount").desc(),
        F.col("driver_key").desc(),
    ])

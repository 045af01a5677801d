"""Orders joined with their statuses, alerts, and performance figures."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from lodestrata.operators import order_status as os_, performance
from lodestrata.plans import datasets
from lodestrata.plans.layers import MAX_BYTES, Layers
from lodestrata.sources import alerts
from lodestrata.sources.evolution import resolve_schema
from lodestrata.sources.json_files import JSON_FILES
from lodestrata.sources.schemas import ORDER_HINTS, STATUS_EVENTS, SchemaStore
from lodestrata.sources.tables import AVAILABLE_NOW
from lodestrata.streaming.served import ServedState


def run(spark: SparkSession, source: str, target: str, *,
        trigger: Mapping[str, object] | None = None, max_bytes: int = MAX_BYTES,
        kafka: Mapping[str, str] | None = None, now: Column | None = None,
        database: str | None = None) -> Layers:
    """``source`` holds the folders orders and status; ``now`` is the clock of the gold tables."""
    layers = Layers(spark, target, trigger, max_bytes)
    orders = f"{source}/orders/{JSON_FILES}"
    schema = resolve_schema(spark, orders, SchemaStore(spark, layers.path("schemas/orders")),
                            "add", hints=ORDER_HINTS)
    layers.append_lines("bronze_orders", orders, schema)
    layers.append_lines("bronze_status", f"{source}/status/*", STATUS_EVENTS, os_.flatten_status)

    layers.append("silver_order_status", os_.order_status(
        layers.stream("bronze_orders"), layers.stream("bronze_status"),
        watermark=os_.WATERMARK))
    layers.append("silver_delayed_orders", os_.delayed_orders(
        layers.stream("silver_order_status")))
    layers.settle(alerts.send(
        alerts.payload(layers.stream("silver_delayed_orders")), layers.checkpoint("alerts"),
        path=layers.path("alerts"), kafka=kafka, trigger=trigger or AVAILABLE_NOW))

    # Join and windows are one query: one watermark serves both, so no window closes
    # before the join has given out its orders without a status.
    # Windows keep sketches, so that wider ones can be put together from them.
    layers.append("gold_restaurant_windows", performance.restaurant_windows(os_.order_status(
        layers.stream("bronze_orders"), layers.stream("bronze_status"), watermark=os_.WATERMARK)))
    silver = layers.stream("silver_order_status")
    layers.settle(drivers(layers).maintain(silver, trigger or AVAILABLE_NOW))
    layers.settle(delays(layers).maintain(performance.with_delay(silver), trigger or AVAILABLE_NOW))
    serve(layers, now)
    layers.register(database, datasets.REALTIME)
    return layers


def drivers(layers: Layers) -> ServedState:
    """Running totals of drivers: the state of their stream."""
    return ServedState(layers.checkpoint("gold_driver_performance"), {"driver_key": F.col("driver_key")},
                       performance.driver_parts())


def delays(layers: Layers) -> ServedState:
    """Running totals of delay buckets: the state of their stream."""
    return ServedState(layers.checkpoint("gold_delivery_time_distribution"),
                       {"time_bucket": performance.time_bucket()}, performance.parts())


def serve(layers: Layers, now: Column | None = None) -> None:
    """Replace the gold tables by what the streams hold now. With a continuous trigger, call it when figures are wanted."""
    now = F.current_timestamp() if now is None else now
    windows = performance.estimated(layers.read("gold_restaurant_windows"), performance.RESTAURANT_COUNTS)
    layers.refresh("gold_restaurant_performance",
                   performance.restaurant_figures(windows).withColumn("last_updated", now))
    totals = drivers(layers).read(layers.spark)
    if totals is not None:
        figures = performance.driver_figures(performance.estimated(totals, performance.DRIVER_COUNTS))
        layers.refresh("gold_driver_performance", figures.withColumn("last_updated", now))
    buckets = delays(layers).read(layers.spark)
    if buckets is not None:
        layers.refresh("gold_delivery_time_distribution",
                       performance.bucket_figures(buckets).withColumn("updated_at", now))
    layers.refresh("gold_platform_health", performance.platform_health(layers.read("silver_order_status")))

"""Orders and statuses to daily figures."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession

from lodestrata.operators.deliveries import daily_kpis, deliveries
from lodestrata.plans import datasets
from lodestrata.plans.layers import MAX_BYTES, Layers
from lodestrata.sources.schemas import ORDER_EVENTS, STATUS_EVENTS


def run(spark: SparkSession, source: str, target: str, *,
        trigger: Mapping[str, object] | None = None, max_bytes: int = MAX_BYTES,
        within_seconds: int | None = None, watermark: str | None = None,
        database: str | None = None) -> Layers:
    """``source`` holds files kafka_orders_* and kafka_status_*.

    Without a time bound the stream join keeps every order and status for good.
    """
    layers = Layers(spark, target, trigger, max_bytes)
    layers.append_lines("bronze_orders", f"{source}/kafka_orders_*", ORDER_EVENTS)
    layers.append_lines("bronze_status", f"{source}/kafka_status_*", STATUS_EVENTS)
    layers.append("silver_deliveries", deliveries(
        layers.stream("bronze_orders"), layers.stream("bronze_status"),
        within_seconds=within_seconds, watermark=watermark))
    layers.refresh("gold_kpis", daily_kpis(layers.read("silver_deliveries")))
    layers.register(database, datasets.DELIVERIES)
    return layers

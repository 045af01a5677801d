"""Alerts for other systems."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lodestrata.sources.tables import AVAILABLE_NOW


def payload(alerts: DataFrame, key: str = "order_id") -> DataFrame:
    """Key and JSON value of each alert, as a message sink takes them."""
    return alerts.select(
        F.col(key).cast("string").alias("key"),
        F.to_json(F.struct(*alerts.columns)).alias("value"),
    )


def send(messages: DataFrame, checkpoint: str, *, path: str | None = None,
         kafka: Mapping[str, str] | None = None,
         trigger: Mapping[str, object] = AVAILABLE_NOW) -> StreamingQuery:
    """Stream messages to JSON files, or to Kafka where its connector is installed."""
    writer = messages.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    writer = writer.trigger(**trigger)
    if kafka is not None:
        return writer.format("kafka").options(**kafka).start()
    return writer.format("json").start(path)

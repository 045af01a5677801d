"""What streams counted on the way: observed metrics and rows dropped as late, kept per micro-batch."""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

SCHEMA = "query STRING, run STRING, batch BIGINT, metric STRING, value BIGINT"
LATE = "late_rows"


class ProgressLog(StreamingQueryListener):
    """Appends the counts of each micro-batch of named streams to a table of JSON lines.

    Spark reports a micro-batch once it is done, apart from its data. So a count can
    come twice when a batch is repeated after a failure: readers take one row of each
    query, batch and metric. A batch without counts leaves no line.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path
        self._written = threading.Lock()

    def __enter__(self) -> ProgressLog:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_) -> None:
        # Reports still on their way are delivered first.
        self.spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        self.spark.streams.removeListener(self)

    def onQueryStarted(self, event) -> None:
        """Nothing is counted yet."""

    def onQueryIdle(self, event) -> None:
        """Nothing is counted."""

    def onQueryTerminated(self, event) -> None:
        """All counts have been reported."""

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        if progress.name is None:
            return
        counts = {LATE: sum(op.numRowsDroppedByWatermark for op in progress.stateOperators)}
        for name, row in progress.observedMetrics.items():
            counts.update({f"{name}.{metric}": value for metric, value in row.asDict().items()})
        lines = [
            (json.dumps({"query": progress.name, "run": str(progress.runId), "batch": progress.batchId,
                         "metric": metric, "value": value}),)
            for metric, value in counts.items() if value]
        if lines:
            with self._written:
                self.spark.createDataFrame(lines, "value STRING").coalesce(1).write.mode("append").text(self.path)


def counted(spark: SparkSession, path: str) -> DataFrame:
    """(query, metric, value): the counts of all micro-batches of each query, each batch once."""
    rows = spark.read.schema(SCHEMA).json(path)
    each = rows.groupBy("query", "batch", "metric").agg(F.max("value").alias("value"))
    return each.groupBy("query", "metric").agg(F.sum("value").alias("value"))

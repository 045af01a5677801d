"""Where a job keeps its tables, and how it moves rows from layer to layer."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lodestrata.sources.evolution import read_lines
from lodestrata.sources.quarantine import BAD, bad_lines, good, marked
from lodestrata.sources.schemas import Schema
from lodestrata.sources.tables import (
    AVAILABLE_NOW, Dataset, append_stream, finish, read_table, refresh, stream_table,
)
from lodestrata.streaming.running import Running


MAX_BYTES = 5 * 1024**3


@dataclass(frozen=True)
class Layers:
    """Tables of one job under a shared folder.

    With the available-now trigger every step ends when its input is used up, so
    steps run one after the other. A continuous trigger leaves all streams running at
    once, to be stopped by ``running.stop()``; they go on from their checkpoints at the
    next start. Run a job once with available-now before, so that its tables exist.
    """

    spark: SparkSession
    root: str
    trigger: Mapping[str, object] | None = None
    # Bound of every micro-batch of the job.
    max_bytes: int = MAX_BYTES
    running: Running = field(default_factory=Running)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def checkpoint(self, name: str) -> str:
        return f"{self.root}/checkpoints/{name}"

    def _trigger(self) -> Mapping[str, object]:
        return self.trigger or AVAILABLE_NOW

    def append(self, name: str, stream: DataFrame, partition_by: Sequence[str] = ()) -> None:
        query = append_stream(stream, self.path(name), self.checkpoint(name),
                              trigger=self._trigger(), partition_by=partition_by)
        self.settle(query)

    def append_lines(self, name: str, source: str, schema: Schema,
                     finished: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> None:
        """Append the rows of JSON files with their lineage. Lines that are no valid JSON stay in a folder of the same
        table: one read and one sink, so each line is in one of the two, once, also when a micro-batch is repeated.
        """
        lines = read_lines(self.spark, source, stream=True, max_bytes=self.max_bytes)
        rows = marked(lines.filter(F.trim("value") != ""), schema).withColumn(
            "ingestion_timestamp", F.current_timestamp())
        self.append(name, finished(rows), partition_by=[BAD])

    def quarantined(self, name: str) -> DataFrame:
        """(line, source file) of the lines of a table that are no valid JSON."""
        return bad_lines(self.spark, self.path(name))

    def settle(self, query: StreamingQuery) -> None:
        if "availableNow" in self._trigger():
            finish(query)
        else:
            self.running.add(query)

    def refresh(self, name: str, df: DataFrame, cluster_by: Sequence[str] = (),
                partition_by: Sequence[str] = ()) -> None:
        refresh(df, self.path(name), cluster_by=cluster_by, partition_by=partition_by)

    def register(self, database: str | None, datasets: Sequence[Dataset]) -> None:
        """Make the tables that the job has written so far known to the catalog, with their descriptions."""
        for dataset in datasets if database else ():
            if self._exists(dataset.name):
                replace(dataset, name=f"{database}.{dataset.name}").register(
                    self.spark, self.path(dataset.name))

    def _exists(self, name: str) -> bool:
        try:
            read_table(self.spark, self.path(name))
        except AnalysisException as error:
            if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            return False
        return True

    def read(self, name: str) -> DataFrame:
        return good(read_table(self.spark, self.path(name)))

    def stream(self, name: str) -> DataFrame:
        return good(stream_table(self.spark, self.path(name), max_bytes=self.max_bytes))

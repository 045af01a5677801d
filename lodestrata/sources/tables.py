"""Parquet tables: full refresh, stream append, reading as stream, description."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from lodestrata.sources.quarantine import BAD, good

AVAILABLE_NOW = {"availableNow": True}


@dataclass(frozen=True)
class Dataset:
    """What a table holds."""

    name: str
    comment: str = ""
    grain: str = ""
    properties: Mapping[str, str] = field(default_factory=dict)

    def register(self, spark: SparkSession, path: str) -> None:
        """Make the files at ``path`` known to the catalog under this name, with the description.

        Repeated registration follows columns that came in since. A table that keeps bad
        lines apart is a view of its good rows. Both read what its streams have committed.
        """
        described = f"COMMENT {_text(self.comment)}"
        properties = {**self.properties, **({"grain": self.grain} if self.grain else {})}
        listed = ", ".join(f"{_text(k)} = {_text(v)}" for k, v in properties.items())
        described += f" TBLPROPERTIES ({listed})" if listed else ""
        rows = read_table(spark, path)
        if BAD in rows.columns:
            columns = ", ".join(_name(c) for c in good(rows).columns)
            spark.sql(f"CREATE OR REPLACE VIEW {self.name} {described} AS SELECT {columns} "
                      f"FROM parquet.{_name(path)} WHERE NOT CAST({BAD} AS BOOLEAN)")
            return
        if spark.catalog.tableExists(self.name):
            if spark.table(self.name).schema == rows.schema:
                spark.catalog.refreshTable(self.name)
                return
            # Only the catalog's entry goes: the files are not its own.
            spark.sql(f"DROP TABLE {self.name}")
        spark.sql(f"CREATE TABLE {self.name} USING parquet LOCATION {_text(path)} {described}")


def _name(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _text(value: str) -> str:
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def refresh(df: DataFrame, path: str, *, partition_by: Sequence[str] = (),
            cluster_by: Sequence[str] = ()) -> None:
    """Replace the table with the result of a batch query.

    ``cluster_by`` gathers equal keys in the same files, evened out where a key
    is large, and sorts them, so that later reads skip by their statistics.
    """
    if cluster_by:
        df = df.hint("rebalance", *cluster_by).sortWithinPartitions(*cluster_by)
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def append_stream(df: DataFrame, path: str, checkpoint: str, *,
                  trigger: Mapping[str, object] = AVAILABLE_NOW,
                  partition_by: Sequence[str] = ()) -> StreamingQuery:
    """Append a stream to a table, each row once across restarts."""
    writer = df.writeStream.format("parquet").outputMode("append")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start(path)


def append_to_table(df: DataFrame, name: str, checkpoint: str, *,
                    trigger: Mapping[str, object] = AVAILABLE_NOW) -> StreamingQuery:
    """The same into a catalog table, created when absent."""
    return df.writeStream.option("checkpointLocation", checkpoint).trigger(
        **trigger).toTable(name, format="parquet")


def finish(query: StreamingQuery) -> None:
    """Wait for an available-now query and raise its error."""
    query.awaitTermination()


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def stream_table(spark: SparkSession, path: str, max_files: int | None = None,
                 max_bytes: int | None = None) -> DataFrame:
    """The rows appended to a table since the last micro-batch, whose size is bounded."""
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.parquet(path)

"""JSON files as batches and as incremental streams."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestrata.sources.inference import as_columns, line_schema
from lodestrata.sources.schemas import Schema, with_hints

# Fixed value: text form of order times.
ORDER_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"
# Names of JSON files, plain or compressed in a way that Spark reads by the name.
JSON_FILES = "*.json{,.gz,.bz2,.deflate,.snappy,.lz4,.zst}"

Options = Mapping[str, str | int | bool]


# Options that choose files, as against those that say how to parse a line.
_FILE_OPTIONS = ("modifiedAfter", "modifiedBefore", "pathGlobFilter", "recursiveFileLookup")


def infer_schema(spark: SparkSession, path: str, *, hints: str | None = None,
                 options: Options | None = None) -> T.StructType:
    """Column types of all lines, overridden by the hints, found in one pass; any order of the files gives the same types.

    Limit the files with ``modifiedAfter``. Fields are in the order of their names.
    """
    chosen = {k: v for k, v in dict(options or {}).items() if k in _FILE_OPTIONS}
    found = spark.read.options(**chosen).text(path).agg(line_schema()).first()[0]
    return with_hints(as_columns(found), hints)


def read_json(spark: SparkSession, path: str, *, schema: Schema | None = None,
              hints: str | None = None, options: Options | None = None,
              now: Column | None = None) -> DataFrame:
    """A full snapshot of the files with lineage columns."""
    schema = schema or infer_schema(spark, path, hints=hints, options=options)
    return with_lineage(
        spark.read.schema(schema).options(**dict(options or {})).json(path), now)


def stream_json(spark: SparkSession, path: str, *, schema: Schema | None = None,
                hints: str | None = None, options: Options | None = None,
                max_bytes: int | None = None, max_files: int | None = None,
                now: Column | None = None) -> DataFrame:
    """Each file once, with lineage columns. ``path`` may be a glob.

    ``max_bytes`` and ``max_files`` bound a micro-batch.
    """
    schema = schema or infer_schema(spark, path, hints=hints, options=options)
    reader = spark.readStream.schema(schema).options(**dict(options or {}))
    return with_lineage(bounded(reader, max_bytes, max_files).json(path), now)


def bounded(reader, max_bytes: int | None, max_files: int | None):
    if max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", int(max_bytes))
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", int(max_files))
    return reader


def with_lineage(df: DataFrame, now: Column | None = None,
                 time_column: str = "ingestion_timestamp") -> DataFrame:
    """When a row was read, and from which file."""
    return df.select(
        "*",
        (F.current_timestamp() if now is None else now).alias(time_column),
        F.col("_metadata.file_path").alias("source_file"),
    )

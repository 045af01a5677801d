"""Loading a folder of files into a table, each file once."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestrata.sources.evolution import read_lines
from lodestrata.sources.inference import LINE_SCHEMA, as_columns, line_schema
from lodestrata.sources.json_files import Options
from lodestrata.sources.schemas import SchemaStore, merged, with_hints
from lodestrata.sources.tables import AVAILABLE_NOW, finish

LOAD = "load"


def copy_into(spark: SparkSession, source: str, target: str, *, merge_schema: bool = True,
              hints: str | None = None, options: Options | None = None, max_bytes: int | None = None,
              trigger: Mapping[str, object] = AVAILABLE_NOW) -> None:
    """Load the files that earlier calls have not loaded; the table is made when absent.

    The stream's checkpoint beside the table is the record of loaded files. The lines of a
    micro-batch are read from their files once, and their schema is found on the way: so it
    is the schema of exactly these files, also of one that came meanwhile. With
    ``merge_schema`` new fields become new columns, otherwise only the first batch's
    are taken. A value that a column can't hold raises and the batch is not loaded.
    A repeated batch replaces what it had written.
    """
    failed: list[Exception] = []

    def load(batch: DataFrame, batch_id: int) -> None:
        try:
            _load(batch, batch_id, target, merge_schema, hints, options)
        except Exception as error:
            failed.append(error)
            raise

    lines = read_lines(spark, source, stream=True, max_bytes=max_bytes).select("value")
    query = lines.writeStream.foreachBatch(load).option(
        "checkpointLocation", f"{target}/checkpoint").trigger(**trigger).start()
    try:
        finish(query)
    except StreamingQueryException:
        if failed:
            raise failed[0] from None
        raise


def _load(batch: DataFrame, batch_id: int, target: str, merge_schema: bool, hints: str | None,
          options: Options | None) -> None:
    spark, store = batch.sparkSession, _store(batch.sparkSession, target)
    kept = store.load()
    seen, staged = Observation(), f"{target}/staged"
    batch.observe(seen, line_schema()).write.mode("overwrite").parquet(staged)
    found = with_hints(as_columns(seen.get[LINE_SCHEMA]), hints)
    schema = found if kept is None else merged(kept[0], found) if merge_schema else kept[0]
    # The batch is loaded before the schema names its columns: a repeated batch finds the same.
    rows = spark.read.schema("value STRING").parquet(staged)
    parsed = rows.select(F.from_json("value", schema, dict(options or {})).alias("_row")).select("_row.*")
    parsed.write.mode("overwrite").parquet(f"{target}/rows/{LOAD}={batch_id}")
    if kept is None or kept[0] != schema:
        store.save(schema, "")


def loaded(spark: SparkSession, target: str) -> DataFrame:
    """The loaded rows; columns a file did not have are NULL.

    Reading with the stored schema spares merging the schemas of all files.
    """
    schema, _ = _store(spark, target).load()
    with_load = T.StructType([*schema.fields, T.StructField(LOAD, T.LongType())])
    return spark.read.schema(with_load).parquet(f"{target}/rows").drop(LOAD)


def _store(spark: SparkSession, target: str) -> SchemaStore:
    return SchemaStore(spark, f"{target}/schema")

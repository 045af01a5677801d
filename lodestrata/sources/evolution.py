"""What happens to fields that the stored schema does not know."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestrata.sources.json_files import Options, bounded, infer_schema
from lodestrata.sources.leftovers import left_over
from lodestrata.sources.schemas import Schema, SchemaStore, as_struct, merged

MODES = ("add", "rescue", "fail", "none")
RESCUED = "_rescued_data"


class NewColumnsError(Exception):
    """New fields arrived although the mode forbids them."""


def resolve_schema(spark: SparkSession, path: str, store: SchemaStore, mode: str = "add", *,
                   hints: str | None = None, options: Options | None = None) -> T.StructType:
    """The schema to read with now; called whenever a stream starts.

    The first call infers and stores it. Later calls look only at files modified
    since, and only when the mode cares about new fields.
    """
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}")
    started = _now()
    kept = store.load()
    if kept is None:
        schema = infer_schema(spark, path, hints=hints, options=options)
        store.save(schema, started)
        return schema
    schema, seen_until = kept
    if mode in ("rescue", "none"):
        return schema
    recent = {**dict(options or {}), "modifiedAfter": seen_until}
    try:
        found = infer_schema(spark, path, hints=hints, options=recent)
    except AnalysisException:
        return schema  # no newer files
    grown = merged(schema, found)
    if mode == "fail" and grown != schema:
        new = sorted(set(grown.fieldNames()) - set(schema.fieldNames()))
        raise NewColumnsError(f"new columns {new}")
    store.save(grown, started)
    return grown


def _now() -> str:
    """A little early, so that a file written meanwhile is looked at again."""
    moment = datetime.now(timezone.utc) - timedelta(minutes=2)
    return moment.strftime("%Y-%m-%dT%H:%M:%S")


def read_lines(spark: SparkSession, path: str, *, stream: bool = False,
               max_bytes: int | None = None, max_files: int | None = None) -> DataFrame:
    """JSON lines as text with their file's path."""
    reader = spark.readStream if stream else spark.read
    lines = bounded(reader, max_bytes, max_files).text(path)
    return lines.select("value", F.col("_metadata.file_path").alias("source_file"))


def parse_rescuing(lines: DataFrame, schema: Schema, options: Options | None = None,
                   line: str = "value") -> DataFrame:
    """Parsed columns, and in ``_rescued_data`` as JSON what they cannot hold.

    That is every field outside the schema and every value of another type, at any
    depth and under its path: what is left of ``s.x`` is ``{"s":{"x":...}}``. A line
    that is no JSON object, or names a field twice, is kept there as it is. Numbers of
    more than 38 digits are kept as doubles. Other columns of ``lines`` stay.
    """
    schema = as_struct(schema)
    others = [c for c in lines.columns if c != line]
    rows = lines.select(
        *others, F.from_json(line, schema, dict(options or {})).alias("_row"),
        F.try_parse_json(line).alias("_raw"), F.col(line).alias("_line"))
    is_object = F.coalesce(F.schema_of_variant("_raw").startswith("OBJECT"), F.lit(False))
    rest = F.when(is_object, left_over(F.col("_row"), F.col("_raw"), schema)).otherwise(F.col("_line"))
    return rows.select("_row.*", *others, rest.alias(RESCUED))

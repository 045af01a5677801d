"""Keeping lines that are no valid JSON apart, in one pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodestrata.sources.json_files import Options
from lodestrata.sources.schemas import Schema, as_struct

BAD = "quarantined"
LINE = "_bad_line"


def marked(lines: DataFrame, schema: Schema, options: Options | None = None,
           line: str = "value") -> DataFrame:
    """Parsed rows; a bad line has only NULLs, the line itself and ``quarantined``.

    A table of the result partitioned by ``quarantined`` keeps good and bad
    lines in folders of their own, written by one exactly-once sink.
    """
    others = [c for c in lines.columns if c != line]
    with_line = T.StructType(as_struct(schema).fields + [T.StructField(LINE, T.StringType())])
    parsed = F.from_json(
        line, with_line, {**dict(options or {}), "mode": "PERMISSIVE",
                          "columnNameOfCorruptRecord": LINE})
    return lines.select(*others, parsed.alias("_row")).select(
        "_row.*", *others, F.col(f"_row.{LINE}").isNotNull().alias(BAD))


def _is_bad() -> Column:
    """The folder name is read back as text."""
    return F.col(BAD).cast("boolean")


def good(rows: DataFrame) -> DataFrame:
    """The good rows of a table of marked lines; another table as it is."""
    return rows.filter(~_is_bad()).drop(BAD, LINE) if BAD in rows.columns else rows


def good_rows(spark: SparkSession, path: str) -> DataFrame:
    return good(spark.read.parquet(path))


def bad_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).filter(_is_bad()).select(LINE, "source_file")

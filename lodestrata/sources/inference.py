"""The schema of JSON lines, found by one aggregate over all of them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

LINE_SCHEMA = "line_schema"


def line_schema(line: str = "value") -> Column:
    """An aggregate whose value is the schema of all lines, whatever their order. Broken lines don't take part.

    It combines on the map side, and may be observed while the lines are written.
    """
    return F.schema_of_variant_agg(F.try_parse_json(F.col(line))).alias(LINE_SCHEMA)


def as_columns(found: str | None) -> T.StructType:
    """The value of ``line_schema`` as columns; lines that are no objects have none.

    Numbers with a fraction are DOUBLE, values of several types and those that are always
    null are text, like a reader of JSON has them.
    """
    if not found or not found.startswith("OBJECT<"):
        return T.StructType()
    return _readable(T.StructType.fromDDL(_as_ddl(found)[len("STRUCT<") : -1]))


def _as_ddl(found: str) -> str:
    """OBJECT outside of quoted names is STRUCT."""
    parts = found.split("`")
    # Two quotes side by side inside a name leave an even number of parts outside: names are the odd ones.
    parts[::2] = [p.replace("OBJECT<", "STRUCT<").replace("STRUCT<>", "STRING") for p in parts[::2]]
    return "`".join(parts)


def _readable(kind: T.DataType) -> T.DataType:
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _readable(f.dataType)) for f in kind.fields])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_readable(kind.elementType))
    if isinstance(kind, T.DecimalType):
        return T.DoubleType() if kind.scale else kind
    if isinstance(kind, (T.LongType, T.DoubleType, T.BooleanType)):
        return kind
    return T.StringType()

"""What a schema cannot hold of a JSON value, at any depth, as JSON of the same shape."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_OBJECT = "map<string,variant>"
_ARRAY = "array<variant>"


def left_over(parsed: Column, raw: Column, kind: T.DataType) -> Column:
    """JSON text of what of ``raw`` (a VARIANT) is not in ``parsed``, its value read as ``kind``; NULL when nothing is left.

    Of an object that is every field the schema does not know and every value of another
    type, under its own path; of an array of objects or arrays, the index of an element
    takes the place of a name. A value that could not be read at all is left whole.
    """
    if isinstance(kind, T.StructType):
        return _of_object(parsed, raw, kind)
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, (T.StructType, T.ArrayType)):
        return _of_array(parsed, raw, kind.elementType)
    return F.when(parsed.isNull() & ~_nothing(raw), _text(raw))


def _nothing(raw: Column) -> Column:
    return raw.isNull() | F.is_variant_null(raw)


def _text(raw: Column) -> Column:
    return F.to_json(raw)


def _entry(name: Column, value: Column) -> Column:
    """``"name":value``, or NULL without a value. The name is escaped as JSON has it."""
    quoted = F.to_json(F.array(name))
    return F.concat(F.substring(quoted, F.lit(2), F.length(quoted) - 2), F.lit(":"), value)


def _joined(entries: Column) -> Column:
    found = F.array_compact(entries)
    return F.when(F.size(found) > 0, F.concat(F.lit("{"), F.array_join(found, ","), F.lit("}")))


def _of_object(parsed: Column, raw: Column, kind: T.StructType) -> Column:
    members = F.try_variant_get(raw, "$", _OBJECT)
    known = [
        _entry(F.lit(f.name), left_over(parsed[f.name], members[f.name], f.dataType)) for f in kind.fields]
    names = F.array(*[F.lit(f.name) for f in kind.fields]).cast("array<string>")
    unknown = F.transform(
        F.map_entries(F.map_filter(members, lambda name, _: ~F.array_contains(names, name))),
        lambda e: _entry(e["key"], _text(e["value"])))
    own = F.array(*known).cast("array<string>")
    return F.when(_nothing(raw), F.lit(None).cast("string")).when(
        members.isNull(), _text(raw)).otherwise(_joined(F.concat(own, unknown)))


def _of_array(parsed: Column, raw: Column, element: T.DataType) -> Column:
    elements = F.try_variant_get(raw, "$", _ARRAY)
    entries = F.transform(
        elements, lambda e, i: _entry(i.cast("string"), left_over(F.get(parsed, i), e, element)))
    return F.when(_nothing(raw), F.lit(None).cast("string")).when(
        elements.isNull(), _text(raw)).otherwise(_joined(entries))
